"""Ranked search over posting lists that are cut into blocks of similar documents.

Documents are vectors over the terms of the queries, a coordinate being what a term adds
to a score (its impact). A term's posting list is clustered by the similarity of these
vectors into blocks; each keeps a summary, the greatest impact of every coordinate over
its documents. A query's sum over a summary is at least the score of every document in the
block, so a block is skipped only when that exact bound is under the query's threshold.

1. One pass over the texts counts each document's terms and keeps those of the queries
   (the forward table, in the shared folder). Counts over it give the terms' weights.
2. Thresholds: documents that score best on a query's rarest terms are scored in full;
   the K-th of these scores is a lower bound of the K-th of all.
3. Documents are sorted by a sketch of random projections, so that similar ones lie close,
   and come to the tasks in shards of SHARD_DOCS. A list of any length is spread over the
   shards; within a shard each term's part is clustered about documents picked from it.
4. A query visits its terms' lists from the rarest to the commonest. At a list, the
   bound counts the terms from there on, as documents with an earlier term were found
   there. First it is taken over the shard's whole list, then over each block; documents
   of blocks left are scored in full, and thresholds rise with what is found.
5. Each task hands on its K best per query; they are ranked once more over all tasks.

The queries are taken in turns of QUERY_BYTES of text, which bounds what the tasks get
(terms, weights, thresholds) and what the driver collects (the same and their counts).

Defined results: a null text, of a document or a query, has no terms. Documents without a
term do not count; an item without one has no rows. Each row is a document or an item of
its own, also when its id repeats or is null; null ids come last among equal scores. Texts
of any length are counted whole. An empty table gives an empty result. Other columns
are left out and may have any name.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterline.llm.common import stored, text_or_empty

TOP = 50
#: Bytes of query text that are searched for at one time.
QUERY_BYTES = 1 << 20
#: Documents of a shard, and of a block about.
SHARD_DOCS = 2048
BLOCK_DOCS = 32
#: Dimensions of the random projections that tell how alike documents are.
SKETCH_DIMS = 16
#: Rarest terms of a query whose lists give its first threshold.
SEED_TERMS = 6
#: Candidates a query gathers before they are cut to the best.
HELD = 4 * TOP
#: Terms counted at one time.
COUNTED = 1 << 20

# The bytes that separate terms; A-Z are lower-cased and nothing else is.
SEPARATORS = [*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]
TERM_BYTES = bytes(
    0x20 if byte in SEPARATORS else byte + 32 if 0x41 <= byte <= 0x5A else byte for byte in range(256)
)


def terms_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(TERM_BYTES).split()


class Queries:
    """The queries of a turn: ``terms[ends[q - 1] : ends[q]]`` are those of query ``q``, rarest first."""

    def __init__(self, texts: list[str]) -> None:
        self.number: dict[bytes, int] = {}
        self.lists = []
        for text in texts:
            found = sorted(set(terms_of(text)))
            self.lists.append([self.number.setdefault(term, len(self.number)) for term in found])

    def weigh(self, documents: int, total: int, frequencies: dict[int, int]) -> None:
        """Fixed by the whole corpus: its documents with a term, their terms, and each term's documents."""
        self.documents, self.total = documents, total
        frequency = np.array([frequencies.get(term, 0) for term in range(len(self.number))], dtype=np.int64)
        self.weights = np.array(
            [math.floor(1000 * math.log((2 * documents + 2) / (2 * int(df) + 1))) for df in frequency], dtype=np.int64
        )
        self.ends = np.cumsum([len(terms) for terms in self.lists])
        ordered = [sorted(terms, key=lambda term: (frequency[term], term)) for terms in self.lists]
        self.terms = np.array([term for terms in ordered for term in terms], dtype=np.int64)
        self.owner = np.repeat(np.arange(len(self.lists)), [len(terms) for terms in self.lists])
        self.directions = np.random.default_rng(23).standard_normal((len(self.number), SKETCH_DIMS))

    def of(self, query: int) -> np.ndarray:
        return self.terms[self.ends[query - 1] if query else 0 : self.ends[query]]


def counted(number: dict[bytes, int]):
    """(id, text) to (id, n, terms, counts): all terms of a text, and the counts of those with a number."""

    def made(ids: pa.Array, sizes: list[int], found: list[list[int]]) -> pa.RecordBatch:
        lengths = np.array([len(row) for row in found], dtype=np.int64)
        flat = np.fromiter(chain.from_iterable(found), dtype=np.int64, count=lengths.sum())
        keys, counts = np.unique(np.repeat(np.arange(len(found)), lengths) << 32 | flat, return_counts=True)
        ends = pa.array(np.searchsorted(keys, np.arange(len(found) + 1) << 32).astype(np.int32))
        lists = [pa.array((keys & 0xFFFFFFFF).astype(np.int32)), pa.array(counts.astype(np.int64))]
        return pa.RecordBatch.from_arrays(
            [ids, pa.array(sizes, pa.int64()), *(pa.ListArray.from_arrays(ends, part) for part in lists)],
            ["id", "n", "terms", "counts"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = number.get
        for batch in batches:
            begun, held, sizes, found = 0, 0, [], []
            for at, text in enumerate(batch.column(1)):
                words = terms_of(text.as_py())
                sizes.append(len(words))
                found.append([term for term in map(known, words) if term is not None])
                held += len(found[-1])
                if held >= COUNTED:
                    yield made(batch.column(0).slice(begun, len(found)), sizes, found)
                    begun, held, sizes, found = at + 1, 0, [], []
            if found:
                yield made(batch.column(0).slice(begun, len(found)), sizes, found)

    return run


class Vectors:
    """Documents of the forward table as rows of a sparse matrix of impacts, without zeros."""

    def __init__(self, batch: pa.RecordBatch, queries: Queries) -> None:
        column = {name: batch.column(at) for at, name in enumerate(batch.schema.names)}
        n = column["n"].to_numpy().tolist()
        # Lengths enter in Python's integers, as their product with the corpus may pass 64 bits.
        spread = np.array([50 + (50 * size * queries.documents) // queries.total if size else 0 for size in n], dtype=np.int64)
        lengths = column["terms"].value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        owner = np.repeat(np.arange(len(lengths)), lengths)
        terms = column["terms"].flatten().to_numpy().astype(np.int64)
        counts = column["counts"].flatten().to_numpy().astype(np.int64)
        impacts = queries.weights[terms] * ((1_000_000_000 * counts) // (1000 * counts + 20 * spread[owner]))
        some = impacts > 0
        self.owner, self.terms, self.impacts = owner[some], terms[some], impacts[some]
        self.starts = np.searchsorted(self.owner, np.arange(len(lengths) + 1))
        self.size = len(lengths)

    def entries(self, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the coordinates of the documents are, and where each one's begin among them."""
        lengths = self.starts[docs + 1] - self.starts[docs]
        before = np.cumsum(lengths) - lengths
        return np.repeat(self.starts[docs] - before, lengths) + np.arange(lengths.sum()), before

    def projected(self, queries: Queries) -> np.ndarray:
        """Random projections of the documents, of length 1."""
        out = np.zeros((self.size, SKETCH_DIMS))
        filled = np.flatnonzero(np.diff(self.starts))
        if len(filled):
            spread = queries.directions[self.terms] * self.impacts[:, None]
            out[filled] = np.add.reduceat(spread, self.starts[filled])
        return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)

    def scores(self, docs: np.ndarray, wanted: np.ndarray, mask: np.ndarray) -> np.ndarray:
        """The sums of the documents, each with a coordinate at least, over the terms ``wanted``."""
        mask[wanted] = True
        places, before = self.entries(docs)
        sums = np.add.reduceat(np.where(mask[self.terms[places]], self.impacts[places], 0), before)
        mask[wanted] = False
        return sums


class Best:
    """The best candidates of each query so far, and the thresholds they give."""

    def __init__(self, queries: int, top: int, least: np.ndarray) -> None:
        self.top, self.least = top, least.copy()
        self.held: list[list[tuple]] = [[] for _ in range(queries)]

    def add(self, query: int, candidates: list[tuple]) -> None:
        """Candidates are (-score, id is null, id, row)."""
        held = self.held[query]
        held.extend(candidates)
        if len(held) >= HELD:
            self.cut(query)

    def cut(self, query: int) -> None:
        held = self.held[query]
        held.sort()
        del held[self.top :]
        if len(held) == self.top:
            self.least[query] = max(self.least[query], -held[-1][0])


def seeded(queries: Queries, top: int):
    """Rows (query, score): the scores of documents that are best on a query's rarest terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank = np.arange(len(queries.terms)) - (queries.ends - np.diff(queries.ends, prepend=0))[queries.owner]
        seeds = np.flatnonzero(rank < SEED_TERMS)
        seeds = seeds[np.argsort(queries.terms[seeds], kind="stable")]
        starts = np.searchsorted(queries.terms[seeds], np.arange(len(queries.number) + 1))
        mask = np.zeros(len(queries.number), dtype=bool)
        best: list[list[int]] = [[] for _ in queries.lists]
        for batch in batches:
            vectors = Vectors(batch, queries)
            fans = starts[vectors.terms + 1] - starts[vectors.terms]
            entries = np.repeat(np.arange(len(fans)), fans)
            fanned = np.repeat(starts[vectors.terms] - (np.cumsum(fans) - fans), fans) + np.arange(fans.sum())
            pairs = queries.owner[seeds[fanned]] * vectors.size + vectors.owner[entries]
            pairs, at = np.unique(pairs, return_inverse=True)
            sums = np.bincount(at, vectors.impacts[entries], len(pairs))
            asked = pairs // vectors.size
            order = np.lexsort((-sums, asked))
            first = np.searchsorted(asked, asked)
            chosen = np.sort(order[np.arange(len(order)) - first[order] < top]) if len(order) else order
            for query in np.unique(asked[chosen]):
                docs = pairs[chosen[asked[chosen] == query]] % vectors.size
                found = best[query] + vectors.scores(docs, queries.of(query), mask).tolist()
                best[query] = sorted(found, reverse=True)[:top]
        rows = [(query, score) for query, found in enumerate(best) for score in found]
        if rows:
            asked, scores = zip(*rows)
            yield pa.RecordBatch.from_arrays([pa.array(asked, pa.int32()), pa.array(scores, pa.int64())], ["query", "score"])

    return run


def sketched(queries: Queries):
    """Rows of the forward table with the signs of their projections as one number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            signs = Vectors(batch, queries).projected(queries) > 0
            sketch = signs @ (1 << np.arange(SKETCH_DIMS)[::-1])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(sketch.astype(np.int32))], [*batch.schema.names, "sketch"]
            )

    return run


def blocks_of(docs: np.ndarray, projected: np.ndarray) -> list[np.ndarray]:
    """A list's documents, each with the most similar of some that are picked evenly from it."""
    if len(docs) <= BLOCK_DOCS:
        return [docs]
    centres = projected[docs[BLOCK_DOCS // 2 :: BLOCK_DOCS]]
    nearest = np.argmax(projected[docs] @ centres.T, axis=1)
    order = np.argsort(nearest, kind="stable")
    cuts = np.flatnonzero(np.diff(nearest[order])) + 1
    return np.split(docs[order], cuts)


class Shard:
    """The posting lists of some documents, and the search through their blocks."""

    def __init__(self, vectors: Vectors, queries: Queries) -> None:
        self.vectors, self.queries = vectors, queries
        self.projected = vectors.projected(queries)
        order = np.argsort(vectors.terms, kind="stable")
        self.posted = vectors.owner[order]
        self.starts = np.searchsorted(vectors.terms[order], np.arange(len(queries.number) + 1))
        self.summary = np.zeros(len(queries.number), dtype=np.int64)
        self.mask = np.zeros(len(queries.number), dtype=bool)
        self.scored = 0

    def summarise(self, docs: np.ndarray) -> np.ndarray:
        """The greatest impact of each coordinate over the documents; gives the coordinates set."""
        places, _ = self.vectors.entries(docs)
        touched = self.vectors.terms[places]
        np.maximum.at(self.summary, touched, self.vectors.impacts[places])
        return touched

    def visits(self, least: np.ndarray) -> np.ndarray:
        """Places in ``queries.terms`` of the lists whose own summary reaches the query's threshold."""
        queries = self.queries
        self.summarise(np.arange(self.vectors.size))
        greatest = self.summary[queries.terms]
        self.summary[:] = 0
        sums = np.concatenate([[0], np.cumsum(greatest)])
        from_here = sums[queries.ends[queries.owner]] - sums[:-1]
        return np.flatnonzero((greatest > 0) & (from_here >= least[queries.owner]))

    def search(self, best: Best, ids: list, rows: list[int]) -> None:
        queries, vectors = self.queries, self.vectors
        seen = np.zeros((len(queries.lists), vectors.size), dtype=bool)
        visits = self.visits(best.least)
        visits = visits[np.argsort(queries.terms[visits], kind="stable")]
        visited = queries.terms[visits]
        for start, end in zip(*bounds_of_runs(visited)):
            places = visits[start:end]
            asking = queries.owner[places]
            lengths = queries.ends[asking] - places
            before = np.cumsum(lengths) - lengths
            counted_terms = queries.terms[np.repeat(places - before, lengths) + np.arange(lengths.sum())]
            term = visited[start]
            posted = self.posted[self.starts[term] : self.starts[term + 1]]
            for block in blocks_of(posted, self.projected):
                touched = self.summarise(block)
                bounds = np.add.reduceat(self.summary[counted_terms], before)
                self.summary[touched] = 0
                for query in asking[bounds >= best.least[asking]]:
                    fresh = block[~seen[query, block]]
                    if not len(fresh):
                        continue
                    seen[query, fresh] = True
                    self.scored += len(fresh)
                    scores = vectors.scores(fresh, queries.of(query), self.mask)
                    good = np.flatnonzero(scores >= best.least[query])
                    best.add(
                        query,
                        [
                            (-score, ids[doc] is None, ids[doc], rows[doc])
                            for score, doc in zip(scores[good].tolist(), fresh[good].tolist())
                        ],
                    )


def bounds_of_runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where runs of equal values begin and end."""
    if not len(values):
        return values, values
    cuts = np.flatnonzero(np.diff(values)) + 1
    return np.concatenate([[0], cuts]), np.concatenate([cuts, [len(values)]])


def searched(queries: Queries, least: np.ndarray, top: int, id_type: pa.DataType):
    """Rows of the forward table, similar ones close, to the best rows (query, score, id, row) of the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(len(queries.lists), top, least)
        for batch in batches:
            for start in range(0, batch.num_rows, SHARD_DOCS):
                part = batch.slice(start, SHARD_DOCS)
                shard = Shard(Vectors(part, queries), queries)
                shard.search(best, part.column(0).to_pylist(), part.column(1).to_pylist())
                for query in range(len(queries.lists)):
                    best.cut(query)
        found = [(query, -row[0], row[2], row[3]) for query, held in enumerate(best.held) for row in held]
        if found:
            columns = [pa.array(column, kind) for column, kind in zip(zip(*found), (pa.int32(), pa.int64(), id_type, pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["query", "score", "id", "row"])

    return run


def weighed(queries: Queries, forward: DataFrame) -> bool:
    """Sets the terms' weights by counts over the whole corpus; false if no document has a term."""
    total = forward.agg(F.count(F.when(F.col("n") > 0, 1)).alias("documents"), F.sum("n").alias("terms")).first()
    if not total["documents"]:
        return False
    frequencies = forward.select(F.explode("terms").alias("term")).groupBy("term").count().collect()  # one per query term
    queries.weigh(total["documents"], total["terms"], {row["term"]: row["count"] for row in frequencies})
    return True


def first_thresholds(queries: Queries, forward: DataFrame, top: int) -> np.ndarray:
    """Per query a score that its K-th best document reaches, at least 1."""
    scores = forward.mapInArrow(seeded(queries, top), "query int, score long")
    ranked = scores.withColumn("place", F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"))))
    least = np.ones(len(queries.lists), dtype=np.int64)
    for row in ranked.filter(F.col("place") == top).collect():  # one per query of the turn
        least[row["query"]] = max(1, row["score"])
    return least


def ranked_search(
    docs: DataFrame,
    items: DataFrame,
    top: int = TOP,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """A row per item and each of its ``top`` best documents: item, rank from 1, document, score."""
    texts = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    asked = items.select(
        F.col(item_col).alias("item"),
        text_or_empty(item_text_col).alias("text"),
        F.monotonically_increasing_id().alias("number"),
    )
    id_type = texts.schema["id"].dataType.simpleString()
    size = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    turns = -(-size // QUERY_BYTES)
    turn = F.pmod(F.xxhash64("number"), F.lit(max(turns, 1)))
    found = None
    for number in range(turns):
        turn_items = asked.filter(turn == number).collect()  # QUERY_BYTES of text about
        queries = Queries([row["text"] for row in turn_items])
        schema = f"id {id_type}, n long, terms array<int>, counts array<long>"
        rows = texts.mapInArrow(counted(queries.number), schema)
        forward = stored(rows.select("id", F.monotonically_increasing_id().alias("row"), "n", "terms", "counts"), "forward")
        if not weighed(queries, forward):
            continue
        least = first_thresholds(queries, forward, top)
        near = forward.mapInArrow(sketched(queries), forward_schema(forward) + ", sketch int")
        dealt = near.repartitionByRange("sketch", "row").sortWithinPartitions("sketch", "row").drop("sketch")
        best = dealt.mapInArrow(
            searched(queries, least, top, arrow_type(id_type)), f"query int, score long, id {id_type}, row long"
        )
        order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("id"), "row")
        best = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
        names = F.broadcast(
            docs.sparkSession.createDataFrame(
                [(query, row["item"]) for query, row in enumerate(turn_items)],
                f"query int, item {asked.schema['item'].dataType.simpleString()}",
            )
        )
        best = best.join(names, "query").select("item", "rank", "id", "score")
        found = best if found is None else found.unionByName(best)
    if found is None:
        nothing = [F.lit(None).cast(kind).alias(name) for name, kind in (("rank", "int"), ("id", id_type), ("score", "long"))]
        found = asked.filter("false").select("item", *nothing)
    return found.toDF(item_col, "rank", id_col, "score")


def forward_schema(forward: DataFrame) -> str:
    return ", ".join(f"{field.name} {field.dataType.simpleString()}" for field in forward.schema.fields)


def arrow_type(simple: str) -> pa.DataType:
    """The Arrow type of an id column."""
    return {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[simple]
