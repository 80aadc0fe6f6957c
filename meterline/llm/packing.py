"""Documents packed into token sequences by a grouping genetic algorithm on islands.

1. Texts become token ids; documents over the capacity are cut into full pieces and
   a shorter first one. A full piece is a sequence of its own.
2. The other pieces form blocks of BLOCK_PIECES. Every block is evolved on ISLANDS
   islands, each a row of a table that Spark deals out. An individual is a grouping
   of the block's pieces into bins. Crossover injects well-filled bins of one parent
   whole into the other, takes away the bins that share pieces with them, and puts
   the displaced pieces where they fit best.
3. After each epoch the best individual of an island migrates to the next one, through
   a table in the shared folder. The best over all islands is the block's packing.
4. The pieces of each block's poorly filled bins meet those of the other blocks in new
   blocks and are packed once more.

Defined results: a null text is empty and gives one piece of the end token. Null and
repeated ids are packed like others, a row each. An empty table gives an empty result.
Other columns are ignored.
"""

from __future__ import annotations

import random
import zlib
from collections.abc import Iterator

import pyarrow as pa
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.llm.byte_bpe import ByteBpe
from meterline.llm.common import stored, text_or_empty

CAPACITY = 1024
END_ID = 2
BLOCK_PIECES = 4096
ISLANDS = 2
EPOCHS = 2
POPULATION = 4
CHILDREN = 5
#: Share of a parent's bins, the best filled, that a crossover injects.
INJECTED = 0.3
#: Bins under this fill are opened again and packed with those of other blocks.
WELL_FILLED = 0.98
TOKENIZER = "byte_bpe_50k.json"


def cut_points(length: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces; the first takes what full pieces leave."""
    first = length % capacity or min(length, capacity)
    return [(0, first), *((start, capacity) for start in range(first, length, capacity))]


def pieces(path: str, capacity: int, end_id: int, keep_ids: bool):
    end = end_id.to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = ByteBpe(path)
        alone = TaskContext.get().partitionId() << 40
        for batch in batches:
            rows, number, starts, lengths, sums, own, ids = [], [], [], [], [], [], []
            for i, text in enumerate(batch.column(1)):
                data = memoryview(encoder.encode(text.as_py()) + end)
                for piece, (start, length) in enumerate(cut_points(len(data) // 4, capacity)):
                    part = data[4 * start : 4 * (start + length)]
                    rows.append(i)
                    number.append(piece)
                    starts.append(start)
                    lengths.append(length)
                    sums.append(zlib.crc32(part))
                    alone += length == capacity
                    own.append(-alone if length == capacity else None)
                    if keep_ids:
                        ids.append(part.cast("I").tolist())
            columns = {
                "id": batch.column(0).take(pa.array(rows, pa.int64())),
                "piece": pa.array(number, pa.int32()),
                "start": pa.array(starts, pa.int64()),
                "length": pa.array(lengths, pa.int64()),
                "ids_crc32": pa.array(sums, pa.int64()),
                "sequence_id": pa.array(own, pa.int64()),
            }
            if keep_ids:
                columns["ids"] = pa.array(ids, pa.list_(pa.int32()))
            yield pa.RecordBatch.from_pydict(columns)

    return run


class Packing:
    """Bins of piece numbers; ``room`` has the bins by their free space, a bit set for each space in use."""

    def __init__(self, sizes: list[int], capacity: int) -> None:
        self.sizes, self.capacity = sizes, capacity
        self.bins: list[list[int]] = []
        self.room: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.spaces = 0

    def offer(self, at: int, space: int) -> None:
        self.room[space].append(at)
        self.spaces |= 1 << space

    def add_bin(self, members: list[int]) -> None:
        self.bins.append(members)
        self.offer(len(self.bins) - 1, self.capacity - sum(self.sizes[i] for i in members))

    def best_fit(self, piece: int) -> None:
        size = self.sizes[piece]
        fitting = self.spaces >> size
        if not fitting:
            self.add_bin([piece])
            return
        space = size + (fitting & -fitting).bit_length() - 1
        at = self.room[space].pop()
        if not self.room[space]:
            self.spaces ^= 1 << space
        self.bins[at].append(piece)
        self.offer(at, space - size)


def packed(sizes: list[int], capacity: int, order: list[int], bins: list[list[int]] = ()) -> list[list[int]]:
    state = Packing(sizes, capacity)
    for members in bins:
        state.add_bin(list(members))
    for piece in order:
        state.best_fit(piece)
    return state.bins


def fill(sizes: list[int], members: list[int]) -> int:
    return sum(sizes[i] for i in members)


def fitness(sizes: list[int], bins: list[list[int]]) -> tuple[int, float]:
    """Fewer bins first; of as many, the more uneven their fill."""
    return -len(bins), sum(fill(sizes, members) ** 2 for members in bins)


def crossover(sizes: list[int], capacity: int, into: list[list[int]], donor: list[list[int]], rng: random.Random) -> list[list[int]]:
    best = sorted(donor, key=lambda members: -fill(sizes, members))
    best = best[: max(1, len(best) // 2)]
    injected = rng.sample(best, max(1, int(INJECTED * len(best))))
    inside = {i for members in injected for i in members}
    kept, displaced = [], []
    for members in into:
        if inside.isdisjoint(members):
            kept.append(members)
        else:
            displaced.extend(i for i in members if i not in inside)
    # The emptiest bins that stay are opened too, so that their pieces can fill others.
    kept.sort(key=lambda members: -fill(sizes, members))
    while kept and fill(sizes, kept[-1]) < WELL_FILLED * capacity:
        displaced.extend(kept.pop())
    displaced.sort(key=lambda i: -sizes[i])
    return packed(sizes, capacity, displaced, injected + kept)


def first_individuals(sizes: list[int], capacity: int, count: int, rng: random.Random) -> list[list[list[int]]]:
    """Best-fit decreasing, and the same with the sizes blurred."""
    exact = sorted(range(len(sizes)), key=lambda i: -sizes[i])
    orders = [exact]
    for _ in range(count - 1):
        blurred = [size * rng.uniform(0.85, 1.15) for size in sizes]
        orders.append(sorted(range(len(sizes)), key=lambda i: -blurred[i]))
    return [packed(sizes, capacity, order) for order in orders]


def evolved(capacity: int, population: int, children: int, seed: int):
    """An epoch on each island: (block, island, lengths, groups) with the population best first.

    ``groups`` has a bin number for each piece and individual; null starts a population.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                sizes = row["lengths"]
                rng = random.Random(f"{seed} {row['epoch']} {row['block']} {row['island']}")
                lower = -(-sum(sizes) // capacity)
                if row["groups"] is None:
                    people = first_individuals(sizes, capacity, population, rng)
                else:
                    people = [bins_of(numbers) for numbers in row["groups"]]
                people.sort(key=lambda bins: fitness(sizes, bins), reverse=True)
                for _ in range(children):
                    if len(people[0]) == lower:
                        break
                    into, donor = rng.sample(people, 2) if len(people) > 1 else people * 2
                    people.append(crossover(sizes, capacity, into, donor, rng))
                    people.sort(key=lambda bins: fitness(sizes, bins), reverse=True)
                    del people[population:]
                out.append(row | {"groups": [numbers_of(bins, len(sizes)) for bins in people]})
            yield pa.RecordBatch.from_pylist(out, schema=batch.schema)

    return run


def bins_of(numbers: list[int]) -> list[list[int]]:
    bins: list[list[int]] = [[] for _ in range(max(numbers, default=-1) + 1)]
    for piece, at in enumerate(numbers):
        bins[at].append(piece)
    return [members for members in bins if members]


def numbers_of(bins: list[list[int]], count: int) -> list[int]:
    numbers = [0] * count
    for at, members in enumerate(bins):
        for piece in members:
            numbers[piece] = at
    return numbers


def blocks(size: int, level: int):
    """Rows of pieces gathered into rows of blocks, a list per column."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = (level << 50) + (TaskContext.get().partitionId() << 20)
        rest = None
        for batch in batches:
            rest = pa.Table.from_batches([batch]) if rest is None else pa.concat_tables([rest, pa.Table.from_batches([batch])])
            while rest.num_rows >= size:
                yield block_row(rest.slice(0, size), made)
                rest, made = rest.slice(size), made + 1
        if rest is not None and rest.num_rows:
            yield block_row(rest, made)

    return run


def block_row(rows: pa.Table, block: int) -> pa.RecordBatch:
    columns = {"block": pa.array([block], pa.int64())}
    for name in rows.column_names:
        column = rows[name].combine_chunks()
        columns[f"{name}s"] = pa.ListArray.from_arrays(pa.array([0, len(column)], pa.int32()), column)
    return pa.RecordBatch.from_pydict(columns)


def placements(capacity: int, reopen: bool):
    """A row per piece with its sequence and offset; null for pieces of poorly filled bins to ``reopen``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                lengths = batch["lengths"][at].as_py()
                sequences: list[int | None] = [None] * len(lengths)
                offsets: list[int | None] = [None] * len(lengths)
                for number, members in enumerate(bins_of(batch["best"][at].as_py())):
                    if reopen and fill(lengths, members) < WELL_FILLED * capacity:
                        continue
                    offset = 0
                    for i in members:
                        sequences[i], offsets[i] = batch["block"][at].as_py() * BLOCK_PIECES + number, offset
                        offset += lengths[i]
                columns = {
                    name[:-1]: batch[name][at].values for name in batch.schema.names if name not in ("block", "best")
                }
                columns["sequence_id"] = pa.array(sequences, pa.int64())
                columns["offset"] = pa.array(offsets, pa.int64())
                yield pa.RecordBatch.from_pydict(columns)

    return run


def evolve_blocks(made: DataFrame, capacity: int, islands: int, epochs: int, seed: int) -> DataFrame:
    """(block, best): the best grouping of each block over all islands."""
    rows = made.select(
        "block",
        F.explode(F.sequence(F.lit(0), F.lit(islands - 1))).alias("island"),
        "lengths",
        F.lit(0).alias("epoch"),
        F.lit(None).cast("array<array<int>>").alias("groups"),
    )
    schema = "block long, island int, lengths array<bigint>, epoch int, groups array<array<int>>"
    count = made.count() * islands
    for epoch in range(epochs):
        dealt = rows.repartition(max(1, min(count, 4096)), "block", "island")
        state = stored(dealt.mapInArrow(evolved(capacity, POPULATION, CHILDREN, seed), schema), "islands")
        elite = state.select(
            "block",
            F.pmod(F.col("island") + 1, F.lit(islands)).alias("island"),
            F.get("groups", F.lit(0)).alias("elite"),
        )
        # The elite of the island before takes the place of the last individual.
        own = F.slice("groups", 1, POPULATION - 1)
        rows = state.join(elite, ["block", "island"]).select(
            "block", "island", "lengths", F.lit(epoch + 1).alias("epoch"), F.concat(own, F.array("elite")).alias("groups")
        )
    best = F.get("groups", F.lit(0))
    return state.groupBy("block").agg(F.min_by(best, F.struct(F.array_max(best), F.col("island"))).alias("best"))


def pack(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizer: str | None = None,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    keep_ids: bool = False,
    seed: int = 42,
) -> DataFrame:
    """A row per piece: id, piece, start, length, ids_crc32, sequence_id, offset (and ids)."""
    path = tokenizer or public_tokenizers.path(TOKENIZER)
    texts = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    id_type = texts.schema["id"].dataType.simpleString()
    columns = f"id {id_type}, piece int, start long, length long, ids_crc32 long"
    if keep_ids:
        columns += ", ids array<int>"
    names = [field.split(" ")[0] for field in columns.split(", ")]
    schema = f"id {id_type}, piece int, start long, length long, ids_crc32 long, sequence_id long"
    cut = stored(
        texts.mapInArrow(pieces(path, capacity, end_id, keep_ids), schema + (", ids array<int>" if keep_ids else "")),
        "pieces",
    )
    done = cut.filter("sequence_id IS NOT NULL").select(*names, "sequence_id", F.lit(0).cast("long").alias("offset"))
    open_pieces = cut.filter("sequence_id IS NULL").select(names)
    listed = ", ".join(f"{field.split(' ')[0]}s array<{field.split(' ')[1]}>" for field in columns.replace("long", "bigint").split(", "))
    for level, reopen in enumerate((True, False)):
        count = open_pieces.count()
        parts = max(1, -(-count // (4 * BLOCK_PIECES)))
        made = stored(
            open_pieces.repartition(parts).mapInArrow(blocks(BLOCK_PIECES, level), f"block long, {listed}"), "blocks"
        )
        best = evolve_blocks(made, capacity, ISLANDS, EPOCHS, seed + level)
        placed = made.join(best, "block").mapInArrow(
            placements(capacity, reopen), f"{columns}, sequence_id long, offset long"
        )
        placed = stored(placed, "placed")
        done = done.unionByName(placed.filter("sequence_id IS NOT NULL"))
        open_pieces = placed.filter("sequence_id IS NULL").select(names)
    return done.withColumnRenamed("id", id_col)
