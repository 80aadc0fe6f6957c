"""A quality classifier trained by co-training on two views of a document.

The text view has the content alone: shares of hashed byte trigrams, how concentrated
they are, and shares of kinds of bytes. The metadata view has what is known about the
page beside its content: host and path of its source, language and length. Each view trains a
logistic regression, calibrated on labelled rows kept apart. In each round both views
score all unlabelled documents, and each labels those it is surest of for the other
one; documents with the same text and metadata count as one. At the end a small
logistic regression on both calibrated views scores every document.

Only the labelled rows are a sample: at most ``labelled`` documents, those with the
smallest hashes of their ids, and one row of each. The views hand over at most ``pool``
unlabelled documents in all. The features of both, 4 kB a row, and the surest scores of
a round are all that reaches the driver. Scoring reads every document whole.

Defined results: a null text counts as empty, a null source or language as a value of
its own. Labels that are null, or of a null id, are ignored; of several labels of a
document the mean counts, and a half is good. Without labels of both kinds nothing can
be learnt, and every document is kept with score 1. Repeated rows get the same score.
Texts of any length are read whole, in pieces. An empty table gives an empty result.
Columns ``score`` and ``kept`` are replaced, others kept, whatever their names.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterline.llm.common import apart, named_back, stored

LABELLED = 4000
POOL = 4000
ROUNDS = 3
#: Pseudo-labels that a view hands over in a round, and how sure it must be of each.
HANDED_OVER = 300
SURE = 0.97
KEEP_SCORE = 0.5
#: Rows whose features are held at a time.
SCORED = 256
#: Penalty and steps of the fits on one or two logits.
FEW = (1e-4, 1000)
TRIGRAM_BINS = 1024
META_BINS = 32
PIECE = 1 << 20


def text_view(data: bytes) -> np.ndarray:
    """Square roots of the shares of hashed trigrams, and measures of how trigrams and words repeat."""
    counts = np.zeros(TRIGRAM_BINS, np.int64)
    for start in range(0, max(len(data) - 2, 0), PIECE):
        b = np.frombuffer(data, np.uint8, min(PIECE + 2, len(data) - start), start).astype(np.uint32)
        mixed = (b[:-2] * 65599 + b[1:-1] * 257 + b[2:]) * np.uint32(2654435761)
        counts += np.bincount(mixed >> np.uint32(22), minlength=TRIGRAM_BINS)
    total = max(counts.sum(), 1)
    shares = counts / total
    spread = -np.log(max((shares**2).sum(), 1 / TRIGRAM_BINS)) / np.log(TRIGRAM_BINS)
    distinct = np.count_nonzero(counts) / min(total, TRIGRAM_BINS)
    words = data.split()
    unlike = len(set(words)) / max(len(words), 1)
    doubled = sum(map(bytes.__eq__, words, words[1:])) / max(len(words), 1)
    kinds = np.bincount(BYTE_KIND[np.frombuffer(data, np.uint8)], minlength=KINDS) / max(len(data), 1)
    lines = np.log1p(len(data) / (data.count(b"\n") + 1)) / 10
    return np.concatenate([np.sqrt(shares), np.sqrt(kinds), [spread, distinct, unlike, doubled, lines]]).astype(np.float32)


def meta_view(size: int, source: str | None, lang: str | None) -> np.ndarray:
    """Bins of host, path and language, the first for null, the depth of the path and the length in bytes."""
    host, _, path = ("" if source is None else source.split("://")[-1]).partition("/")
    named = np.zeros(3 * META_BINS, np.float32)
    for at, value in enumerate((None if source is None else host, path, lang)):
        named[at * META_BINS + (0 if value is None else 1 + zlib.crc32(value.encode()) % (META_BINS - 1))] = 1
    return np.concatenate([named, [np.log1p(path.count("/")), np.log1p(size) / 10]]).astype(np.float32)


def byte_kinds() -> np.ndarray:
    """Kind of each byte: other ASCII, space, line end, lower, upper, digit, and punctuation by thirds."""
    kind = np.zeros(256, np.int64)
    kind[32], kind[10] = 1, 2
    kind[ord("a") : ord("z") + 1] = 3
    kind[ord("A") : ord("Z") + 1] = 4
    kind[ord("0") : ord("9") + 1] = 5
    kind[list(b".,;:'\"()-")] = 6
    kind[list(b"!?")] = 7
    kind[list(b"#*$%&|<>_=+/\\@^~{}[]`")] = 8
    kind[128:] = 9
    return kind


BYTE_KIND = byte_kinds()
KINDS = 10


@dataclass
class Logistic:
    """Logistic regression on standardised features."""

    shift: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float

    def logit(self, x: np.ndarray) -> np.ndarray:
        return (x - self.shift) / self.scale @ self.weights + self.bias


def fit_logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1e-2, steps: int = 200) -> Logistic:
    """Accelerated gradient descent on the penalised mean loss."""
    shift, scale = x.mean(axis=0), x.std(axis=0) + 1e-3
    z1 = np.ones((len(x), x.shape[1] + 1), np.float32)
    np.divide(x - shift, scale, out=z1[:, :-1], casting="same_kind")
    curvature = 0.25 * power_norm(z1) / len(z1) + penalty
    w = ahead = np.zeros(z1.shape[1])
    y = np.asarray(y, float)
    for step in range(steps):
        gradient = z1.T @ (sigmoid(z1 @ ahead) - y) / len(z1) + penalty * np.append(ahead[:-1], 0)
        new = ahead - gradient / curvature
        ahead = new + step / (step + 3) * (new - w)
        w = new
    return Logistic(shift, scale, w[:-1], float(w[-1]))


def power_norm(z: np.ndarray) -> float:
    """The largest eigenvalue of z'z, a little over."""
    v = np.ones(z.shape[1])
    for _ in range(20):
        v = z.T @ (z @ (v / np.linalg.norm(v)))
    return 1.1 * float(np.linalg.norm(v))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class View:
    """A view's model with its calibration: probability = sigmoid(a * logit + b)."""

    model: Logistic
    a: float
    b: float

    def calibrated(self, x: np.ndarray) -> np.ndarray:
        return self.a * self.model.logit(x) + self.b


def fit_view(x: np.ndarray, y: np.ndarray, held_x: np.ndarray, held_y: np.ndarray) -> View:
    model = fit_logistic(x, y)
    platt = fit_logistic(model.logit(held_x)[:, None], held_y, *FEW)
    a = platt.weights[0] / platt.scale[0]
    return View(model, float(a), float(platt.bias - a * platt.shift[0]))


def surest(logits: np.ndarray, free: np.ndarray, count: int, share: float | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Places and labels of the unlabelled rows of which a view is surest, kinds in its own proportion.

    ``share`` is that of good ones where the rows are not all that the view has seen.
    """
    p = sigmoid(logits)
    sure = np.flatnonzero(free & (np.maximum(p, 1 - p) >= SURE))
    good = sure[p[sure] > 0.5]
    bad = sure[p[sure] <= 0.5]
    share = float((p > 0.5).mean()) if share is None else share
    chosen = [
        rows[np.argsort(-np.abs(logits[rows]), kind="stable")[: max(1, round(part * count))]]
        for rows, part in ((good, share), (bad, 1 - share))
    ]
    places = np.concatenate(chosen)
    return places, (p[places] > 0.5).astype(float)


@dataclass
class CoTrained:
    views: list[View]
    combiner: Logistic

    def score(self, features: list[np.ndarray]) -> np.ndarray:
        logits = np.column_stack([view.calibrated(x) for view, x in zip(self.views, features)])
        return sigmoid(self.combiner.logit(logits))


def co_train(labelled: list[np.ndarray], y: np.ndarray, handed: list[np.ndarray]) -> CoTrained | None:
    """Both views of the labelled rows and of the rows handed over to each, with their label as the last column.

    Every fourth labelled row is kept for calibration.
    """
    held = np.arange(len(y)) % 4 == 3
    if any(len(set(part.tolist())) < 2 for part in (y[held], y[~held])):
        return None
    views = []
    for x, more in zip(labelled, handed):
        both, marked = np.vstack([x[~held], more[:, :-1]]), np.concatenate([y[~held], more[:, -1]])
        views.append(fit_view(both, marked, x[held], y[held]))
    logits = np.column_stack([view.calibrated(x[held]) for view, x in zip(views, labelled)])
    return CoTrained(views, fit_logistic(logits, y[held], *FEW))


def features_of(batch: pa.RecordBatch, text_at: int, source_at: int, lang_at: int) -> list[np.ndarray]:
    content, meta = [], []
    for text, source, lang in zip(*(batch.column(i) for i in (text_at, source_at, lang_at))):
        data = (text.as_py() or "").encode()
        content.append(text_view(data))
        meta.append(meta_view(len(data), source.as_py(), lang.as_py()))
    return [np.array(content), np.array(meta)]


def sample_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, text view, metadata view) of sampled rows (key, text, source, lang)."""
    for batch in batches:
        views = [[x.tobytes() for x in view] for view in features_of(batch, 1, 2, 3)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *(pa.array(view, pa.binary()) for view in views)], ["key", "content", "meta"]
        )


def as_views(table) -> list[np.ndarray]:
    return [np.array([np.frombuffer(x, np.float32) for x in table[name]]) for name in ("content", "meta")]


def view_logits(model: CoTrained):
    """(id, h, content, meta): what each view finds of a row (id, h, text, source, lang)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.zeros(batch.num_rows) for _ in model.views]
            for at in range(0, batch.num_rows, SCORED):
                for view, x, out in zip(model.views, features_of(batch.slice(at, SCORED), 2, 3, 4), found):
                    out[at : at + SCORED] = view.calibrated(x)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *map(pa.array, found)], ["id", "h", "content", "meta"])

    return run


def hand_over(model: CoTrained, rows: DataFrame, marks: DataFrame, given: list[set[int]], count: int) -> list[np.ndarray]:
    """For each view the rows that the other one is surest of among all unlabelled ones, and their labels.

    ``given`` holds what each view was handed before, and is added to.
    """
    id_type = rows.schema["id"].dataType.simpleString()
    logits = rows.select("id", "h", "text", "source", "lang").mapInArrow(
        view_logits(model), f"id {id_type}, h long, content double, meta double"
    )
    free = logits.join(marks.select("id"), "id", "left_anti")
    free = stored(free.groupBy("h").agg(F.max("content").alias("content"), F.max("meta").alias("meta")), "logits")
    good = free.agg(*(F.avg((F.col(name) > 0).cast("double")).alias(name) for name in ("content", "meta"))).first()
    labels: list[dict[int, float]] = [{}, {}]
    for giver, name in enumerate(("content", "meta")):
        taker = 1 - giver
        best = []
        for kind in (F.col(name) > 0, F.col(name) <= 0):
            order = (F.abs(name).desc(), "h")
            best += free.filter(kind).orderBy(*order).limit(count + len(given[taker])).select("h", name).collect()
        if best:
            open_to = np.array([row["h"] not in given[taker] for row in best])
            places, found = surest(np.array([row[name] for row in best]), open_to, count, good[name])
            labels[taker] = {best[i]["h"]: mark for i, mark in zip(places.tolist(), found.tolist())}
            given[taker].update(labels[taker])
    chosen = sorted({h for part in labels for h in part})
    winners = rows.sparkSession.createDataFrame([(h,) for h in chosen], "h long")
    one = F.max(F.struct("text", "source", "lang")).alias("one")
    texts = rows.join(F.broadcast(winners), "h").groupBy("h").agg(one).select("h", "one.text", "one.source", "one.lang")
    table = texts.mapInArrow(sample_features, "key long, content binary, meta binary").toPandas().sort_values("key")
    handed = []
    for x, part in zip(as_views(table), labels):
        marked = [(i, part[h]) for i, h in enumerate(table["key"].tolist()) if h in part]
        handed.append(np.array([np.append(x[i], mark) for i, mark in marked], np.float32))
    return handed


def fit_sample(
    docs: DataFrame, labels: DataFrame, id_col: str, label_col: str, text_col: str, meta_cols: tuple[str, str],
    labelled: int, pool: int,
) -> CoTrained | None:
    """The model of a bounded sample of labelled and of all unlabelled documents."""
    marks = (
        labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("double").alias("quality"))
        .dropna()
        .groupBy("id")
        .agg((F.avg("quality") >= 0.5).cast("int").alias("quality"))
    )
    ids = docs.select(F.col(id_col).alias("id")).dropna().distinct()
    known = ids.join(marks, "id").orderBy(F.xxhash64("id"), "id").limit(labelled)
    source, lang = meta_cols
    rows = docs.select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(source).alias("source"), F.col(lang).alias("lang")
    )
    # A null leaves the hash as it is, hence the flags.
    given = F.coalesce("text", F.lit("")), F.isnull("source"), F.col("source"), F.isnull("lang"), F.col("lang")
    rows = rows.withColumn("h", F.xxhash64(*given))
    # Repeated rows of a sampled id could be any number: one of them, so that the limit holds.
    one = F.max(F.struct("h", "text", "source", "lang")).alias("one")
    sample = rows.join(F.broadcast(known), "id").groupBy("id", "quality").agg(one)
    sample = sample.select("quality", "one.text", "one.source", "one.lang")
    features = sample.mapInArrow(sample_features, "key int, content binary, meta binary")
    table = features.orderBy("key", F.xxhash64("content", "meta")).toPandas()
    if table.empty:
        return None
    # Rows are by quality; every stretch of the held-out rows must have both kinds.
    mix = np.random.default_rng(7).permutation(len(table))
    views, y = [x[mix] for x in as_views(table)], table["key"].to_numpy()[mix].astype(float)
    handed = [np.zeros((0, x.shape[1] + 1), np.float32) for x in views]
    model = co_train(views, y, handed)
    given_before: list[set[int]] = [set(), set()]
    count = min(HANDED_OVER, pool // (2 * ROUNDS))
    for _ in range(ROUNDS if model is not None and count else 0):
        more = hand_over(model, rows, marks, given_before, count)
        if not any(map(len, more)):
            break
        handed = [np.vstack([x, new]) if len(new) else x for x, new in zip(handed, more)]
        model = co_train(views, y, handed)
    return model


def scored(model: CoTrained | None, text_at: int, source_at: int, lang_at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = np.ones(batch.num_rows)
            for at in range(0, batch.num_rows if model is not None else 0, SCORED):
                scores[at : at + SCORED] = model.score(features_of(batch.slice(at, SCORED), text_at, source_at, lang_at))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(scores), pa.array(scores >= KEEP_SCORE)], [*batch.schema.names, "score", "kept"]
            )

    return run


def quality_scores(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    label_col: str = "quality",
    text_col: str = "text",
    meta_cols: tuple[str, str] = ("source", "lang"),
    labelled: int = LABELLED,
    pool: int = POOL,
) -> DataFrame:
    """All columns with the ``score`` of each document, the probability that it is good, and ``kept``."""
    docs, others = apart(docs.drop("score", "kept"), [])
    id_col, text_col = others.get(id_col, id_col), others.get(text_col, text_col)
    labels = labels.withColumnRenamed(next((old for old, new in others.items() if new == id_col), id_col), id_col)
    meta_cols = tuple(others.get(name, name) for name in meta_cols)
    model = fit_sample(docs, labels, id_col, label_col, text_col, meta_cols, labelled, pool)
    places = [docs.columns.index(name) for name in (text_col, *meta_cols)]
    schema = T.StructType([*docs.schema.fields, T.StructField("score", T.DoubleType()), T.StructField("kept", T.BooleanType())])
    return named_back(docs.mapInArrow(scored(model, *places), schema), others)
