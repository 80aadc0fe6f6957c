"""Language-model scores by masked pseudo-likelihood.

A word is predicted from the words on both sides of it: position-wise embeddings of a
window's words are added up, pass a tanh layer, and two softmaxes give the word's class
and the word in its class. The score of a document is the sum of the log-probabilities
of all its words, each predicted from its neighbours.

1. Words are counted over all documents; the most frequent get a token each, the others
   share tokens by their hash.
2. Training masks a share of every document's positions and predicts them. Every task
   trains on its own documents from common weights, and the weights are averaged by
   tokens in a tree of shuffles. Each round takes another part of the documents, and
   the rounds together all of them.
3. Scoring predicts every position of every document.

The average over tasks is all that reaches the driver: one set of weights.

Defined results: a null text counts as empty; a document without words has score 0 and a
null mean. Repeated rows get the same score. An empty table gives an empty result.
Columns named like the result's are ignored, as are others but the id and the text.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.llm.common import ascii_lower, stored, text_or_empty
from meterline.llm.quality_rules import words_of
from meterline.llm.simhash import word_pieces

CLASSES = 48
MEMBERS = 48
#: Tokens that words outside the vocabulary share.
SHARED = 304
WIDTH = 16
WINDOW = 2
MASKED = 0.2
RATE = 0.1
ROUNDS = 2
#: Positions predicted together, and trained on together.
BATCH = 16_384
STEP = 2048
MERGED = 32
TOKENS = CLASSES * MEMBERS
EDGE = TOKENS  # what stands before the first and after the last word
OFFSETS = [*range(-WINDOW, 0), *range(1, WINDOW + 1)]


class Vocabulary(dict):
    """Token of each word in bytes; less frequent words by their hash."""

    def __missing__(self, word: bytes) -> int:
        return TOKENS - SHARED + zlib.crc32(word) % SHARED


def frequent_words(texts: DataFrame) -> Vocabulary:
    """The most frequent words of all documents, of equal counts the smaller first."""
    words = texts.select(F.explode(words_of(ascii_lower(F.col("text")))).alias("word"))
    counts = words.groupBy("word").agg(F.count("*").alias("n"))
    rows = counts.orderBy(F.desc("n"), "word").limit(TOKENS - SHARED).collect()
    return Vocabulary({row["word"].encode(): i for i, row in enumerate(rows)})


def tokens_of(text: str, vocabulary: Vocabulary) -> array:
    found = array("i")
    for words in word_pieces(text.encode().lower()):
        found.extend(map(vocabulary.__getitem__, words))
    return found


def first_weights(seed: int) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    shapes = {
        "embed": (len(OFFSETS), TOKENS + 1, WIDTH),
        "hidden": (WIDTH,),
        "class_w": (WIDTH, CLASSES),
        "class_b": (CLASSES,),
        "member_w": (CLASSES, WIDTH, MEMBERS),
        "member_b": (CLASSES, MEMBERS),
    }
    return {
        name: (rng.normal(0, 0.1, shape) if len(shape) > 1 and not name.endswith("_b") else np.zeros(shape)).astype(np.float32)
        for name, shape in shapes.items()
    }


def log_softmax(logits: np.ndarray) -> np.ndarray:
    logits = logits - logits.max(axis=1, keepdims=True)
    return logits - np.log(np.exp(logits).sum(axis=1, keepdims=True))


def hidden_layer(weights: dict[str, np.ndarray], context: np.ndarray) -> np.ndarray:
    total = np.broadcast_to(weights["hidden"], (len(context), WIDTH)).copy()
    for j in range(len(OFFSETS)):
        total += weights["embed"][j][context[:, j]]
    return np.tanh(total)


def by_class(targets: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(class, places of its targets) for the classes that occur."""
    classes = targets // MEMBERS
    order = np.argsort(classes, kind="stable")
    ends = np.cumsum(np.bincount(classes, minlength=CLASSES))
    for c in np.unique(classes):
        yield int(c), order[ends[c - 1] if c else 0 : ends[c]]


def log_probabilities(weights: dict[str, np.ndarray], context: np.ndarray, targets: np.ndarray) -> np.ndarray:
    """Of each target given its window."""
    hidden = hidden_layer(weights, context)
    every = np.arange(len(targets))
    found = log_softmax(hidden @ weights["class_w"] + weights["class_b"])[every, targets // MEMBERS].astype(np.float64)
    for c, rows in by_class(targets):
        inside = log_softmax(hidden[rows] @ weights["member_w"][c] + weights["member_b"][c])
        found[rows] += inside[np.arange(len(rows)), targets[rows] % MEMBERS]
    return found


class Trainer:
    """Adaptive gradient steps on batches of masked positions."""

    def __init__(self, weights: dict[str, np.ndarray]) -> None:
        self.weights = {name: value.copy() for name, value in weights.items()}
        self.squares = {name: np.full(value.shape, 1e-2, np.float32) for name, value in weights.items()}

    def move(self, name: str, gradient: np.ndarray, at=...) -> None:
        self.squares[name][at] += gradient**2
        self.weights[name][at] -= RATE * gradient / np.sqrt(self.squares[name][at])

    def step(self, context: np.ndarray, targets: np.ndarray) -> None:
        w, n = self.weights, len(targets)
        hidden = hidden_layer(w, context)
        every = np.arange(n)
        error = np.exp(log_softmax(hidden @ w["class_w"] + w["class_b"]))
        error[every, targets // MEMBERS] -= 1
        back = error @ w["class_w"].T
        self.move("class_w", hidden.T @ error / n)
        self.move("class_b", error.mean(axis=0))
        for c, rows in by_class(targets):
            inside = np.exp(log_softmax(hidden[rows] @ w["member_w"][c] + w["member_b"][c]))
            inside[np.arange(len(rows)), targets[rows] % MEMBERS] -= 1
            back[rows] += inside @ w["member_w"][c].T
            self.move("member_w", hidden[rows].T @ inside / n, c)
            self.move("member_b", inside.sum(axis=0) / n, c)
        back = back * (1 - hidden**2) / n
        self.move("hidden", back.sum(axis=0))
        for j in range(len(OFFSETS)):
            order = np.argsort(context[:, j], kind="stable")
            words, starts = np.unique(context[order, j], return_index=True)
            self.move("embed", np.add.reduceat(back[order], starts, axis=0), (j, words))


def windows(tokens: np.ndarray, places: np.ndarray) -> np.ndarray:
    """The words around each place, a column per offset; ``tokens`` has edges on both sides."""
    return tokens[places[:, None] + WINDOW + np.array(OFFSETS)]


def padded(tokens: array) -> np.ndarray:
    edge = np.full(WINDOW, EDGE, np.int32)
    return np.concatenate([edge, np.frombuffer(tokens, np.int32), edge]) if tokens else np.concatenate([edge, edge])


def masked_places(count: int, text: str, seed: int) -> np.ndarray:
    """The masked positions of a document: drawn by its own text, whatever its task."""
    rng = np.random.default_rng(zlib.crc32(text.encode()) + seed)
    return np.flatnonzero(rng.random(count) < MASKED)


def trained(weights: dict[str, np.ndarray], vocabulary: Vocabulary, seed: int):
    """A row (weights, positions) of each task that had words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trainer, seen = Trainer(weights), 0
        held: list[tuple[np.ndarray, np.ndarray]] = []
        waiting = 0

        def steps(least: int) -> None:
            nonlocal held, waiting
            if waiting < least or not held:
                return
            context, targets = (np.concatenate(part) for part in zip(*held))
            for at in range(0, len(targets), STEP):
                trainer.step(context[at : at + STEP], targets[at : at + STEP])
            held, waiting = [], 0

        for batch in batches:
            for cell in batch.column(0):
                text = cell.as_py()
                tokens = padded(tokens_of(text, vocabulary))
                places = masked_places(len(tokens) - 2 * WINDOW, text, seed)
                held.append((windows(tokens, places), tokens[places + WINDOW]))
                waiting += len(places)
                seen += len(places)
                steps(STEP)
        steps(1)
        if seen:
            yield merged_row({name: value.astype(np.float64) * seen for name, value in trainer.weights.items()}, seen)

    return run


def merged_row(total: dict[str, np.ndarray], seen: int) -> pa.RecordBatch:
    mean = np.concatenate([(total[name] / seen).ravel() for name in sorted(total)]).astype(np.float32)
    return pa.RecordBatch.from_pydict({"weights": [mean.tobytes()], "seen": pa.array([seen], pa.int64())})


def unpacked(data: bytes, like: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    flat, at, found = np.frombuffer(data, np.float32), 0, {}
    for name in sorted(like):
        found[name] = flat[at : at + like[name].size].reshape(like[name].shape)
        at += like[name].size
    return found


def averaged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, seen = None, 0
    for batch in batches:
        for data, n in zip(batch.column(0), batch.column(1).to_pylist()):
            part = np.frombuffer(data.as_py(), np.float32).astype(np.float64) * n
            total, seen = part if total is None else total + part, seen + n
    if seen:
        yield merged_row({"all": total}, seen)


def train(texts: DataFrame, vocabulary: Vocabulary, seed: int, rounds: int) -> dict[str, np.ndarray]:
    """Weights trained on all documents, a part of them in each round."""
    weights = first_weights(seed)
    part = F.pmod(F.xxhash64("text", F.lit(seed)), F.lit(rounds))
    for turn in range(rounds):
        rows = texts.filter(part == turn).select("text").mapInArrow(
            trained(weights, vocabulary, seed + turn), "weights binary, seen long"
        )
        rows = stored(rows, "weights")
        left = rows.count()
        while left > 1:
            left = -(-left // MERGED)
            rows = rows.repartition(left).mapInArrow(averaged, "weights binary, seen long")
        found = rows.collect()
        if found:
            weights = unpacked(bytes(found[0]["weights"]), weights)
    return weights


def document_score(weights: dict[str, np.ndarray], vocabulary: Vocabulary, text: str) -> tuple[int, float]:
    tokens = padded(tokens_of(text, vocabulary))
    count, total = len(tokens) - 2 * WINDOW, 0.0
    for at in range(0, count, BATCH):
        places = np.arange(at, min(at + BATCH, count))
        total += float(log_probabilities(weights, windows(tokens, places), tokens[places + WINDOW]).sum())
    return count, total


def scores(weights: dict[str, np.ndarray], vocabulary: Vocabulary):
    """(id, n_words, log_probability): short documents are predicted together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, counts, totals = batch.column(0), [], []
            held: list[tuple[np.ndarray, np.ndarray]] = []

            def flush() -> None:
                if held:
                    context, targets = (np.concatenate(part) for part in zip(*held))
                    found = log_probabilities(weights, context, targets)
                    ends = np.cumsum([len(part) for _, part in held])
                    totals.extend(np.add.reduceat(np.append(found, 0.0), [0, *ends[:-1]]).tolist())
                    held.clear()

            waiting = 0
            for cell in batch.column(1):
                tokens = padded(tokens_of(cell.as_py(), vocabulary))
                count = len(tokens) - 2 * WINDOW
                counts.append(count)
                if not 0 < count <= BATCH:
                    flush()
                    waiting = 0
                    totals.append(document_score(weights, vocabulary, cell.as_py())[1] if count else 0.0)
                    continue
                places = np.arange(count)
                held.append((windows(tokens, places), tokens[places + WINDOW]))
                waiting += count
                if waiting >= BATCH:
                    flush()
                    waiting = 0
            flush()
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(counts, pa.int64()), pa.array(totals, pa.float64())], ["id", "n_words", "log_probability"]
            )

    return run


def score_text(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 42, rounds: int = ROUNDS
) -> DataFrame:
    """A row per document: id, number of words, summed log-probability and its mean per word."""
    texts = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    vocabulary = frequent_words(texts)
    weights = train(texts, vocabulary, seed, rounds)
    id_type = texts.schema["id"].dataType.simpleString()
    rows = texts.mapInArrow(scores(weights, vocabulary), f"id {id_type}, n_words long, log_probability double")
    mean = F.when(F.col("n_words") > 0, F.col("log_probability") / F.col("n_words"))
    return rows.withColumn("mean_log_probability", mean).withColumnRenamed("id", id_col)
