"""SentencePiece encoding and decoding, with sampled segmentations.

Texts are encoded to a model's pieces and back by the sentencepiece library. Sampling
draws several different segmentations of a text without replacement, as subword
regularisation wants them.

The ways to cut a text into pieces are the paths of a lattice. A path's probability is
proportional to the product of its pieces' weights, Zipf's law on their rank in the
model. Backward sums over the lattice give each edge's conditional probability, so a
part of a path stands for all its continuations. Gumbel noise given to such a part is
the largest of theirs; descending, one child has its parent's value, and the value of
the others is drawn under the condition that it is smaller. An A-star search that follows the largest
perturbed value first thus meets the complete paths in falling order of theirs: the
first k are k draws without replacement, all different. The (k+1)-th gives the
threshold of the inclusion scores, the probability that a path of its log-probability
is among the first k.

No piece has a space after another character, so the lattice of a text is a chain of
chunks. The search branches at chunks: an open part is a path up to a chunk and all
ways through that chunk but those taken already. The lattices of distinct chunks are laid out
flat and kept by the task, up to a bound; the chunks of many texts are walked in lock-step. The noise is
seeded by the row's key and the place in its text, whatever the batch.

Defined results: a null or empty text has one empty segmentation. Texts with fewer
than k segmentations give all they have, each with inclusion 1. Rows repeating key and
text have the same samples; null keys are keys like others. Texts of any length are
searched whole, at memory in proportion to the longest one. An empty table gives an empty
result; further columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterline.llm.common import text_or_empty

MODEL = "piece_bpe_32k.model"
SAMPLES = 2
#: Exponent of the weights: 0 makes all pieces alike, more prefers the frequent ones.
SHARPNESS = 1.0
SPACE = "▁"
#: Texts are searched together up to so many characters, over the number of samples.
GROUP_CHARS = 3_000_000
#: Lattices are made anew when those kept have more places.
PLACES_KEPT = 1_200_000
#: Chunks whose lattices are made at a time.
BUILT = 4_096
#: Ids decoded at a time, or a single longer list.
DECODED = 500_000
#: Sums over a text are of integers, so that they do not depend on the texts beside it.
FIXED = 2.0**32
UNICODE = 0x110000
STEP = np.uint64(0x9E3779B97F4A7C15)


def load(path: str) -> sentencepiece.SentencePieceProcessor:
    return sentencepiece.SentencePieceProcessor(model_file=path)


def mixed(x: np.ndarray) -> np.ndarray:
    """Well mixed 64-bit numbers, the finaliser of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def uniform(x: np.ndarray) -> np.ndarray:
    """Numbers between 0 and 1, both excluded."""
    return ((mixed(x) >> np.uint64(12)).astype(np.float64) + 0.5) * 2.0**-52


def bounded_gumbel(location, bound, draw):
    """Gumbel noise around ``location`` on the condition that it is under ``bound``."""
    return location - np.log(np.exp(np.minimum(location - bound, 700.0)) - np.log(draw))


def ranges(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The numbers ``first`` to ``first + count - 1`` of each pair, one after another."""
    ends = np.cumsum(count)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(first - ends + count, count)


def roomy(kept: np.ndarray, size: int) -> np.ndarray:
    """The array, or a copy with room to grow if it is smaller than ``size``."""
    if len(kept) >= size:
        return kept
    grown = np.empty(size + size // 4, kept.dtype)
    grown[: len(kept)] = kept
    return grown


class Numbers(dict):
    """Numbers of chunks, which are told apart by what follows their first space."""

    def __missing__(self, chunk: str) -> int:
        self[chunk] = number = len(self)
        return number


class Lattices:
    """Lattices of chunks by a model's pieces; characters that are no piece go by their bytes.

    ``start`` has the first place of each chunk, ``first`` the first edge of each place, and
    edges have the next place (-1: end), piece (-1 - character: its bytes), conditional
    log-probability and the place's running total of probabilities.
    """

    def __init__(self, path: str, sharpness: float) -> None:
        model = load(path)
        size = model.get_piece_size()
        self.byte = np.zeros(256, np.int32)
        self.byte_weight = -sharpness * math.log(size)
        self.weight = np.zeros(size)
        pieces = []
        for i in range(size):
            if model.is_byte(i):
                self.byte[int(model.id_to_piece(i)[3:5], 16)] = i
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                pieces.append((model.id_to_piece(i), i))
                self.weight[i] = -sharpness * math.log(1 + len(pieces))
        self.longest = max(len(piece) for piece, _ in pieces)
        letters = sorted({ord(c) for piece, _ in pieces for c in piece})
        self.letter = np.zeros(UNICODE, np.int32)
        self.letter[letters] = np.arange(1, len(letters) + 1)
        self.letters = len(letters) + 1
        # A trie of the pieces: child of (node, letter) by binary search, the root's by its letter.
        children: dict[int, int] = {}
        ends = {}
        for piece, i in pieces:
            node = 0
            for code in self.letter[[ord(c) for c in piece]].tolist():
                node = children.setdefault(node * self.letters + code, len(children) + 1)
            ends[node] = i
        edges = sorted(children.items())
        kind = np.int32 if edges[-1][0] < 2**31 - 1 else np.int64
        self.keys = np.array([key for key, _ in edges] + [np.iinfo(kind).max], kind)
        self.child = np.array([node for _, node in edges], kind)
        self.root = np.full(self.letters, -1, kind)
        known = self.keys < self.letters
        self.root[self.keys[known]] = self.child[known[:-1]]
        self.piece = np.full(len(children) + 1, -1, np.int32)
        self.piece[list(ends)] = list(ends.values())
        self.clear()

    def clear(self) -> None:
        self.numbers = Numbers()
        self.places = self.edges = 0
        self.start, self.first = np.zeros(0, np.int64), np.zeros(1, np.int64)
        self.next, self.taken = np.zeros(0, np.int32), np.zeros(0, np.int32)
        self.logp, self.total = np.zeros(0), np.zeros(0)

    def numbered(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of all chunks of some texts, and where each text's begin, and the last one's end.

        A chunk is the spaces before a word and the word, with one space more before the text;
        spaces at the end are one as well. An empty text has no chunk.
        """
        if self.places > PLACES_KEPT:
            self.clear()
        known, number = len(self.numbers), self.numbers.__getitem__
        spaced = pc.replace_substring(pa.array(texts, pa.large_string()), SPACE, " ")
        parts = pc.split_pattern(spaced, " ")
        bounds = parts.offsets.to_numpy().astype(np.int64)
        words = parts.flatten().dictionary_encode()
        code, words = words.indices.to_numpy(), words.dictionary.to_numpy(zero_copy_only=False).tolist()
        by_code = np.fromiter(map(number, words), np.int64, len(words))
        empty = words.index("") if "" in words else -1

        at = np.flatnonzero(code != empty)
        text = np.searchsorted(bounds, at, side="right") - 1
        spaces = at - np.maximum(np.concatenate([[-1], at[:-1]]), bounds[text] - 1)
        found = by_code[code[at]]
        for i in np.flatnonzero(spaces > 1).tolist():
            found[i] = number(SPACE * int(spaces[i] - 1) + words[code[at[i]]])
        size = np.bincount(text, minlength=len(texts))
        ends = np.concatenate([[0], np.cumsum(size)])
        last = np.full(len(texts), -1)
        last[text] = at
        over = bounds[1:] - 1 - np.maximum(last, bounds[:-1] - 1)
        over[np.fromiter(map(len, texts), np.int64, len(texts)) == 0] = 0
        tails = np.flatnonzero(over)
        if len(tails):
            found = np.insert(found, ends[tails + 1], [number(SPACE * int(over[i] - 1)) for i in tails])
            ends[1:] += np.cumsum(over > 0)
        if len(self.numbers) > known:
            new = list(islice(self.numbers, known, None))
            self.append([self.built(new[i : i + BUILT]) for i in range(0, len(new), BUILT)])
        return found, ends

    def built(self, chunks: list[str]) -> tuple[np.ndarray, ...]:
        """Lattices. Places are numbered by their distance from the chunk's end, then by chunk, long ones first."""
        lengths = np.fromiter(map(len, chunks), np.int32, len(chunks)) + 1
        # A character of no piece ends each chunk, and a match with it.
        codes = np.frombuffer(f"{SPACE}{f'\0{SPACE}'.join(chunks)}\0".encode("utf-32-le"), np.int32)
        bounds = np.cumsum(lengths + 1, dtype=np.int32) - 1
        inside = np.ones(len(codes), bool)
        inside[bounds] = False
        letter = self.letter[codes]
        letter[bounds] = 0
        order = np.argsort(-lengths, kind="stable")
        rank = np.empty(len(chunks), np.int32)
        rank[order] = np.arange(len(chunks))
        wide = np.cumsum(np.bincount(lengths)[::-1])[::-1][1:]
        base = np.concatenate([[0], np.cumsum(wide)]).astype(np.int32)
        places = int(base[-1])
        origin = np.flatnonzero(inside).astype(np.int32)
        chunk, away = np.repeat(rank, lengths), np.repeat(bounds, lengths) - origin
        place = base[away - 1] + chunk

        node = self.root[letter[origin]]
        piece = np.where(node >= 0, self.piece[node], -1)
        ways = [(np.arange(places, dtype=np.int32), np.where(piece >= 0, piece, -1 - codes[origin]))]
        count = np.ones(places, np.int32)
        at = np.flatnonzero(node >= 0)
        node, ahead = node[at], origin[at]
        for _ in range(2, self.longest + 1):
            ahead += 1
            key = node * self.letters + letter[ahead]
            found = np.searchsorted(self.keys, key)
            hit = np.flatnonzero(self.keys[found] == key)
            at, ahead, node = at[hit], ahead[hit], self.child[found[hit]]
            piece = self.piece[node]
            whole = np.flatnonzero(piece >= 0)
            ways.append((at[whole], piece[whole]))
            count[place[at[whole]]] += 1

        # Edges of a place, the longest first.
        first = np.concatenate([[0], np.cumsum(count)])
        follow, taken = np.empty(first[-1], np.int32), np.empty(first[-1], np.int32)
        free = first[:-1].copy()
        for length in range(len(ways), 0, -1):
            at, piece = ways[length - 1]
            slot = free[place[at]]
            free[place[at]] += 1
            taken[slot] = piece
            left = away[at] - length
            follow[slot] = np.where(left > 0, base[left - 1] + chunk[at], -1)
        weight = self.weight[np.maximum(taken, 0)]
        spelt = np.flatnonzero(taken < 0)
        code = -1 - taken[spelt]
        weight[spelt] = self.byte_weight * (1 + (code > 0x7F) + (code > 0x7FF) + (code > 0xFFFF))

        after = np.zeros(places + 1)
        for low, high in zip(base[:-1].tolist(), base[1:].tolist()):
            a, b = first[low], first[high]
            reach = weight[a:b]
            reach += after[follow[a:b]]
            cuts = first[low:high] - a
            top = np.maximum.reduceat(reach, cuts)
            mass = np.add.reduceat(np.exp(reach - np.repeat(top, count[low:high])), cuts)
            after[low:high] = top + np.log(mass)
        logp = weight - np.repeat(after[:-1], count)
        total, more = np.exp(logp), np.arange(places)
        for way in range(1, int(count.max())):
            more = more[count[more] > way]
            edge = first[more] + way
            total[edge] += total[edge - 1]
        total[first[1:] - 1] = np.inf

        return base[lengths - 1] + rank, first, follow, taken, logp, total

    def append(self, blocks: list[tuple[np.ndarray, ...]]) -> None:
        place, edge = self.places, self.edges
        self.places += sum(len(block[1]) - 1 for block in blocks)
        self.edges += sum(int(block[1][-1]) for block in blocks)
        self.first = roomy(self.first, self.places + 1)
        self.next, self.taken = roomy(self.next, self.edges), roomy(self.taken, self.edges)
        self.logp, self.total = roomy(self.logp, self.edges), roomy(self.total, self.edges)
        starts = [self.start]
        for start, first, follow, taken, logp, total in blocks:
            starts.append(start + place)
            self.first[place + 1 : place + len(first)] = first[1:] + edge
            end = edge + len(follow)
            self.next[edge:end] = np.where(follow >= 0, follow + place, -1)
            self.taken[edge:end], self.logp[edge:end], self.total[edge:end] = taken, logp, total
            place, edge = place + len(first) - 1, end
        self.start = np.concatenate(starts)

    def walk(self, place: np.ndarray, stream: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """A path from each place, drawn by the edges' probabilities: all edges, edges and log-probability of each."""
        logq, count = np.zeros(len(place)), np.zeros(len(place), np.int64)
        steps = []
        at = np.flatnonzero(place >= 0)
        place, stream = place[at], stream[at]
        while len(at):
            edge = self.first[place]
            draw = uniform(stream)
            over = np.flatnonzero(draw >= self.total[edge])
            while len(over):
                edge[over] += 1
                over = over[draw[over] >= self.total[edge[over]]]
            steps.append((at, edge))
            logq[at] += self.logp[edge]
            count[at] += 1
            place = self.next[edge]
            on = np.flatnonzero(place >= 0)
            at, place, stream = at[on], place[on], stream[on] + STEP
        first = np.cumsum(count) - count
        edges = np.empty(int(count.sum()), np.int64)
        for i, (at, edge) in enumerate(steps):
            edges[first[at] + i] = edge
        return edges, count, logq

    def branches(self, place: int, taken: list[list[int]]) -> list[tuple[float, list[int], int, int]]:
        """The ways that leave the taken paths: log-probability, and edges of a taken path up to a number, then an edge."""
        found = []
        todo = [(place, taken, 0, 0.0)]
        while todo:
            place, paths, depth, logp = todo.pop()
            after: dict[int, list[list[int]]] = {}
            for path in paths:
                after.setdefault(path[depth], []).append(path)
            low = int(self.first[place])
            logs = self.logp[low : self.first[place + 1]].tolist()
            for edge, own in enumerate(logs, low):
                if edge not in after:
                    found.append((logp + own, paths[0], depth, edge))
                elif self.next[edge] >= 0:
                    todo.append((int(self.next[edge]), after[edge], depth + 1, logp + own))
        return found

    def pieces(self, edges: np.ndarray, ends: np.ndarray) -> pa.ListArray:
        """The ids of paths that lie one after another."""
        ids = self.taken[edges]
        spelt = np.flatnonzero(ids < 0)
        if len(spelt):
            spelling = [chr(-1 - code).encode() for code in ids[spelt].tolist()]
            size = np.ones(len(ids), np.int64)
            size[spelt] = [len(x) for x in spelling]
            bounds = np.concatenate([[0], np.cumsum(size)])
            ids, ends = np.repeat(ids, size), bounds[ends]
            ids[ranges(bounds[spelt], size[spelt])] = self.byte[np.frombuffer(b"".join(spelling), np.uint8)]
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32()))


def log_sum(logs: list[float]) -> float:
    if not logs:
        return -math.inf
    top = max(logs)
    return top + math.log(sum(math.exp(x - top) for x in logs))


class Search:
    """The first paths of some texts in falling order of perturbed values.

    An open part of a text is (value, path, chunk, taken): that path before the chunk, and there
    any way but the taken ones. Paths are kept as the place and number of each chunk's edges.
    """

    def __init__(self, lattices: Lattices, texts: list[str], seeds: np.ndarray, samples: int) -> None:
        self.lattices, self.samples, self.seeds = lattices, samples, seeds
        chunks, self.ends = lattices.numbered(texts)
        self.start = lattices.start[chunks]
        self.text = np.repeat(np.arange(len(texts)), np.diff(self.ends))
        number = (np.arange(len(chunks)) - self.ends[self.text]).astype(np.uint64)
        self.stream = mixed(mixed(seeds)[self.text] + number * STEP)
        self.edges, self.made = [], 0
        self.paths: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.parts: list[list[tuple]] = [[] for _ in texts]

    def noise(self, of: np.ndarray, purpose: int) -> np.ndarray:
        """Draws for streams, independent for each purpose."""
        return uniform(mixed(of ^ np.uint64(0xD1B54A32D192ED03 * (2 * purpose + 1) % 2**64)))

    def walked(self, chunks: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        stream = mixed(self.stream[chunks] + np.uint64(len(self.paths) + 1))
        edges, count, logq = self.lattices.walk(place, stream)
        first = np.cumsum(count) - count + self.made
        self.edges.append(edges)
        self.made += len(edges)
        return first, count, logq

    def path_edges(self, first: int, count: int) -> list[int]:
        for block in self.edges:
            if first < len(block):
                return block[first : first + count].tolist()
            first -= len(block)
        return []

    def open(self, texts: np.ndarray, since: np.ndarray, bound: np.ndarray) -> None:
        """Adds the parts that leave the last path at its chunks from ``since`` on, as far as they can be wanted."""
        wanted = self.samples + 1 - len(self.paths)
        logq = self.paths[-1][2]
        size = self.ends[texts + 1] - since
        some = size > 0
        texts, since, bound, size = texts[some], since[some], bound[some], size[some]
        if not len(texts) or not wanted:
            return
        chunk = ranges(since, size)
        fixed = np.rint(logq * FIXED).astype(np.int64)
        before = np.cumsum(fixed) - fixed
        with np.errstate(divide="ignore"):
            mass = np.log(-np.expm1(np.minimum(logq[chunk], 0.0)))
        mass += (before[chunk] - np.repeat(before[self.ends[texts]], size)) / FIXED
        draw = self.noise(self.stream[chunk], len(self.paths))
        value = bounded_gumbel(mass, np.repeat(bound, size), draw)
        value[mass == -np.inf] = -np.inf
        cuts = np.cumsum(size) - size
        for _ in range(wanted):
            best = np.maximum.reduceat(value, cuts)
            hits = np.flatnonzero((value == np.repeat(best, size)) & (value > -np.inf))
            if not len(hits):
                break
            for i, one in zip(chunk[hits].tolist(), value[hits].tolist()):
                self.parts[self.text[i]].append((one, len(self.paths) - 1, i, None))
            value[hits] = -np.inf

    def run(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Texts and perturbed values of each number, ``samples + 1`` at most; the path of the last is not walked."""
        texts = np.arange(len(self.parts))
        value = -np.log(-np.log(self.noise(mixed(self.seeds), 0)))
        self.paths.append(self.walked(np.arange(len(self.start)), self.start))
        yield texts, value
        self.open(texts, self.ends[:-1], value)
        while True:
            popped = []
            for text in texts.tolist():
                parts = self.parts[text]
                if parts:
                    parts.sort(key=lambda part: part[0])
                    popped.append((text, *parts.pop()))
                    del parts[: max(0, len(parts) - (self.samples - len(self.paths)))]
            texts = np.array([x[0] for x in popped], np.int64)
            value = np.array([x[1] for x in popped])
            if len(self.paths) == self.samples or not popped:
                yield texts, value
                return
            self.follow(popped, texts, value)
            yield texts, value

    def follow(self, popped: list[tuple], texts: np.ndarray, value: np.ndarray) -> None:
        """Completes the popped parts: leaves the taken ways at their chunk, and is free after it."""
        lattices = self.lattices
        since = np.array([x[3] for x in popped])
        draw = self.noise(self.stream[since], -2 * len(self.paths) - 1).tolist()
        path = tuple(np.zeros(len(self.start), kind) for kind in (np.int64, np.int64, np.float64))
        ways, places = [], []
        for (text, _, parent, i, taken), u in zip(popped, draw):
            low = self.ends[text]
            for own, old in zip(path, self.paths[parent]):
                own[low:i] = old[low:i]
            if taken is None:
                taken = [self.path_edges(int(self.paths[parent][0][i]), int(self.paths[parent][1][i]))]
            found = lattices.branches(int(self.start[i]), taken)
            left = math.log(u) + log_sum([x[0] for x in found])
            top, passed = max(x[0] for x in found), 0.0
            for one in found:
                passed += math.exp(one[0] - top)
                if passed >= math.exp(left - top):
                    break
            _, along, depth, edge = one
            ways.append((taken, [*along[:depth], edge]))
            places.append(int(lattices.next[edge]))
        chunk = ranges(since, self.ends[texts + 1] - since)
        place = self.start[chunk]
        size = self.ends[texts + 1] - since
        heads = np.cumsum(size) - size
        place[heads] = places
        first, count, logq = self.walked(chunk, place)
        for own, new in zip(path, (first, count, logq)):
            own[chunk] = new
        heads = heads.tolist()
        joined, taken_now = [], []
        for (taken, way), head, i in zip(ways, heads, since.tolist()):
            whole = way + self.path_edges(int(first[head]), int(count[head]))
            path[0][i], path[1][i] = self.made, len(whole)
            path[2][i] = lattices.logp[whole].sum()
            self.made += len(whole)
            joined.extend(whole)
            taken_now.append([*taken, whole])
        self.edges.append(np.array(joined, np.int64))
        self.paths.append(path)
        if self.samples + 1 > len(self.paths):
            self.open(texts, since + 1, value)
            again = self.noise(self.stream[since], -2 * len(self.paths)).tolist()
            for (text, bound, parent, i, _), taken, u in zip(popped, taken_now, again):
                mass = log_sum([x[0] for x in lattices.branches(int(self.start[i]), taken)])
                if mass > -math.inf:
                    mass += float(path[2][self.ends[text] : i].sum())
                    self.parts[text].append((float(bounded_gumbel(mass, bound, u)), len(self.paths) - 1, i, taken))

    def sample(self, number: int, texts: np.ndarray, edges: np.ndarray) -> tuple[pa.ListArray, np.ndarray]:
        """Ids and log-probabilities of a path of some texts; ``edges`` are all of the search."""
        first, count, logq = self.paths[number]
        size = self.ends[texts + 1] - self.ends[texts]
        chunk = ranges(self.ends[texts], size)
        bounds = np.concatenate([[0], np.cumsum(count[chunk])])
        ends = bounds[np.concatenate([[0], np.cumsum(size)])]
        logs = np.bincount(self.text, weights=logq, minlength=len(self.parts))[texts].astype(np.float64)
        return self.lattices.pieces(edges[ranges(first[chunk], count[chunk])], ends), logs


def sampled(
    lattices: Lattices, texts: list[str], seeds: np.ndarray, samples: int
) -> Iterator[tuple[np.ndarray, pa.ListArray, np.ndarray, np.ndarray]]:
    """For each sample's number, the texts that have it, ids, log-probability and inclusion."""
    search = Search(lattices, texts, seeds, samples)
    threshold = np.full(len(texts), -np.inf)
    numbers = []
    for number, (some, value) in enumerate(search.run()):
        if number < samples and len(some):
            numbers.append(some)
        elif number == samples:
            threshold[some] = value
    edges = np.concatenate(search.edges)
    for number, some in enumerate(numbers):
        ids, logs = search.sample(number, some, edges)
        yield some, ids, logs, -np.expm1(-np.exp(np.minimum(logs - threshold[some], 700.0)))


def groups(texts: pa.Array, most: int) -> Iterator[tuple[int, list[str]]]:
    """Runs of texts of up to ``most`` characters, or of a single longer one, with the first one's number."""
    first, run, chars = 0, [], 0
    for i, text in enumerate(texts):
        text = text.as_py()
        if run and chars + len(text) > most:
            yield first, run
            first, run, chars = i, [], 0
        run.append(text)
        chars += len(text)
    if run:
        yield first, run


@lru_cache(maxsize=1)
def kept_lattices(path: str, sharpness: float) -> Lattices:
    """The model's pieces in a Python worker, kept for its later tasks."""
    return Lattices(path, sharpness)


def sample_rows(path: str, samples: int, sharpness: float, decoded: str | None = None):
    """(row columns.., sample, ids, log_probability, inclusion, decoded); the last columns of the input are seed and text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattices = kept_lattices(path, sharpness)
        decode = decoded and Decoder(load(path))
        for batch in batches:
            *kept, seeds, texts = batch.columns
            seeds = seeds.to_numpy(zero_copy_only=False).view(np.uint64)
            for first, own in groups(texts, GROUP_CHARS // (samples + 1)):
                found = sampled(lattices, own, seeds[first : first + len(own)], samples)
                for number, (some, ids, logs, inclusion) in enumerate(found):
                    rows = pa.array(some + first)
                    numbers = pa.array(np.full(len(some), number, np.int32))
                    columns = [*(column.take(rows) for column in kept), numbers, ids, pa.array(logs), pa.array(inclusion)]
                    names = [*batch.schema.names[:-2], "sample", "ids", "log_probability", "inclusion"]
                    if decode:
                        columns, names = [*columns, decode(ids)], [*names, decoded]
                    yield pa.RecordBatch.from_arrays(columns, names)
        lattices.clear()
        pa.default_memory_pool().release_unused()

    return run


def unused(name: str, taken: list[str]) -> str:
    """The name, longer if it is taken in any case."""
    while name.lower() in {x.lower() for x in taken}:
        name = f"_{name}"
    return name


def sample_pieces(
    docs: DataFrame,
    keys: list[str],
    text_col: str = "text",
    model: str | None = None,
    samples: int = SAMPLES,
    sharpness: float = SHARPNESS,
    seed: int = 42,
    decoded: str | None = None,
) -> DataFrame:
    """The key columns with each sample's number, ids, log-probability and inclusion score.

    ``decoded`` names a further column with the text of the sample's ids, as ``decode_pieces`` makes it.
    """
    path = model or public_tokenizers.path(MODEL)
    key = F.concat_ws(" ", *(F.coalesce(F.col(name).cast("string"), F.lit("null")) for name in keys))
    draws = F.xxhash64(key, F.lit(seed))
    rows = docs.select(*keys, draws.alias(unused("seed", keys)), text_or_empty(text_col).alias(unused("text", keys)))
    fields = [f"`{name}` {rows.schema[name].dataType.simpleString()}" for name in keys]
    schema = ", ".join([*fields, "sample int, ids array<int>, log_probability double, inclusion double"])
    if decoded:
        schema += f", `{decoded}` string"
    return rows.mapInArrow(sample_rows(path, samples, sharpness, decoded), schema)


class Encoder:
    def __init__(self, model: sentencepiece.SentencePieceProcessor) -> None:
        self.model = model

    def __call__(self, texts: pa.Array) -> pa.Array:
        return pa.array([self.model.encode(text or "", num_threads=1) for text in texts.to_pylist()], pa.list_(pa.int32()))


class Decoder:
    """Texts of lists of ids: the bytes of their pieces, joined, with spaces for their marks.

    The mark that stands before a text is left out. The library itself decodes lists with other pieces
    (control, unknown) or with bytes that are no text, and all lists if the model joins otherwise.
    """

    def __init__(self, model: sentencepiece.SentencePieceProcessor) -> None:
        self.model = model
        spelt: list[bytes] = []
        marked, other = [], []
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            marked.append(piece.startswith(SPACE))
            other.append(model.is_control(i) or model.is_unknown(i) or model.is_unused(i))
            spelt.append(bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace(SPACE, " ").encode())
        self.spelt = pa.array(spelt, pa.binary())
        self.marked, self.other = np.array(marked), np.array(other)
        probes = [[i, i] for i in range(0, len(spelt), max(1, len(spelt) // 256)) if not other[i]]
        found = self.joined(pa.array(probes, pa.list_(pa.int32())))
        self.joins = all(text in (None, model.decode(ids)) for text, ids in zip(found, probes))

    def joined(self, lists: pa.ListArray) -> list[str | None]:
        """None where the library has to decode."""
        ends = lists.offsets.to_numpy()
        ids = lists.values.to_numpy()[ends[0] : ends[-1]]
        ends = ends - ends[0]
        own = pa.ListArray.from_arrays(pa.array(ends), self.spelt.take(pa.array(ids)))
        texts = pc.binary_join(own, b"").to_numpy(zero_copy_only=False).tolist()
        some = ends[1:] > ends[:-1]
        cut = np.zeros(len(texts), bool)
        cut[some] = self.marked[ids[ends[:-1][some]]]
        left = np.zeros(len(texts), bool)
        left[np.searchsorted(ends, np.flatnonzero(self.other[ids]), side="right") - 1] = True
        found: list[str | None] = []
        for text, one, library in zip(texts, cut.tolist(), left.tolist()):
            try:
                found.append(None if library else (text[1:] if one else text).decode())
            except UnicodeDecodeError:
                found.append(None)
        return found

    def __call__(self, lists: pa.ListArray) -> pa.Array:
        lists = pa.concat_arrays([pc.fill_null(lists, [])]) if lists.null_count else lists
        size = self.model.get_piece_size()
        known = not len(lists.values) or 0 <= pc.min(lists.values).as_py() and pc.max(lists.values).as_py() < size
        found: list[str | None] = [] if self.joins and known else [None] * len(lists)
        ends = lists.offsets.to_numpy()
        while len(found) < len(lists):
            first = len(found)
            last = int(np.searchsorted(ends, ends[first] + DECODED, side="right")) - 1
            found += self.joined(lists.slice(first, max(last, first + 1) - first))
        for i, text in enumerate(found):
            if text is None:
                ids = lists[i].as_py()
                found[i] = self.model.decode(ids) if ids else ""
        return pa.array(found, pa.string())


def per_worker(path: str, kind: type, at: int, made_name: str):
    """All columns, and that of number ``at`` through ``kind(model)`` as a new one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        apply = kind(load(path))
        for batch in batches:
            made = apply(batch.column(at))
            yield pa.RecordBatch.from_arrays([*batch.columns, made], [*batch.schema.names, made_name])
            pa.default_memory_pool().release_unused()

    return run


def mapped(docs: DataFrame, value: str, name: str, result: T.DataType, kind: type, model: str | None) -> DataFrame:
    made = unused(name, [*docs.columns, name])
    at = [column.lower() for column in docs.columns].index(value.lower())
    schema = T.StructType([*docs.schema.fields, T.StructField(made, result)])
    out = docs.mapInArrow(per_worker(model or public_tokenizers.path(MODEL), kind, at, made), schema)
    return out.drop(name).withColumnRenamed(made, name)


def encode_pieces(docs: DataFrame, text_col: str = "text", to: str = "ids", model: str | None = None) -> DataFrame:
    """All columns with the model's own encoding of the text in column ``to``."""
    return mapped(docs, text_col, to, T.ArrayType(T.IntegerType()), Encoder, model)


def decode_pieces(docs: DataFrame, ids_col: str = "ids", to: str = "text", model: str | None = None) -> DataFrame:
    """All columns with the text of the ids in column ``to``; null ids give an empty text."""
    return mapped(docs, ids_col, to, T.StringType(), Decoder, model)
