from __future__ import annotations

import array
import random
import zlib

import public_tokenizers
from textdata import docs, prose  # noqa: F401
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from meterline.llm import packing
from meterline.llm.byte_bpe import ByteBpe
from meterline.llm.packing import bins_of, crossover, cut_points, first_individuals, numbers_of, pack

PATH = public_tokenizers.path(packing.TOKENIZER)
ODD = [
    "", " ", "  ", "a", " a", "a ", "a  b", "a \n b", "\n\na", "tab\tx", "don't I'll we've", "x1 2y #$% ...", "日本語 テスト",
    "é à\xa0b\x85c\x1cd", "end<|endoftext|>of text", "🙂🙂 ok", "a" * 500, " x 　y", "Ωmega ɐ", "word.\nNext word,\nlast ",
]


def test_ids_are_those_of_the_tokenizer():
    tokenizer, encoder = Tokenizer.from_file(PATH), ByteBpe(PATH)
    rng = random.Random(11)
    texts = ODD + ["".join(rng.choices("ab é\n\t .,'1日", k=40)) for _ in range(300)] + [prose(rng, 300)]
    texts += [" ".join(f"{chr(i)}x{chr(i)}1 {chr(i)}" for i in range(at, at + 64)) for at in range(0, 0x250, 64)]
    texts += ["".join(map(chr, rng.choices([*range(0x400, 0x460), *range(0x2000, 0x2070), *range(0x3040, 0x3100)], k=60))) for _ in range(200)]
    for text in texts:
        ids = array.array("I", encoder.encode(text)).tolist()
        assert ids == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


def check(rows, pieces, capacity):
    """Pieces hold each document's ids in order, and sequences are gapless; gives their number and the tokens."""
    tokenizer, total = Tokenizer.from_file(PATH), 0
    mine = {}
    for row in sorted(pieces, key=lambda row: row["piece"]):
        mine.setdefault(row["doc_id"], []).append(row)
    for doc_id, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        at = 0
        for number, row in enumerate(mine[doc_id]):
            part = ids[at : at + row["length"]]
            assert (row["piece"], row["start"]) == (number, at)
            assert row["ids_crc32"] == zlib.crc32(array.array("I", part).tobytes())
            assert number == 0 or row["length"] == capacity
            at += row["length"]
        assert at == len(ids)
        total += len(ids)
    ends = {}
    for row in sorted(pieces, key=lambda row: row["offset"]):
        assert row["offset"] == ends.get(row["sequence_id"], 0)
        ends[row["sequence_id"]] = row["offset"] + row["length"]
    assert max(ends.values(), default=0) <= capacity
    return len(ends), total


def test_pack_cuts_places_and_fills(docs):
    rng = random.Random(12)
    rows = [(i, prose(rng, rng.randrange(1, 160))) for i in range(300)] + [(300 + i, text) for i, text in enumerate(ODD)]
    rows += [(400, None), (401, "word " * 20_000)]
    found = pack(docs(*rows), capacity=256).collect()
    sequences, total = check(rows, found, 256)
    assert sequences <= -(-total // 256) * 1.03 + 2


def test_blocks_and_islands_share_a_large_input(docs, monkeypatch):
    monkeypatch.setattr(packing, "BLOCK_PIECES", 64)
    rng = random.Random(13)
    rows = [(i, prose(rng, rng.randrange(1, 12))) for i in range(400)]
    sequences, total = check(rows, pack(docs(*rows), capacity=128).collect(), 128)
    assert sequences <= -(-total // 128) * 1.05 + 2


def test_null_and_repeated_rows_empty_table_and_ids(docs):
    frame = docs((None, "x"), (7, "same"), (7, "same"), (None, None)).withColumns({"id": F.lit(1), "piece": F.lit("p")})
    rows = pack(frame, keep_ids=True).collect()
    assert len(rows) == 4 and len({row["sequence_id"] for row in rows}) == 1
    assert sorted(row["ids"][-1] for row in rows) == [2] * 4
    assert pack(docs()).collect() == []


def test_pieces_of_a_length():
    assert cut_points(5, 10) == [(0, 5)] and cut_points(10, 10) == [(0, 10)]
    assert cut_points(25, 10) == [(0, 5), (5, 10), (15, 10)] and cut_points(20, 10) == [(0, 10), (10, 10)]


def test_crossover_keeps_every_piece_once():
    rng = random.Random(14)
    sizes = [rng.randrange(1, 100) for _ in range(200)]
    people = first_individuals(sizes, 100, 3, rng)
    for _ in range(20):
        child = crossover(sizes, 100, *rng.sample(people, 2), rng)
        assert sorted(i for members in child for i in members) == list(range(200))
        assert max(sum(sizes[i] for i in members) for members in child) <= 100
        assert sorted(map(sorted, bins_of(numbers_of(child, 200)))) == sorted(map(sorted, child))
        people.append(child)
