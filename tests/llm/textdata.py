"""Documents for the tests."""

from __future__ import annotations

import random

import pytest

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau".split()
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs(spark):
    """A documents table of (doc_id, text[, source]) rows."""

    def make(*rows):
        whole = [
            (row[0], row[1], "en", row[2] if len(row) > 2 else "host", len(row[1]) if row[1] is not None else None)
            for row in rows
        ]
        return spark.createDataFrame(whole, SCHEMA)

    return make


def prose(rng: random.Random, count: int) -> str:
    return " ".join(rng.choice(WORDS) + str(rng.randrange(1000)) for _ in range(count))


def by_id(frame, key="doc_id"):
    return {row[key]: row.asDict() for row in frame.collect()}
