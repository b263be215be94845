from __future__ import annotations

import pytest

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture()
def documents(spark):
    """Documents from ``(doc_id, text)`` or ``(doc_id, text, source)`` rows."""

    def make(*rows, schema=DOC_SCHEMA):
        full = [(r[0], r[1], None, r[2] if len(r) > 2 else "s", None if r[1] is None else len(r[1])) for r in rows]
        return spark.createDataFrame(full, schema)

    return make


@pytest.fixture(scope="session")
def prose():
    """Invented prose: ``prose(seed, n)`` gives n words."""
    import random

    def make(seed: int, n: int) -> str:
        r = random.Random(seed)
        words = ["".join(r.choice(["ka", "lo", "mi", "ren", "tu", "vas"]) for _ in range(r.randint(1, 4))) for _ in range(n)]
        return " ".join(words[:-1] + [words[-1] + "."]) if words else ""

    return make
