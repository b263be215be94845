"""A plain search for benchmark passages, to hold the operator against."""

from __future__ import annotations

import re

from .tests_data import MEDIUM


def tokens(text):
    words = (re.sub(r"^[\W_]+|[\W_]+$", "", w.lower()) for w in re.split(r"[\x20\x09-\x0D]+", text or ""))
    return [w for w in words if w]


def leaks(texts, items, n=13):
    """Documents that hold n tokens in a row of an item."""
    grams = {tuple(t[i : i + n]) for t in map(tokens, items) for i in range(len(t) - n + 1)}
    grams |= {tuple(t) for t in map(tokens, items) if 5 <= len(t) < n}
    sizes = {len(g) for g in grams}
    out = set()
    for d, text in texts.items():
        t = tokens(text)
        if any(tuple(t[i : i + k]) in grams for k in sizes for i in range(len(t) - k + 1)):
            out.add(d)
    return out


def test_given_documents(spark):
    from martlet.llm.decontaminate import contaminated

    docs, bench = (spark.read.parquet(f"{MEDIUM}/{t}.parquet") for t in ("documents", "benchmark"))
    expected = leaks({r["doc_id"]: r["text"] for r in docs.collect()}, [r["text"] for r in bench.collect()])
    assert {r["doc_id"] for r in contaminated(docs, bench).collect()} == expected and expected
