from __future__ import annotations

import re

import pytest

from martlet.llm.mixing import mix, mixed_corpus, sized, with_draws


def brute_targets(sizes, weights=(5, 2, 1), budget=1.5, cap=2.0):
    """Water filling one step at a time."""
    sources = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    w = {s: weights[i % len(weights)] for i, s in enumerate(sources)}
    total = budget * sum(sizes.values())
    full = {s for s in sources if sizes[s] == 0}
    while True:
        left = total - sum(cap * sizes[s] for s in full)
        free = [s for s in sources if s not in full]
        share = {s: left * w[s] / sum(w[x] for x in free) for s in free}
        over = {s for s in free if share[s] > cap * sizes[s]}
        if not over:
            return {s: cap * sizes[s] if s in full else share[s] for s in sources}
        full |= over


def rows_of(prose, n=400):
    rows = []
    for i in range(n):
        source = [None, "é", "Z", "a", "big", "big", "big", "tiny"][i % 8]
        rows.append((i, prose(i, 1 + (i * 37) % 90 + (900 if i % 50 == 3 else 0)), source))
    return rows + [(900, None, "a"), (901, "", "Z"), (902, None, "nothing"), (None, prose(1, 30), "a"), (7, prose(7, 12), "é"), (7, prose(7, 12), "é")]


def test_targets_and_taken(spark, documents, prose):
    rows = rows_of(prose)
    out = mix(documents(*rows).selectExpr("*", "1 AS size", "2 AS target", "3 AS p")).collect()
    assert len(out) == len(rows)
    words = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + words(text)
    targets = brute_targets(sizes)
    for r in out:
        assert r["target"] == pytest.approx(targets[r["source"]]) and r["source_size"] == sizes[r["source"]]
        assert r["taken"] == r["copies"] * r["size"] <= 2 * r["size"] and r["copies"] >= 0
    for source, target in targets.items():
        taken = sum(r["taken"] for r in out if r["source"] == source)
        assert abs(taken - target) <= max(60, 0.02 * target), source


def test_reruns_agree_and_no_python(spark, documents, prose):
    docs = documents(*rows_of(prose, 150))
    key = lambda r: (r["doc_id"] or -1, r["size"], r["taken"], r["source"] or "")
    first, second = (sorted(map(key, mix(d).collect())) for d in (docs, docs.repartition(7).sortWithinPartitions("text")))
    assert first == second
    plan = mix(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_expected_copies_over_many_documents(spark, documents):
    docs = documents(*[(i, "one two three four", "ab"[i % 2]) for i in range(4000)])
    out = mix(docs).groupBy("source").sum("copies", "taken", "size").collect()
    for r in out:
        weight = {"a": 5 / 7, "b": 2 / 7}[r["source"]]
        target = min(2 * 8000, 12000 * 2 * weight) if r["source"] == "a" else 24000 - 16000
        assert abs(r["sum(taken)"] - target) <= 4


def test_empty_and_wordless_tables(spark, documents):
    assert mix(documents((1, "a")).where("false")).count() == 0
    out = mix(documents((1, None), (2, " "))).collect()
    assert [(r["size"], r["target"], r["taken"]) for r in out] == [(0, 0.0, 0)] * 2


def test_rows_of_one_id_have_draws_of_their_own(spark, documents):
    """20,000 rows that repeat an id fall into blocks like other rows, and the
    copies of them all come near the target."""
    docs = documents((1, "one two three"), (2, "four five"), (None, "six")).selectExpr("*", "explode(sequence(1, 20000)) AS i").drop("i")
    draws = with_draws(sized(docs.repartition(6)).checkpoint())
    assert draws.select("draw").distinct().count() == 60_000
    again = with_draws(sized(docs.repartition(3)).checkpoint())
    assert draws.select("doc_id", "draw").exceptAll(again.select("doc_id", "draw")).count() == 0
    out = {r["doc_id"]: r for r in mix(docs).groupBy("doc_id").agg({"copies": "avg", "taken": "sum", "copies": "avg"}).collect()}
    assert all(abs(r["avg(copies)"] - 1.5) < 0.02 for r in out.values())


def test_expected_copies_of_a_document_equal_its_rate(spark, documents):
    """Over many keys (ids), documents of one size are taken at one rate."""
    docs = documents(*[(i, "w " * (1 + i % 5), "a" if i % 3 else "b") for i in range(6000)])
    out = mix(docs).groupBy("source", "size").avg("copies").collect()
    for source in "ab":
        rates = [r["avg(copies)"] for r in out if r["source"] == source]
        assert len(rates) == 5 and max(rates) - min(rates) < 0.08, (source, rates)


def test_mixed_corpus_keeps_texts_and_any_columns(spark, documents, prose):
    rows = rows_of(prose, 60)
    docs = documents(*rows).selectExpr("*", "'x' AS copies", "5 AS row", "6 AS draw", "7 AS __source")
    out = mixed_corpus(docs)
    assert set(docs.columns) <= set(out.columns) and {"size", "taken", "target", "source_size"} <= set(out.columns)
    got = sorted((r["text"] or "", r["row"], r["draw"]) for r in out.collect())
    assert got == sorted((r[1] or "", 5, 6) for r in rows)
    key = lambda r: (r["doc_id"] or -1, r["size"], r["taken"])
    assert sorted(map(key, out.collect())) == sorted(map(key, mix(documents(*rows)).collect()))
    assert mixed_corpus(docs.where("false")).count() == 0


def test_a_very_long_text_is_counted_whole(spark, documents):
    (r,) = mix(documents((1, "word " * 300_000))).collect()
    assert r["size"] == 300_000 and r["copies"] in (1, 2)
