"""Operators 1 and 2: trained models."""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pandas as pd
import pytest

from martlet.llm.lm_scoring import ModelParams, cross_entropy_difference
from martlet.llm.toxicity import ChainParams, best_threshold, evidence, fit, Sparse, toxicity

from .tests_data import MEDIUM


def labels_of(spark, rows, schema="doc_id long, quality int, toxic int"):
    return spark.createDataFrame(rows, schema)


def brute_scores(texts, good, size, prior):
    tokens = {d: (t or "").lower().split() for d, t in texts.items()}
    counts = Counter(w for ws in tokens.values() for w in ws)
    vocabulary = [w for w, _ in sorted(counts.items(), key=lambda x: (-x[1], x[0].encode()))[:size]]
    number = {w: i + 2 for i, w in enumerate(vocabulary)}
    v = len(vocabulary) + 2

    rare = {w for w in counts if w not in number}

    def model(docs):
        pairs, context, unigram, words = Counter(), Counter(), Counter(), Counter()
        for d in docs:
            last = 0
            for w in tokens[d]:
                n = number.get(w, 1)
                pairs[last, n] += 1
                context[last] += 1
                unigram[n] += 1
                words[w] += 1
                last = n
        total = sum(unigram.values())

        def loss(a, w):
            b = number.get(w, 1)
            p = (pairs[a, b] + prior * (unigram[b] + 1) / (total + v)) / (context[a] + prior)
            return -math.log2(p * ((words[w] + 1) / (unigram[1] + len(rare)) if b == 1 else 1))

        return loss

    target, background = model(good), model(tokens)
    out = {}
    for d, ws in tokens.items():
        steps = list(zip([0] + [number.get(w, 1) for w in ws], ws))
        out[d] = (len(ws), *(sum(m(*s) for s in steps) / len(steps) if steps else None for m in (target, background)))
    return out


def test_scores_match_brute_force(spark, documents, prose):
    texts = {i: prose(i % 6, 30 + i) for i in range(24)} | {30: None, 31: "", 32: "only Words here", 33: "w " * 4000}
    labels = labels_of(spark, [(0, 1, 0), (1, 1, 0), (1, 0, 0), (5, 1, 1), (6, 0, 0), (99, 1, 0), (None, 1, 0), (7, None, 0)])
    params = ModelParams(vocabulary_size=40, prior=7.0)
    got = cross_entropy_difference(documents(*texts.items()).selectExpr("*", "1 AS good", "2 AS n"), labels, params).collect()
    expected = brute_scores(texts, [0, 1, 5], 40, 7.0)
    assert len(got) == len(texts)
    for r in got:
        n, target, background = expected[r["doc_id"]]
        assert r["n_tokens"] == n
        if n == 0:
            assert r["score"] is None
        else:
            assert r["target_loss"] == pytest.approx(target, abs=1e-5) and r["background_loss"] == pytest.approx(background, abs=1e-5)
            assert r["score"] == pytest.approx(target - background, abs=1e-4)
    docs = documents(*texts.items())
    assert cross_entropy_difference(docs.where("false"), labels, params).count() == 0
    assert cross_entropy_difference(docs, labels.where("false"), params).count() == len(texts)


def test_words_beyond_the_classes_count_one_by_one(spark, documents, monkeypatch):
    """More words than classes and than a part holds: every word has its own count."""
    from martlet.llm import lm_scoring as L

    monkeypatch.setattr(L, "RARE_PER_PART", 700)
    r = np.random.default_rng(1)
    texts = {i: " ".join(f"w{x}" for x in r.zipf(1.3, 250) % 5000) for i in range(60)} | {70: None}
    texts[61] = texts[62] = " ".join(f"only{i}" for i in range(300))  # occurs twice
    texts[63] = " ".join(f"once{i}" for i in range(300))
    docs = documents(*texts.items()).repartition(5)
    params = ModelParams(vocabulary_size=50, prior=7.0)
    got = {x["doc_id"]: x for x in cross_entropy_difference(docs, labels_of(spark, [(i, 1, 0) for i in range(0, 40, 3)]), params).collect()}
    expected = brute_scores(texts, range(0, 40, 3), 50, 7.0)
    assert len({w for t in texts.values() for w in (t or "").split()}) > 2046 / 2
    for d, (n, target, background) in expected.items():
        assert got[d]["n_tokens"] == n
        if n:
            assert got[d]["target_loss"] == pytest.approx(target, abs=1e-4) and got[d]["background_loss"] == pytest.approx(background, abs=1e-4)
    assert got[61]["background_loss"] < got[63]["background_loss"] - 0.2


def test_a_part_is_added_up_range_by_range(monkeypatch):
    """A full part takes a bounded multiple of its tokens' 16 bytes."""
    import tracemalloc

    import pyarrow as pa

    from martlet.llm import lm_scoring as L

    monkeypatch.setattr(L, "RARE_AT_ONCE", 20_000, raising=False)
    r = np.random.default_rng(2)
    rows, total, target = [], Counter(), Counter()
    names = r.integers(0, 1 << 64, 40_000, np.uint64, endpoint=False)
    for block in range(20):
        h, d, k = np.sort(names[r.integers(0, len(names), 20_000)]), r.integers(0, 500, 20_000), r.integers(1, 4, 20_000)
        rows.append((block, h.tobytes(), d.astype(np.uint32).tobytes(), k.astype(np.uint32).tobytes()))
        for w, n in zip(h.tolist(), k.tolist()):
            total[w] += n
        if block < 3:
            own, at = np.unique(h, return_index=True)
            mixed = r.permutation(len(own))
            rows.append((-1, own[mixed].tobytes(), b"", k[at][mixed].astype(np.uint32).tobytes()))
            for w, n in zip(own.tolist(), k[at].tolist()):
                target[w] += n
    kinds = (pa.int64(), pa.binary(), pa.binary(), pa.binary())
    table = pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], ["block", "hashes", "docs", "counts"])
    tracemalloc.start()
    out = L._cost_of_part(table)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 40 * 400_000
    assert sum(out.column("words").to_pylist()) == len(total)
    given = {b: (h, d, k) for b, h, d, k in rows if b >= 0}
    for row in out.to_pylist():
        h, d, k = (np.frombuffer(x, t) for x, t in zip(given[row["block"]], (np.uint64, np.uint32, np.uint32)))
        for name, counts in (("target", target), ("background", total)):
            saved = np.bincount(d, weights=k * np.log2([counts[w] + 1 for w in h.tolist()]))
            assert np.frombuffer(row[name]) == pytest.approx(saved[np.frombuffer(row["docs"], np.uint32)])
    assert len(L._cost_of_part(table.slice(0, 0))) == 0


def test_scores_tell_quality_apart(spark):
    docs, labels = (spark.read.parquet(f"{MEDIUM}/{t}.parquet") for t in ("documents", "labels"))
    train, held = labels.where("doc_id % 2 = 0"), labels.where("doc_id % 2 = 1")
    scores = cross_entropy_difference(docs, train).join(held, "doc_id").toPandas()
    good, bad = scores[scores.quality == 1].score, scores[scores.quality == 0].score
    auc = np.mean([[g < b for g in good] for b in bad])
    assert auc > 0.9


def test_toxicity_on_held_out_labels(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    train, held = labels.where("doc_id % 3 <> 0"), labels.where("doc_id % 3 = 0")
    out = toxicity(docs, train, ("quality", "toxic")).join(held.selectExpr("doc_id", "quality AS q", "toxic AS t"), "doc_id").toPandas()
    hit = ((out.toxic) & (out.t == 1)).sum()
    assert hit / (out.t == 1).sum() > 0.85 and hit / out.toxic.sum() > 0.9
    assert (out.quality == (out.q == 1)).mean() > 0.95


def test_toxicity_edges(spark, documents, prose):
    docs = documents(*[(i, prose(i, 40) + (" vile" if i % 3 == 0 else "")) for i in range(60)], (70, None), (71, ""), (71, ""), (None, "vile"))
    labels = labels_of(spark, [(i, None, int(i % 3 == 0)) for i in range(60)] + [(0, None, 0), (500, None, 1), (None, None, 1)])
    params = ChainParams(min_df=3, steps=150)
    out = toxicity(docs.selectExpr("*", "1 AS toxic", "2 AS y"), labels, ("quality", "toxic"), params).collect()
    assert len(out) == 64 and all(r["p_quality"] is None and not r["quality"] for r in out)
    assert all(r["toxic"] == (r["doc_id"] is None or (r["doc_id"] < 60 and r["doc_id"] % 3 == 0)) for r in out)
    assert toxicity(docs.where("false"), labels, ("toxic",), params).count() == 0
    none = toxicity(docs, labels.where("false"), ("toxic",), params).collect()
    assert len(none) == 64 and all(r["p_toxic"] is None and not r["toxic"] for r in none)


def test_fit_evidence_and_threshold():
    x = Sparse(np.array([0, 0, 1, 1]), np.array([0, 1, 2, 3]), np.ones(4), 4)
    weights, tail = fit(x, np.zeros((4, 0)), np.array([1.0, 1, 0, 0]), 2, ChainParams(l2=0.01))
    assert weights[0] > 0 > weights[1] and len(tail) == 1
    g = evidence(np.array([10.0, 10.0]), np.array([10.0, 5.0]), 100, 50)
    assert g[0] > 10.83 and g[1] == pytest.approx(0, abs=1e-9)
    assert best_threshold(pd.DataFrame({"p": [0.9, 0.7, 0.2], "y": [1, 1, 0]})) == pytest.approx(0.45)
