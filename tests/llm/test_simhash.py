from __future__ import annotations

import random

import xxhash

from martlet.llm.components import connected_components
from martlet.llm.simhash import fingerprint, links, near_duplicates, one_of_each_group


def brute_fingerprint(text, k=3):
    words = [w for w in (text or "").encode().lower().split()]
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fps, distance=2):
    parent = {d: d for d in fps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(fps)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            if (fps[a] ^ fps[b]).bit_count() <= distance:
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {d: find(d) for d in ids}


def test_fingerprint_matches_brute_force(prose):
    for text in [None, "", " ", "One", "one TWO", "a b c", "Éa b Éa", prose(1, 400), "x y z " * 50_000]:
        assert fingerprint(text, 3) == brute_fingerprint(text)


def test_components_match_brute_force(spark, documents, prose):
    r = random.Random(5)
    texts = []
    for seed in range(12):
        base = prose(seed, 300).split()
        texts.append(" ".join(base))
        for _ in range(6):
            copy = list(base)
            for _ in range(r.randint(0, 2)):
                copy[r.randrange(len(copy))] = "other"
            texts.append(" ".join(copy))
    texts += [None, "", "\n", "One two", "one two"]
    docs = documents(*enumerate(texts))
    fps = {i: brute_fingerprint(t) for i, t in enumerate(texts)}
    expected = brute_components(fps)
    got = {r["doc_id"]: r for r in near_duplicates(docs).collect()}
    assert {d: r["component_id"] for d, r in got.items()} == expected
    assert {d: r["fingerprint"] for d, r in got.items()} == {d: f"{f:016x}" for d, f in fps.items()}
    assert len(set(expected.values())) < len(expected)
    kept = {r["doc_id"] for r in one_of_each_group(docs).collect()}
    assert kept == set(expected.values())


def test_links_find_every_pair_within_the_distance(spark):
    r = random.Random(9)
    values = {r.getrandbits(64) for _ in range(60)}
    for v in list(values):
        for _ in range(3):
            w = v
            for b in r.sample(range(64), r.randint(1, 3)):
                w ^= 1 << b
            values.add(w)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    classes = spark.createDataFrame([(v, i) for i, v in enumerate(signed)], "fp long, rep long")
    got = {tuple(sorted(x)) for x in links(classes, 2).distinct().collect()}
    expected = {
        (i, j) for j, y in enumerate(signed) for i, x in enumerate(signed[:j]) if ((x ^ y) & (2**64 - 1)).bit_count() <= 2
    }
    assert got == expected and expected


def test_rows_without_id_and_repeats(spark, documents, prose):
    text = prose(1, 50)
    docs = documents((7, text), (7, text), (None, text), (3, prose(2, 50)), (None, prose(4, 50)))
    rows = near_duplicates(docs).collect()
    assert len(rows) == 5
    assert {r["component_id"] for r in rows if r["doc_id"] == 7} == {7}
    assert sorted(r["component_id"] or -1 for r in rows if r["doc_id"] is None) == [-1, 7]
    kept = one_of_each_group(docs.selectExpr("*", "1 AS fp", "2 AS component_id", "3 AS __keep", "4 AS whole"))
    assert kept.columns[-3:] == ["component_id", "__keep", "whole"]
    assert sorted(r["doc_id"] or -1 for r in kept.collect()) == [-1, -1, 3, 7]
    assert near_duplicates(docs.where("false")).count() == 0


def test_components_of_a_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(500, i) for i in range(501, 600)]
    edges = spark.createDataFrame(chain + star + [(9, 9), (None, 3)], "a long, b long")
    got = dict(connected_components(edges).collect())
    assert got == {i: 100 for i in range(100, 161)} | {i: 500 for i in range(500, 600)}
    assert connected_components(edges.where("false")).count() == 0


def test_different_texts_of_one_id_both_stay(spark, documents, prose):
    a, b = prose(1, 80), prose(2, 80)
    rows = one_of_each_group(documents((1, a), (1, b), (1, a), (4, b), (5, a), (6, prose(3, 80)))).collect()
    assert sorted((r["doc_id"], r["text"] == a, r["text"] == b) for r in rows) == [(1, False, True), (1, True, False), (6, False, False)]
