from __future__ import annotations

import random

import numpy as np
import pytest

from martlet.llm import superminhash as S


def brute_set(text):
    words = (text or "").encode().lower().split()
    return {" ".join(w.decode() for w in words[i : i + 2]) for i in range(max(1, len(words) - 1))} if words else set()


def brute_components(sets):
    """``sets`` by document; smallest document reachable over links."""
    least = {d: d for d in sets}
    ids = sorted(sets)
    links = [
        (a, b) for i, b in enumerate(ids) for a in ids[:i]
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
    ]
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(least[a], least[b])
            changed |= least[a] != low or least[b] != low
            least[a] = least[b] = low
    return least


def brute_signature(elements, m):
    """The sequential algorithm: one element after the other, one swap a step."""
    least = [None] * m
    for e in elements:
        walk = list(range(m))
        for j in range(m):
            drawn = int(S._mixed(np.array([(e + (j + 1) * int(S._GOLDEN)) % 2**64], np.uint64))[0])
            k = j + ((drawn >> 40) * (m - j) >> 24)
            walk[j], walk[k] = walk[k], walk[j]
            value = (j << 40) | (drawn & ((1 << 40) - 1))
            if least[walk[j]] is None or value < least[walk[j]]:
                least[walk[j]] = value
    return least


@pytest.mark.parametrize("n", [1, 2, 7, 60, 700])
def test_signature_is_that_of_the_sequential_algorithm(n, monkeypatch):
    r = random.Random(n)
    elements = [r.getrandbits(64) for _ in range(n)]
    expected = brute_signature(elements, 24)
    assert S.signature(np.array(elements, np.uint64), 24).tolist() == expected
    monkeypatch.setattr(S, "CHUNK", 13)
    assert S.signature(np.array(elements, np.uint64), 24).tolist() == expected


def test_signatures_estimate_similarity():
    r = random.Random(3)
    both = [r.getrandbits(64) for _ in range(800)]
    a, b = ([r.getrandbits(64) for _ in range(100)] for _ in range(2))
    x, y = (S.signature(np.array(both + own, np.uint64)) for own in (a, b))
    assert abs((x == y).mean() - 0.8) < 0.08


def edited(text, r, n):
    words = text.split()
    for _ in range(n):
        words[r.randrange(len(words))] = "x" + str(r.randrange(1000))
    return " ".join(words)


def test_components_match_brute_force(spark, documents, prose):
    r = random.Random(1)
    texts = []
    for seed in range(14):
        base = prose(seed, r.choice([3, 12, 60, 200]))
        texts += [base, base.upper(), base.replace(" ", "\n\t")]
        n = len(base.split())
        # Around the limit, on both sides of it.
        texts += [edited(base, r, r.randint(0, max(1, n // 12))) for _ in range(9)]
    texts += [None, "", " \n", "one", "One", "two", "Éa b", "éa b"]
    r.shuffle(texts)
    docs = documents(*enumerate(texts))
    sets = {i: brute_set(t and "".join(c.lower() if c.isascii() else c for c in t)) for i, t in enumerate(texts)}
    least = brute_components(sets)
    rows = {x["doc_id"]: x for x in S.near_duplicates(docs).collect()}
    assert len(rows) == len(texts)
    assert {d: x["n_shingles"] for d, x in rows.items()} == {d: len(s) for d, s in sets.items()}
    assert {d: x["component_id"] for d, x in rows.items()} == least
    assert all(x["kept"] == (d == least[d]) for d, x in rows.items())
    assert len(set(least.values())) < len(texts) - 20


def test_chain_is_followed_through_buckets_whose_leader_links_to_few(spark, documents, prose):
    """Each text is like the next one only, so most members fail their leader."""
    words = prose(5, 400).split()
    texts = []
    for i in range(40):
        texts.append(" ".join(words))
        words[(i * 17) % 400] = f"a{i}"
        words[(i * 17 + 8) % 400] = f"b{i}"
    docs = documents(*enumerate(texts))
    expected = brute_components({i: brute_set(t) for i, t in enumerate(texts)})
    assert {x["doc_id"]: x["component_id"] for x in S.near_duplicates(docs).collect()} == expected
    assert set(expected.values()) == {0}


def test_family_just_under_the_limit_has_no_links(spark, documents, prose):
    """Large buckets without a link: every pair is tried, none accepted."""
    words = prose(8, 200).split()
    r = random.Random(2)
    texts = []
    for i in range(60):
        own = list(words)
        for at in r.sample(range(0, 200, 4), 16):
            own[at] = f"w{i}x{at}"
        texts.append(" ".join(own))
    texts.append(edited(texts[17], r, 2))
    docs = documents(*enumerate(texts))
    expected = brute_components({i: brute_set(t) for i, t in enumerate(texts)})
    assert {x["doc_id"]: x["component_id"] for x in S.near_duplicates(docs).collect()} == expected
    assert expected[60] == 17


def test_nulls_repeats_long_texts_and_clashing_columns(spark, documents, prose):
    long = prose(9, 30_000)
    docs = documents((4, long), (2, edited(long, random.Random(4), 50)), (7, long), (7, long), (None, long), (None, "lone words here"), (9, None))
    docs = docs.selectExpr("*", "1 AS cid", "'x' AS bucket", "2L AS row", "3 AS component_id", "4 AS digest")
    rows = sorted(((x["doc_id"] or -1, x["component_id"], x["kept"]) for x in S.near_duplicates(docs).collect()), key=str)
    assert rows == sorted([(-1, 2, False), (-1, None, True), (2, 2, True), (4, 2, False), (7, 2, False), (7, 2, False), (9, 9, True)], key=str)
    assert S.near_duplicates(docs.where("false")).count() == 0
