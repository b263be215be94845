from __future__ import annotations

import random
from itertools import combinations

from martlet.llm.decontaminate import MASKS, SPAN, best_segment, contaminated, longest_segment, mask_positions, token_hashes, without_contaminated

import numpy as np


def items(spark, *rows):
    return spark.createDataFrame(list(rows), "item_id long, text string")


def test_planted_passages_are_found(spark, documents, prose):
    r = random.Random(2)
    bench = {i: prose(1000 + i, r.randint(20, 60)) for i in range(12)}
    rows, expected = [], set()
    for d in range(60):
        words = prose(d, 300).split()
        if d % 3 == 0:
            item = d % 12
            passage = bench[item].upper().split()
            if d % 2:  # one word in eight is another
                passage = [w if i % 8 != 4 else "zzz" for i, w in enumerate(passage)]
            words[100:100] = [f"*{w}*," for w in passage]
            expected.add((d, item))
        rows.append((d, " ".join(words)))
    docs = documents(*rows)
    benchmark = items(spark, *bench.items())
    got = {(x["doc_id"], x["item_id"]) for x in contaminated(docs, benchmark).collect()}
    assert got == expected
    kept = {x["doc_id"] for x in without_contaminated(docs, benchmark).collect()}
    assert kept == {d for d in range(60)} - {d for d, _ in expected}


def test_short_items_and_overlap_size(spark, documents, prose):
    bench = items(spark, (1, "alpha beta gamma delta epsilon zeta"), (2, "one two"), (3, None), (4, ""), (5, prose(77, 40)))
    half = " ".join(prose(77, 40).split()[:12])
    docs = documents(
        (1, prose(1, 40) + " Alpha, beta gamma delta epsilon ZETA " + prose(2, 40)),
        (2, "one two three"), (3, prose(3, 30) + " " + half + " " + prose(4, 30)), (4, None), (5, ""),
        (6, "alpha beta gamma delta epsilon other"),
    )
    got = {(x["doc_id"], x["item_id"]): x for x in contaminated(docs, bench).collect()}
    assert set(got) == {(1, 1)}  # 12 of 40 tokens are less than the least overlap
    assert got[1, 1]["n_tokens"] == got[1, 1]["n_equal"] == 6 and got[1, 1]["doc_start"] == 40


def test_repeats_nulls_and_empty_tables(spark, documents, prose):
    passage = prose(5, 30)
    docs = documents((1, passage), (1, passage), (None, passage), (2, prose(6, 30))).selectExpr("*", "1 AS start", "2 AS tokens")
    bench = items(spark, (8, passage), (8, passage), (9, passage), (None, passage))
    rows = contaminated(docs, bench).collect()
    assert sorted((x["doc_id"], x["item_id"]) for x in rows) == [(1, 8), (1, 9)]
    assert without_contaminated(docs, bench).columns == docs.columns
    assert without_contaminated(docs, bench).count() == 2
    assert contaminated(docs.where("false"), bench).count() == 0
    assert contaminated(docs, bench.where("false")).count() == 0


def test_segment_and_tokens():
    equal = np.array([0, 1, 1, 1, 1, 0, 1, 1, 1, 1, 0, 0, 0, 1], bool)
    assert best_segment(equal, 0.8) == (1, 10)
    assert len(token_hashes("A a | *** b.")) == 3
    assert token_hashes("(Word)")[0] == token_hashes("word")[0]


def test_every_place_of_replaced_words_has_a_seed():
    fixed = [(len(m), sum(1 << i for i, bit in enumerate(m) if bit == "1")) for m in MASKS]
    for n, k in ((13, 2), (14, 2), (15, 3), (20, 4), (25, 5)):
        for gone in combinations(range(n), k):
            kept = (1 << n) - 1 - sum(1 << x for x in gone)
            assert any(kept >> i & mask == mask for span, mask in fixed for i in range(n - span + 1)), (n, gone)
    for n in range(5, SPAN + 1):  # whole items, which begin and end with an equal token
        for gone in combinations(range(1, n - 1), n // 5):
            assert any(not set(gone) & set(p) for span, p in mask_positions([n])[len(MASKS):] if span == n), (n, gone)


def test_every_place_of_replaced_words_is_accepted():
    for n in range(5, 16):
        for gone in combinations(range(1, n - 1), n // 5):
            equal = np.ones(n, bool)
            equal[list(gone)] = False
            assert longest_segment(np.concatenate([[False] * 5, equal, [False] * 5]), 0.8) == (5, 5 + n)


def test_replaced_words_are_found(spark, documents, prose):
    bench, rows, expected = {}, [], set()
    for n in (5, 7, 9, 10, 12, 13, 15):
        bench[n] = prose(2000 + n, n)
        for j, gone in enumerate(combinations(range(1, n - 1), n // 5)):
            if j % 5 == 0 or n < 10:
                words = [f"other{i}" if i in gone else w for i, w in enumerate(bench[n].split())]
                rows.append((n * 1000 + j, " ".join([prose(n * 1000 + j, 30), *words, prose(n * 1000 + j + 500, 30)])))
                expected.add((n * 1000 + j, n))
    got = {(x["doc_id"], x["item_id"]) for x in contaminated(documents(*rows), items(spark, *bench.items())).collect()}
    assert expected <= got
