from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from martlet.llm import permuterm as P


def brute_words(rows, min_length=7, min_count=2, planted=True):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if planted and h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= min_length:
                counts[run] += 1
    return {w: n for w, n in counts.items() if n >= min_count}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) - len(short) == 1 and any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def brute(words, ratio=10):
    out = {}
    for w, n in words.items():
        near = [v for v in words if abs(len(v) - len(w)) <= 1 and one_edit(v, w)]
        best = min(near, key=lambda v: (-words[v], v), default=None)
        form = best if best is not None and words[best] >= ratio * n else None
        out[w] = (n, len(near), form, None if form is None else words[form])
    def root(w):
        while out[w][2] is not None:
            w = out[w][2]
        return w
    return {w: (*v, root(w)) for w, v in out.items()}


def found(df):
    return {r["word"]: (r["n"], r["n_near"], r["form"], r["form_n"], r["root"]) for r in df.collect()}


def variants(r, word, alphabet):
    at = r.randrange(len(word))
    c = r.choice(alphabet)
    return r.choice([word[:at] + c + word[at:], word[:at] + word[at + 1 :], word[:at] + c + word[at + 1 :]])


def test_variants_match_brute_force(spark, documents):
    r = random.Random(4)
    alphabet = "aabbcé×ÿ"
    bases = ["".join(r.choice(alphabet) for _ in range(r.randint(7, 11))) for _ in range(12)]
    tokens = []
    for i, b in enumerate(bases):
        tokens += [b] * r.choice([3, 40, 400])
        for _ in range(12):
            v = variants(r, b, alphabet)
            tokens += [v] * r.randint(1, 30)
            tokens += [variants(r, v, alphabet)] * r.randint(1, 3)
    r.shuffle(tokens)
    sep = [" ", "-", "\n", "7", "ß9", "Ā", "中"]
    rows = [(i, "".join(t.upper() if r.random() < 0.2 else t + r.choice(sep[:4]) + " " for t in tokens[i::7])) for i in range(7)]
    rows.append((7, "x".join([" ".join(tokens[:50]), "Ā".join(tokens[50:90]), "中".join(tokens[90:120])])))
    rows += [(8 + i, "chainaaaa " * 500 + "chainaaab " * 40 + "chainaabb " * 3) for i in range(3)]
    expected = brute(brute_words(rows))
    got = found(P.spelling_variants(documents(*rows), planted_typos=True))
    assert got == expected
    assert any(v[2] for v in expected.values()) and any(v[1] > 3 for v in expected.values())
    assert any(v[4] != v[2] and v[2] for v in expected.values()), "no chain of forms"
    plain = found(P.spelling_variants(documents(*rows), min_length=4, min_count=1, ratio=3))
    assert plain == brute(brute_words(rows, 4, 1, planted=False), 3)


def test_long_runs_are_grouped_by_hash(spark, documents):
    r = random.Random(6)
    words = []
    for n in (61, 62, 63, 64, 65, 66, 300):
        base = "".join(r.choice("abc") for _ in range(n))
        words += [base] * 30 + [base + "a"] * 3 + [base[:5] + base[6:]] * 2 + [base[:9] + "z" + base[10:]] * 3
        words += [base[0] + base] * 2
    text = " ".join(words)
    rows = [(1, text), (2, None)]
    assert found(P.spelling_variants(documents(*rows))) == brute(brute_words(rows, planted=False))


def test_a_run_as_long_as_a_document_stays_linear(spark, documents):
    word = "abcdefghij" * 10_000
    other = word[:50_000] + "z" + word[50_001:]
    got = found(P.spelling_variants(documents((1, f"{word} {word} {other} {other} {other}"))))
    assert got == {word: (2, 1, None, None, word), other: (3, 1, None, None, other)}


def test_nulls_ties_repeats_and_clashing_columns(spark, documents):
    text = "lettera letterb letterc " * 2
    docs = documents((1, text), (1, text), (None, text), (None, None), (5, "")).selectExpr("*", "'q' AS word", "1 AS n", "2 AS form")
    got = found(P.spelling_variants(docs))
    assert got == {w: (6, 2, None, None, w) for w in ("lettera", "letterb", "letterc")}
    more = documents((1, text + "letterd " * 40 + "lettere " * 40))
    near = found(P.spelling_variants(more))
    # Ties go to the smallest word.
    assert near["letterb"] == (2, 4, "letterd", 40, "letterd") and near["letterd"][2:] == (None, None, "letterd")
    with pytest.raises(ValueError):
        P.spelling_variants(docs, ratio=1)


def test_empty_table(spark, documents):
    assert P.spelling_variants(documents((1, "x")).where("false")).count() == 0
    assert P.spelling_variants(documents((1, None))).count() == 0


def test_ranges_are_dealt_by_what_all_members_share(spark):
    words = spark.createDataFrame([("abcdefg", 2), ("abcdefgh", 3)], "word string, n long")
    rows = P.rotations(words)
    assert rows.count() == 17 and rows.where(F.char_length("rotation") < 8).count() == 0
