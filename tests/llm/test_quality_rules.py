from __future__ import annotations

import re
from collections import Counter

from martlet.llm.quality_rules import LineRules, clean_documents, judge, judge_documents, line_fails


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    counts = Counter(windows)
    covered = {j for i, w in enumerate(windows) if counts[w] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return {
        "n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text or "")),
        "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered),
    }


def test_counts_match_brute_force(spark, documents, prose):
    texts = [
        None, "", " \n\t ", "one", "a b c a b c a b", prose(1, 80), prose(2, 60) + "\n" + prose(2, 60),
        "x # y | z\n\n x # y | z\nx # y | z", "café au lait   b", "w " * 5000,
    ]
    got = judge_documents(documents(*enumerate(texts))).collect()
    assert len(got) == len(texts)
    for row in got:
        expected = brute(texts[row["doc_id"]])
        assert {k: row[k] for k in expected} == expected, texts[row["doc_id"]]
        failed = expected["n_words"] < 50 or 100 * expected["n_repeat_words"] > 50 * expected["n_words"]
        assert row["base_failed"] == failed
        assert not (failed and row["kept"])


def test_line_rules():
    rules = LineRules()
    assert line_fails("Home | About | News | Contact | Help me.", rules)
    assert line_fails("short heading", rules)
    assert not line_fails("A short sentence.", rules)
    assert line_fails("BUY!! NOW!! OR!! NEVER!! friend.", rules)
    assert line_fails("a### b$$$ c%%% d&&& e.", rules)
    assert line_fails("All rights reserved by the authors of this long and winding page.", rules)
    assert not line_fails("", rules) and not line_fails(" \t", rules)


def test_clean_documents_removes_lines_and_rejects(spark, documents, prose):
    good = prose(3, 100)
    nav = "Home | About | News | Contact | Help"
    mostly_nav = prose(4, 20) + "\n" + "\n".join(f"Home{i} | About{i} | News{i} | Contact{i}" for i in range(40))
    out = clean_documents(documents((1, good + "\n" + nav), (2, mostly_nav), (3, None), (4, good))).collect()
    rows = {r["doc_id"]: r for r in out}
    assert set(rows) == {1, 4}
    assert rows[1]["text"] == good and rows[1]["n_chars"] == len(good)
    assert not judge(mostly_nav, LineRules()).kept


def test_empty_table_and_extra_columns(spark, documents, prose):
    assert clean_documents(documents().where("false")).count() == 0
    docs = documents((1, prose(5, 90))).selectExpr("*", "1 AS n_words", "true AS kept")
    assert judge_documents(docs).first()["n_words"] == 90
    assert clean_documents(docs).columns == docs.columns


def test_a_phrase_in_a_paragraph_keeps_it(spark, documents, prose):
    rules = LineRules()
    words = prose(6, 90).split()
    for phrase in ("cookies", "licensed under", "Click here", "subscribe to"):
        one_line = " ".join(words[:40] + [phrase] + words[40:])
        assert not line_fails(one_line, rules) and judge(one_line, rules).kept
        assert line_fails(f"Please {phrase} now and read all of this notice.", rules)
    assert line_fails(" ".join(words[:10] + ["Click here"] + words[10:20] + ["privacy policy"] + words[20:30]), rules)
    assert not line_fails("The cookiecutter stood on the long wooden table near us.", rules)
    long = "\n".join(" ".join(words[i : i + 30] + ["cookie."]) for i in (0, 30, 60))
    (row,) = clean_documents(documents((1, long))).collect()
    assert row["text"] == long
