from __future__ import annotations

import hashlib

from martlet.llm.chat_format import END, expand, read_back

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows):
    convs = {}
    for conv, turn, role, text in rows:
        convs.setdefault(conv, []).append((turn is not None, turn, role or "", text or ""))
    out = {}
    for conv, turns in convs.items():
        turns.sort(key=lambda t: (t[0], t[1] or 0, t[2].encode(), t[3].encode()))
        loss = "".join(t for _, _, r, t in turns if r == "assistant")
        whole = "".join(f"{r}\n{t}\n" for _, _, r, t in turns)
        out[conv] = (len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


ROWS = [
    (1, 0, "system", "be <nice> & [short]"), (1, 1, "user", "&lt; &amp;lt; <|end|>"), (1, 2, "assistant", "é <|start|>assistant<|text|>x"),
    (1, 3, "user", "more"), (1, 4, "assistant", ""), (1, 5, "assistant", "last"), (1, 6, "user", "tail"),
    (2, 0, "user", "no reply"), (3, 0, "assistant", "</s>[INST] ok [/INST]"),
    (4, None, None, None), (4, 1, "user", "same"), (4, 1, "user", "same"), (4, 1, "assistant", "a"),
    (None, 0, "user", "nobody"), (None, 1, "assistant", "yes"), (5, 0, "us\ner", "l1\nl2"), (5, 1, "assistant", "x" * 100_000),
]


def test_read_back_is_the_input(spark):
    data = spark.createDataFrame(ROWS, SCHEMA).selectExpr("*", "1 AS example", "'x' AS formatted")
    got = {r[0]: tuple(r)[1:5] for r in read_back(expand(data)).collect()}
    assert got == brute(ROWS)


def test_examples_train_one_reply_each(spark):
    examples = [r.asDict() for r in expand(spark.createDataFrame(ROWS, SCHEMA)).where("conv_id = 1").orderBy("example").collect()]
    assert len(examples) == 4  # three replies, and the closing turn of the user
    masked = [e["formatted"][e["loss_start"]:e["loss_end"]] if e["loss_start"] is not None else None for e in examples]
    assert masked == ["é &lt;|start|>assistant&lt;|text|>x", "", "last", None]
    assert [e["closes"] for e in examples] == [False, False, False, True]
    for one, two in zip(examples, examples[1:]):
        assert two["formatted"].startswith(one["formatted"])
    assert all(e["formatted"].count(END) == n for e, n in zip(examples, (3, 5, 6, 7)))


def test_no_python_and_empty_table(spark):
    data = spark.createDataFrame(ROWS, SCHEMA)
    plan = read_back(expand(data))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert read_back(expand(data.where("false"))).count() == 0
