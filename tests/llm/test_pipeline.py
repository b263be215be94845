from __future__ import annotations

import corpus_pipeline

from martlet.llm.queries import ORACLE_SQL, QUERIES

from .tests_data import MEDIUM, SMALL


def test_stages_are_in_order_and_keep_the_columns(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert len(names) == 5 and names[0].startswith("quality") and names[-1].startswith("source")
    assert set(QUERIES) == {f"op{n}_" + x for n, x in enumerate(
        ["lm_scoring", "toxicity", "quality_rules", "compact_windows", "site_style_tree", "decontamination", "surrogates", "chat_format", "mixing", "simhash",
         "superminhash", "permuterm", "prefix_trie"], 1)}
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SMALL)
        assert out.schema.names == docs.schema.names and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]
        empty = stage(spark, docs.where("false"), SMALL)
        assert empty.count() == 0


def test_run_equals_its_operators_by_hand(spark):
    """Every decision takes effect: ids by brute force over the kept texts."""
    from martlet.llm.quality_rules import LineRules, judge
    from .test_decontaminate_brute import leaks
    from .test_simhash import brute_components, brute_fingerprint

    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet").collect()
    kept = {r["doc_id"]: v.clean_text for r in docs if (v := judge(r["text"], LineRules())).kept}
    groups = brute_components({d: brute_fingerprint(t) for d, t in kept.items()})
    kept = {d: t for d, t in kept.items() if groups[d] == d}
    bench = [r["text"] for r in spark.read.parquet(f"{MEDIUM}/benchmark.parquet").collect()]
    gone = leaks(kept, bench)
    out = {r["doc_id"]: r for r in corpus_pipeline.run(spark, MEDIUM).collect()}
    assert set(out) == set(kept) - gone
    assert all(r["size"] == len(kept[d].encode().split()) for d, r in out.items())


def test_sql_exists_only_where_it_can(spark):
    assert set(ORACLE_SQL) <= set(QUERIES) and corpus_pipeline.ORACLE_SQL is None


def test_nulls_repeats_ties_and_clashing_columns(spark, documents, prose, tmp_path):
    """What every stage does with odd rows, and that surrogates reach the end."""
    a, b, c = (prose(seed, 120) for seed in (41, 42, 43))
    mail = "Write to anna.smith34@mail7.example.org soon. "
    rows = [(1, mail + a), (1, mail + a), (1, b), (2, mail + a), (None, c), (None, None), (4, ""), (5, None)]
    docs = documents(*rows).selectExpr("*", "'k' AS copies", "1 AS fp", "'w' AS whole", "2 AS kept", "3 AS row")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{SMALL}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path))
    got = sorted((r["doc_id"] or -1, r["text"].split(". ", 1)[-1]) for r in out.collect())
    assert got == sorted([(1, a), (1, b), (-1, c)])
    assert not [r for r in out.collect() if "anna" in r["text"].lower() or "mail7" in r["text"]]
    assert {"text", "lang", "fp", "whole", "kept", "row", "size", "taken", "copies"} <= set(out.columns)
    assert all(r["n_chars"] == len(r["text"]) and (r["fp"], r["whole"], r["kept"], r["row"]) == (1, "w", 2, 3) for r in out.collect())
