"""Property tests (hypothesis): retention complement, partition value round trip."""

from __future__ import annotations

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from martlet.operators.partitions import apply_retention_to_path
from martlet.session import new_work_dir
from martlet.sources.files import list_partition_files

YEARS = [dt.date(y, 1, 1) for y in range(1995, 2002)]
SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


@SETTINGS
@given(
    lo=st.one_of(st.none(), st.dates(dt.date(1994, 1, 1), dt.date(2003, 1, 1))),
    hi=st.one_of(st.none(), st.dates(dt.date(1994, 1, 1), dt.date(2003, 1, 1))),
)
def test_retention_leaves_exactly_the_complement(spark, lo, hi):
    root = new_work_dir(spark, "prop") + "/r"
    spark.createDataFrame([(i, d) for i, d in enumerate(YEARS)], "id int, d date").write.partitionBy("d").parquet(root)
    apply_retention_to_path(spark, root, "d", lo, hi)
    spark.catalog.refreshByPath(root)
    left = sorted(r[0] for r in spark.read.parquet(root).select("d").collect()) if _has_data(spark, root) else []
    expected = [d for d in YEARS if not ((lo is None or d > lo) and (hi is None or d < hi))]
    assert left == expected


def _has_data(spark, root):
    import os

    from martlet.session import local_path

    return any(n.startswith("d=") for n in os.listdir(local_path(root)))


@SETTINGS
@given(values=st.lists(
    st.text(st.characters(blacklist_categories=("Cs", "Cc")), min_size=1, max_size=8).filter(
        lambda v: v.strip() == v
    ),
    min_size=1, max_size=5, unique=True))
def test_partition_values_round_trip(spark, values):
    root = new_work_dir(spark, "prop") + "/v"
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, k string")
    df.write.partitionBy("k").parquet(root)
    got = sorted(r[0] for r in list_partition_files(spark, root, "k", "string").select("k").distinct().collect())
    assert got == sorted(values)


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    target=st.integers(min_value=2_000, max_value=400_000),
    start_year=st.integers(min_value=1994, max_value=2002),
    strategy=st.sampled_from(["auto", "salted"]),
)
def test_compaction_keeps_rows_and_never_exceeds_n(spark, target, start_year, strategy):
    import os

    from martlet.operators.compact import compact
    from martlet.plans.analogs import lineitem_by_year
    from martlet.session import local_path

    from conftest import SF_SMALL

    root = new_work_dir(spark, "prop") + "/c"
    src = lineitem_by_year(spark, SF_SMALL)
    src.repartition(6, "l_orderkey").write.partitionBy("ctl_validfrom").parquet(root)
    res = compact(spark, root, "ctl_validfrom", "date", dt.date(start_year, 1, 1), target, strategy=strategy)
    n_of = {p["fragment"]: p["n_files"] for p in res.plan}
    for frag, n in n_of.items():
        files = [f for f in os.listdir(os.path.join(local_path(root), frag)) if f.endswith(".parquet")]
        assert 1 <= len(files) <= n
    back = spark.read.parquet(root).select(*src.columns)
    assert back.count() == src.count()
    assert back.exceptAll(src).count() == 0 and src.exceptAll(back).count() == 0
