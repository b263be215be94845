"""Print the formatted physical plans of the main operators (sf0.01 by default).

Usage: python tools/show_plans.py [sf_dir] > docs/plans.txt
"""

from __future__ import annotations

import datetime as dt
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from martlet.functions.runlog import envelope  # noqa: E402
from martlet.operators.compact import _rewritten, _scan, compaction_plan  # noqa: E402
from martlet.operators.load import snapshot_rows, source_facts  # noqa: E402
from martlet.operators.load import load_snapshot  # noqa: E402
from martlet.operators.stats import load_stat_rows, table_stats  # noqa: E402
from martlet.plans.analogs import lineitem_by_year, log_records, payroll_source, table  # noqa: E402
from martlet.plans.spec import payroll_spec  # noqa: E402
from martlet.session import get_session, new_work_dir, unique_name  # noqa: E402


def show(title, df):
    print(f"\n### {title}\n")
    df.explain("formatted")


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_session(master="local[8]", shuffle_partitions=8)
    src = payroll_source(spark, sf)
    spec = payroll_spec(unique_name("p"), new_work_dir(spark, "plans") + "/p")
    show("load: source facts (count, max load id)", source_facts(src, "ctl_loading"))
    show("load: rows into the partition",
         snapshot_rows(src, spec, 1, 42))
    show("table_stats", table_stats(src))
    for day in (24, 25):
        load_snapshot(spark, spec, src, loading_id=day, load_date=dt.date(2021, 10, day))
    show("load_stat_rows (loaded partition only)", load_stat_rows(
        spark.table(spec.table), loading_id=1, entity_id=1, load_date=dt.date(2021, 10, 25),
        app_id="app", newest_partition_value=dt.date(2021, 10, 25)))
    root = new_work_dir(spark, "plans") + "/t"
    lineitem_by_year(spark, sf).repartition(40, "l_orderkey").write.partitionBy("ctl_validfrom").parquet(root)
    plan = [r.asDict() for r in compaction_plan(spark, root, "ctl_validfrom", "date", dt.date(1998, 1, 1), 200_000).collect()]
    show("compaction plan (listing, no file opened)",
         compaction_plan(spark, root, "ctl_validfrom", "date", dt.date(1998, 1, 1), 200_000))
    paths = [f"{root}/{p['fragment']}" for p in plan]
    schema = lineitem_by_year(spark, sf).withColumn("ctl_validfrom", F.col("ctl_validfrom").cast("string")).schema
    show("compaction rewrite (one shuffle, salted)",
         _rewritten(_scan(spark, root, paths, schema), plan, ["ctl_validfrom"], "salted"))
    show("log envelope", envelope(log_records(table(spark, sf, "events")), "app"))
    spark.stop()


if __name__ == "__main__":
    main()
