"""Plan checks: no Python on the row path, pruning reaches the scan."""

from __future__ import annotations

import datetime as dt

import pytest

import __spark_entry__ as E
from martlet.operators.load import load_snapshot
from martlet.operators.stats import load_stat_rows
from martlet.plans.analogs import payroll_source
from martlet.plans.spec import payroll_spec
from martlet.session import unique_name

from conftest import SF_SMALL

PYTHON_NODES = ("PythonUDF", "BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas")


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", sorted(E.queries()))
def test_no_python_in_registered_plans(spark, key):
    plan = _plan(E.queries()[key](spark, SF_SMALL))
    assert not any(node in plan for node in PYTHON_NODES)


def test_load_reads_only_projected_columns(spark):
    src = payroll_source(spark, SF_SMALL)
    plan = _plan(src.select("epk_id", "amt"))
    assert "ReadSchema: struct<l_orderkey:bigint,l_extendedprice:double>" in plan


def test_stats_read_only_the_loaded_partition(spark, workdir):
    spec = payroll_spec(unique_name("pp"), f"{workdir}/pp")
    src = payroll_source(spark, SF_SMALL)
    for day in (24, 25):
        load_snapshot(spark, spec, src, loading_id=day, load_date=dt.date(2021, 10, day))
    rows = load_stat_rows(
        spark.table(spec.table), loading_id=1, entity_id=1, load_date=dt.date(2021, 10, 25),
        app_id="app", newest_partition_value=dt.date(2021, 10, 25),
    )
    plan = _plan(rows)
    assert "PartitionFilters: [isnotnull(ctl_validfrom" in plan and "2021-10-25" in plan
    assert "ReadSchema: struct<report_dt:string>" in plan


def test_partition_inventory_is_answered_by_footers(spark):
    df = E.queries()["partition_inventory"](spark, SF_SMALL)
    scan = [line for line in _plan(df).splitlines() if "BatchScan" in line]
    assert scan and "count(*)" in scan[0]
