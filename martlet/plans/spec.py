"""Mart specifications: one place that fixes a mart's schema, partition and lineage.

The DDL statements, the projection of the source, the casts on insert and the
column-set check all derive from a ``MartSpec``; no SQL text is split or
templated.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import SparkSession
from pyspark.sql.types import (
    DataType,
    DateType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from martlet.sources.tables import quote_identifier


@dataclass(frozen=True)
class MartSpec:
    """A mart table: external Parquet, one partition column per load date.

    ``columns`` lists the data columns in table order: the business columns the
    source provides, then the two lineage columns (source load id, current load
    id). ``partition_type`` is ``DateType`` by default; ``TimestampType`` is
    accepted for marts declared with a timestamp partition.
    """

    table: str
    location: str
    columns: StructType
    lineage_column: str | None = None
    load_id_column: str | None = "ctl_loading"
    partition_column: str = "ctl_validfrom"
    partition_type: DataType = field(default_factory=DateType)
    source_load_id_column: str | None = "ctl_loading"

    @property
    def business_columns(self) -> list[str]:
        skip = {self.lineage_column, self.load_id_column}
        return [f.name for f in self.columns.fields if f.name not in skip]

    @property
    def schema(self) -> StructType:
        """Full table schema: data columns then the partition column."""
        return StructType(
            list(self.columns.fields) + [StructField(self.partition_column, self.partition_type)]
        )

    # -- DDL ---------------------------------------------------------------
    def create_statement(self, if_not_exists: bool = True) -> str:
        cols = ", ".join(
            f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema.fields
        )
        guard = "IF NOT EXISTS " if if_not_exists else ""
        return (
            f"CREATE TABLE {guard}{quote_identifier(self.table)} ({cols}) USING parquet "
            f"PARTITIONED BY (`{self.partition_column}`) LOCATION '{_sql_string(self.location)}'"
        )

    def drop_statement(self) -> str:
        return f"DROP TABLE IF EXISTS {quote_identifier(self.table)}"

    def repair_statement(self) -> str:
        return f"MSCK REPAIR TABLE {quote_identifier(self.table)} SYNC PARTITIONS"

    def recreate_statements(self) -> list[str]:
        """Drop, create, rediscover partitions. Data files are kept on purpose."""
        return [self.drop_statement(), self.create_statement(), self.repair_statement()]


def spec_for_frame(df, table: str, location: str, partition_column: str = "ctl_validfrom") -> MartSpec:
    """Spec of a plain partitioned table shaped like ``df`` (no lineage columns)."""
    fields = [f for f in df.schema.fields if f.name != partition_column]
    return MartSpec(
        table=table,
        location=location,
        columns=StructType(fields),
        lineage_column=None,
        load_id_column=None,
        partition_column=partition_column,
        partition_type=df.schema[partition_column].dataType,
        source_load_id_column=None,
    )


def recreate(spark: SparkSession, *specs: MartSpec) -> None:
    """Drop and create each mart over its location, then rediscover partitions."""
    from martlet.sources.hadoop_fs import HadoopFS

    fs = HadoopFS(spark)
    for spec in specs:
        fs.mkdirs(spec.location)
        for statement in spec.recreate_statements():
            spark.sql(statement)


def refreshed(spark: SparkSession, *specs: MartSpec) -> None:
    """Each mart as declared, with the partitions its folder has: recreated where it
    is absent or declared otherwise, else repaired by the difference of catalog and
    disk only."""
    from martlet.operators.partitions import repair_partitions

    for spec in specs:
        declared = [(f.name.lower(), f.dataType) for f in spec.schema.fields]
        if spark.catalog.tableExists(spec.table) and declared == [
            (f.name.lower(), f.dataType) for f in spark.table(spec.table).schema.fields
        ]:
            repair_partitions(spark, spec)
        else:
            recreate(spark, spec)


def ensure_table(spark: SparkSession, spec: MartSpec) -> None:
    """Create the mart when absent (and pick up partitions already on disk)."""
    from martlet.sources.hadoop_fs import HadoopFS

    if not spark.catalog.tableExists(spec.table):
        HadoopFS(spark).mkdirs(spec.location)
        spark.sql(spec.create_statement())
        spark.sql(spec.repair_statement())


def partition_literal(spec: MartSpec, value) -> str:
    """Typed SQL literal for a partition value (a ``date`` or ISO date string)."""
    import datetime as _dt

    if isinstance(value, str):
        value = _dt.date.fromisoformat(value[:10])
    if isinstance(value, _dt.datetime):
        value = value.date()
    if not isinstance(value, _dt.date):
        raise TypeError(f"partition value must be a date, got {value!r}")
    kind = spec.partition_type.simpleString()
    if kind == "date":
        return f"DATE'{value.isoformat()}'"
    if kind in ("timestamp", "timestamp_ntz"):
        return f"{kind.upper()}'{value.isoformat()} 00:00:00'"
    raise TypeError(f"unsupported partition type {kind}")


def _sql_string(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")


# The two mart schemas (data columns in table order) and their
# lineage column names.
PAYROLL_COLUMNS = StructType(
    [
        StructField("epk_id", LongType()),
        StructField("inn", LongType()),
        StructField("gosb_id", IntegerType()),
        StructField("enrollment_type", IntegerType()),
        StructField("amt", LongType()),
        StructField("report_dt", StringType()),
        StructField("src_loading_id", LongType()),
        StructField("ctl_loading", LongType()),
    ]
)
PAYROLL_LINEAGE_COLUMN = "src_loading_id"

MERCHANT_COLUMNS = StructType(
    [
        StructField("merch_id", StringType()),
        StructField("inn", LongType()),
        StructField("gosb_id", IntegerType()),
        StructField("src_ctl_loading", LongType()),
        StructField("ctl_loading", LongType()),
    ]
)
MERCHANT_LINEAGE_COLUMN = "src_ctl_loading"


def payroll_spec(table: str, location: str, partition_type: DataType | None = None) -> MartSpec:
    return MartSpec(
        table=table,
        location=location,
        columns=PAYROLL_COLUMNS,
        lineage_column=PAYROLL_LINEAGE_COLUMN,
        partition_type=partition_type or DateType(),
    )


def merchant_spec(table: str, location: str, partition_type: DataType | None = None) -> MartSpec:
    return MartSpec(
        table=table,
        location=location,
        columns=MERCHANT_COLUMNS,
        lineage_column=MERCHANT_LINEAGE_COLUMN,
        partition_type=partition_type or DateType(),
    )
