"""The corpus pipeline: five operators of ``martlet.llm`` over ``documents``.

Each stage gets what the one before it kept, written as Parquet and read again,
so a stage never recomputes its predecessors and a lost executor costs tasks of
one stage only. The stage tables lie in a fresh folder below the shared folder
of ``spark.checkpoint.dir``.

Defined results: a null or empty text fails the quality rules and goes; rows that
repeat an id and a text leave one row, different texts of one id both stay; rows
without an id link and match like others and are never the ones that go for a
near-duplicate; equal texts get equal surrogates; further columns of any name are
carried through, but ``size, source_size, target, taken, copies`` are the mix's in
the last table; an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from martlet.llm.common import table
from martlet.llm.decontaminate import without_contaminated
from martlet.llm.mixing import mixed_corpus
from martlet.llm.quality_rules import clean_documents
from martlet.llm.simhash import one_of_each_group
from martlet.llm.surrogates import replace_personal_data
from martlet.session import new_work_dir

#: Key of the surrogates; a deployment passes its own secret.
SURROGATE_KEY = "corpus-pipeline"


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Failing lines go, and documents that lose too much text."""
    return clean_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays."""
    return one_of_each_group(docs, shingle_words=3, max_distance=2)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of ``benchmark`` go."""
    return without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def surrogates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data becomes surrogates."""
    return replace_personal_data(docs, key=SURROGATE_KEY)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The corpus with how often the mix takes each document (``copies``, 0 to 2)."""
    return mixed_corpus(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality),
    ("simhash_near_duplicates", near_duplicates),
    ("benchmark_decontamination", decontaminated),
    ("pii_surrogates", surrogates),
    ("source_mixing", mixed),
]

#: SQL cannot express fingerprint components, seeds or keyed draws.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over the whole ``documents`` table."""
    docs = table(spark, sf_dir, "documents")
    folder = new_work_dir(spark, "pipeline")
    for number, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
