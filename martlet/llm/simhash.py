"""Operator 10: SimHash near-duplicates by pivot distance tables.

1. Fingerprints: every bit is the majority of that bit over the XXH64 hashes
   (seed 42) of the word shingles, repeats included.
2. Equal fingerprints form one class, named by its smallest ``doc_id``; all
   later steps work on one row per distinct fingerprint, so a group of copies
   of any size costs one row.
3. Distance table: the Hamming distances of each distinct fingerprint to 16
   fixed reference fingerprints, packed one byte each into two longs.
4. Candidate pairs agree on enough blocks of bits (of ``max_distance + 3``
   blocks, at most ``max_distance`` can differ, so some three agree whole): an
   equi-join on those bits, exact for every pair within the distance.
5. A pair whose largest coordinate difference in the distance table exceeds
   the distance cannot be within it (triangle inequality) and is discarded;
   survivors are verified by the Hamming distance itself. Both tests are part
   of the join condition, so only links leave the join. Among distinct
   64-bit fingerprints a row has at most 2,080 partners within two bits.
6. Links become components by star contraction.

Defined results: a text without words (null, empty, white space) has the
fingerprint zero and is linked like any other; fewer words than the shingle
length give one shingle of all words; repeated rows are kept as rows; rows with
a null ``doc_id`` link like any other but never name a component that has a
named document; an empty table gives an empty result.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from martlet.llm.common import checkpointed, stored, text_bytes
from martlet.llm.components import connected_components

#: Shingles hashed before their bits are added up, to bound memory on long texts.
CHUNK = 1 << 15
N_PIVOTS = 16


def shingle_hashes(text: bytes, length: int) -> Iterator[list[int]]:
    """XXH64 of the lower-cased word shingles, in chunks."""
    words = text.lower().split()
    n = len(words)
    if n == 0:
        return
    joined = b" ".join(words)
    if n <= length:
        yield [xxhash.xxh64_intdigest(joined, 42)]
        return
    ends = list(itertools.accumulate(len(w) + 1 for w in words))
    starts = [0, *ends[: n - length]]
    digest = xxhash.xxh64_intdigest
    for at in range(0, n - length + 1, CHUNK):
        yield [
            digest(joined[s : e - 1], 42)
            for s, e in zip(starts[at : at + CHUNK], ends[at + length - 1 : at + length - 1 + CHUNK])
        ]


def fingerprint(text: str | None, length: int) -> int:
    """The unsigned 64-bit fingerprint of one text (no words: 0)."""
    ones = np.zeros(64, np.int64)
    total = 0
    for chunk in shingle_hashes(text_bytes(text), length):
        hashes = np.array(chunk, dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
        total += len(chunk)
    majority = (2 * ones > total).astype(np.uint8)
    return int.from_bytes(np.packbits(majority, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, shingle_words: int = 3) -> DataFrame:
    """``(doc_id, fp)`` per row; ``fp`` as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(x.as_py(), shingle_words) for x in batch.column(1)], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], ["doc_id", "fp"])

    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, fp long")


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def pivots() -> list[int]:
    """Fixed reference fingerprints, as signed longs."""
    return [_signed(xxhash.xxh64_intdigest(f"pivot {i}".encode(), 42)) for i in range(N_PIVOTS)]


def with_distance_table(fps: DataFrame) -> DataFrame:
    """Adds ``d0`` and ``d1``: the distances to eight pivots each, a byte apiece."""
    def packed(some: list[int]) -> Column:
        parts = [
            F.shiftleft(F.bit_count(F.col("fp").bitwiseXOR(F.lit(p))).cast("long"), 8 * i)
            for i, p in enumerate(some)
        ]
        out = parts[0]
        for part in parts[1:]:
            out = out.bitwiseOR(part)
        return out

    refs = pivots()
    return fps.withColumns({"d0": packed(refs[:8]), "d1": packed(refs[8:])})


def _coordinates_close(left: Column, right: Column, limit: int) -> Column:
    out = F.lit(True)
    for i in range(8):
        x = F.shiftright(left, 8 * i).bitwiseAND(F.lit(255))
        y = F.shiftright(right, 8 * i).bitwiseAND(F.lit(255))
        out = out & (F.abs(x - y) <= limit)
    return out


def block_masks(max_distance: int) -> list[int]:
    """Masks of every three of ``max_distance + 3`` blocks, as signed longs."""
    n = max_distance + 3
    edges = [64 * i // n for i in range(n + 1)]
    blocks = [((1 << (hi - lo)) - 1) << lo for lo, hi in zip(edges, edges[1:])]
    return [_signed(sum(some)) for some in itertools.combinations(blocks, 3)]


def links(classes: DataFrame, max_distance: int) -> DataFrame:
    """``(a, b)``: class names of distinct fingerprints within the distance."""
    table = with_distance_table(classes)
    keyed = table.select(
        "fp", "rep", "d0", "d1",
        F.explode(F.array(*[
            F.struct(F.lit(i).alias("j"), F.col("fp").bitwiseAND(F.lit(m)).alias("bits"))
            for i, m in enumerate(block_masks(max_distance))
        ])).alias("key"),
    ).select("fp", "rep", "d0", "d1", "key.j", "key.bits")
    x, y = keyed.alias("x"), keyed.alias("y")
    near = (
        (F.col("x.j") == F.col("y.j"))
        & (F.col("x.bits") == F.col("y.bits"))
        & (F.col("x.fp") < F.col("y.fp"))
        & _coordinates_close(F.col("x.d0"), F.col("y.d0"), max_distance)
        & _coordinates_close(F.col("x.d1"), F.col("y.d1"), max_distance)
        & (F.bit_count(F.col("x.fp").bitwiseXOR(F.col("y.fp"))) <= max_distance)
    )
    return x.join(y, near).select(F.col("x.rep").alias("a"), F.col("y.rep").alias("b"))


def _grouped(fps: DataFrame, max_distance: int) -> DataFrame:
    """``fp, group, component_id`` per distinct fingerprint of ``doc_id, fp`` rows."""
    # A class of nameless rows alone still needs a name that no document has.
    classes = checkpointed(
        fps.groupBy("fp").agg(F.min("doc_id").alias("named"))
        .withColumn("rep", F.struct(F.col("named").isNull().alias("nameless"), F.col("named"), F.col("fp")))
    )
    found = connected_components(links(classes.select("fp", "rep"), max_distance))
    return (
        classes.select("fp", "rep").join(found, F.col("rep") == F.col("node"), "left")
        .select("fp", F.coalesce("component", "rep").alias("group")).withColumn("component_id", F.col("group")["named"])
    )


def near_duplicates(docs: DataFrame, shingle_words: int = 3, max_distance: int = 2) -> DataFrame:
    """``doc_id, fingerprint, component_id`` per row of ``docs``."""
    fps = checkpointed(fingerprints(docs, shingle_words))
    return (
        fps.join(_grouped(fps, max_distance).drop("group"), "fp")
        .select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
    )


def one_of_each_group(docs: DataFrame, shingle_words: int = 3, max_distance: int = 2) -> DataFrame:
    """The documents left when only one of each group stays, all columns.

    The smallest ``doc_id`` stays; of rows that repeat it within the group, one.
    Rows that share a ``doc_id`` but not a group are different documents. Rows with
    a null ``doc_id`` cannot be named and stay.
    """
    whole = F.struct(*[docs[c] for c in docs.columns])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(x.as_py(), shingle_words) for x in batch.column(1)], dtype=np.uint64)
            fps = pa.array(found.view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), fps], ["doc_id", "whole", "fp"])

    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"), whole.alias("whole"))
    schema = StructType([StructField("doc_id", LongType()), StructField("whole", docs.schema), StructField("fp", LongType())])
    tagged = stored(rows.mapInArrow(run, schema), "simhash-rows")
    named = tagged.where("doc_id IS NOT NULL")
    groups = checkpointed(_grouped(tagged.select("doc_id", "fp"), max_distance))
    kept = (
        named.select("doc_id", "fp").distinct().join(groups, "fp").where("doc_id = component_id")
        .groupBy("group").agg(F.min(F.struct("doc_id", "fp")).alias("kept")).select("kept.*")
    )
    one = named.join(kept, ["doc_id", "fp"]).dropDuplicates(["doc_id", "fp"])
    return one.unionByName(tagged.where("doc_id IS NULL").select(*one.columns)).select("whole.*")
