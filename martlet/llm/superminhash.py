"""Operator 11: near-duplicates by SuperMinHash, banding and verification.

1. A document's set is its distinct 2-word shingles, as 64-bit hashes of the words'
   XXH64 values (distinct words and pairs of one document have distinct hashes but
   for chances of about n**2 / 2**65).
2. Signature (SuperMinHash): every element e walks its own permutation of the
   ``m`` positions. At step j it puts the value ``j + r`` (r random in [0, 1) from
   e and j) into the j-th position of its walk, where that is less than what is
   there. All values of step j lie in [j, j + 1), so the walk stops after the first
   step at which no position is empty: early for any but the smallest sets. All
   elements of a set take a step at once, in numpy; long sets go in chunks, each
   of which stops as early.
3. Documents of equal sets (128-bit digest) are one class; all later steps work on
   classes, so copies cost a row each and no pairs.
4. Bands: ``N_BANDS`` buckets of ``BAND_ROWS`` positions each. Two sets 0.8 alike
   miss each other with probability (1 - 0.8**6)**32, under 1e-4. Classes that share
   a bucket get their full sets and a bit map of 4 to 8 bits an element: the bits in
   which two maps differ are no more than the elements in which the sets do, so a
   pair with too many (or of too different sizes) is no link for certain.
5. Candidates without all pairs of a bucket: first every member with its bucket's
   most central one, the one whose buckets hold most (of copies, that is what they
   were made from). Buckets whose members are of one component then cost nothing
   more. In those that are still open, every member is compared with the members of
   other components, each pair in the first bucket that both are in; what the bit
   maps rule out does not leave the join. So no pair of a bucket is left out, but
   those that a component joins already or that cannot be links.
6. Verification: candidates are joined with both full sets; a link is
   ``100 * intersection >= 80 * union``.
7. Components of links by star contraction (the distributed union-find).

Skew: the joins on buckets and classes are sort-merge joins of a stored many-side
with a side of one row a key, which adaptive execution splits where a key is hot.

Defined results: a document without words (null, empty, white space) has the empty
set and is linked with nothing; one word is a set of one; repeated rows are kept as
rows; rows with a null ``doc_id`` link like any other but never name a component
that has a named document, and are kept in one that has none; an empty table gives
an empty result; further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlet.llm.common import stored, text_bytes
from martlet.llm.components import connected_components

N_BANDS, BAND_ROWS = 32, 6
M = N_BANDS * BAND_ROWS
#: Elements that walk at once, to bound memory on long texts.
CHUNK = 4096
#: Words whose hashes a task remembers.
HELD_WORDS = 500_000
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_EMPTY = np.uint64(2**64 - 1)
_R_BITS = np.uint64(40)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits (splitmix64's finish)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= HELD_WORDS:
            self.clear()
        found = self[word] = xxhash.xxh64_intdigest(word)
        return found


def shingle_set(text: str | None, words: _WordHashes) -> np.ndarray:
    """Sorted distinct hashes of the 2-word shingles (one word: of that word)."""
    found = text_bytes(text).lower().split()
    if not found:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(words.__getitem__, found), np.uint64, len(found))
    if len(found) == 1:
        return _mixed(hashes + _GOLDEN)
    return np.unique(_mixed(_mixed(hashes[:-1]) * _GOLDEN + hashes[1:]))


def signature(elements: np.ndarray, m: int = M) -> np.ndarray:
    """The SuperMinHash signature: step and random fraction of every position."""
    least = np.full(m, _EMPTY)
    for at in range(0, len(elements), CHUNK):
        some = elements[at : at + CHUNK]
        n = len(some)
        walk = rows = None
        for step in range(m):
            # Positions that only later steps have reached are still open to this one.
            if int(least.max()) >> int(_R_BITS) < step:
                break
            drawn = _mixed(some + np.uint64((step + 1) * int(_GOLDEN) % 2**64))
            to = step + (((drawn >> _R_BITS) * np.uint64(m - step)) >> np.uint64(24)).astype(np.int64)
            if step == 0:
                place = to
            else:
                if walk is None:  # what step 0 has swapped
                    walk = np.tile(np.arange(m, dtype=np.int16), (n, 1))
                    rows = np.arange(n)
                    walk[rows, first] = 0
                place = walk[rows, to]
                walk[rows, to] = walk[:, step]
            if step == 0:
                first = to
            value = (np.uint64(step) << _R_BITS) | (drawn & np.uint64((1 << 40) - 1))
            np.minimum.at(least, place, value)
    return least


_ROW = "doc_id long, text string, digest binary, n long, bands array<long>"


def documents_with_bands(docs: DataFrame) -> DataFrame:
    """One row a document: its text, the digest of its set and its buckets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _WordHashes()
        band = np.arange(N_BANDS, dtype=np.uint64)[:, None] * _GOLDEN
        for batch in batches:
            digests, sizes, bands = [], [], []
            for text in batch.column(1):
                found = shingle_set(text.as_py(), words)
                values = signature(found)
                digests.append(xxhash.xxh3_128_digest(found))
                sizes.append(len(found))
                held = np.concatenate([band, values.reshape(N_BANDS, BAND_ROWS)], axis=1)
                bands.append([xxhash.xxh64_intdigest(row) for row in held])
            flat = pa.array(np.array(bands, np.uint64).reshape(-1).view(np.int64))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(bands) + 1) * N_BANDS, pa.int32()), flat)
            columns = [batch.column(0), batch.column(1), pa.array(digests, pa.binary()), pa.array(sizes, pa.int64()), lists]
            yield pa.RecordBatch.from_arrays(columns, [f.split()[0] for f in _ROW.split(", ")])

    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    return rows.mapInArrow(run, _ROW)


def bit_map(elements: np.ndarray) -> np.ndarray:
    """One bit an element, in the least power of two of longs with 4 bits for each."""
    longs = 1 << max(0, (len(elements) - 1) // 16).bit_length()
    flags = np.zeros(64 * longs, np.uint8)
    flags[(elements & np.uint64(64 * longs - 1)).astype(np.int64)] = 1
    return np.packbits(flags).view(np.int64)


def full_sets(texts: DataFrame) -> DataFrame:
    """``cid, n, shingles, map``: the sets of ``cid, text`` rows and their bit maps."""

    def lists(arrays: list[np.ndarray]) -> pa.Array:
        ends = np.cumsum([0, *map(len, arrays)])
        flat = pa.array(np.concatenate([np.empty(0, np.int64), *arrays]))
        return pa.LargeListArray.from_arrays(pa.array(ends, pa.int64()), flat).cast(pa.list_(pa.int64()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _WordHashes()
        for batch in batches:
            sets = [shingle_set(text.as_py(), words) for text in batch.column(1)]
            columns = [pa.array([len(s) for s in sets], pa.int64()), lists([s.view(np.int64) for s in sets]), lists([bit_map(s) for s in sets])]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["cid", "n", "shingles", "map"])

    return texts.select("cid", "text").mapInArrow(run, "cid long, n long, shingles array<long>, map array<long>")


def _might_link(x: str, y: str, percent: int) -> Column:
    """Sizes and bit maps allow a link of ``x`` and ``y``: true for every link
    (``percent`` of 50 or more, so that one map is at most twice the other)."""
    a, b, p, q = F.col(f"{x}.n"), F.col(f"{y}.n"), F.col(f"{x}.map"), F.col(f"{y}.map")

    def folded(m: Column) -> Column:
        half = (F.size(m) / 2).cast("int")
        return F.zip_with(F.slice(m, 1, half), F.slice(m, half + 1, half), lambda u, v: u.bitwiseOR(v))

    left = F.when(F.size(p) > F.size(q), folded(p)).otherwise(p)
    right = F.when(F.size(q) > F.size(p), folded(q)).otherwise(q)
    differ = F.aggregate(F.zip_with(left, right, lambda u, v: F.bit_count(u.bitwiseXOR(v))), F.lit(0), lambda s, d: s + d)
    return (100 * F.least(a, b) >= percent * F.greatest(a, b)) & ((100 + percent) * differ <= (100 - percent) * (a + b))


def _links(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` of classes whose full sets are alike enough."""
    left = sets.select(F.col("cid").alias("a"), F.col("shingles").alias("x"))
    right = sets.select(F.col("cid").alias("b"), F.col("shingles").alias("y"))
    both = F.size(F.array_intersect("x", "y"))
    union = F.size("x") + F.size("y") - both
    return pairs.join(right, "b").join(left, "a").where(100 * both >= percent * union).select("a", "b")


def _components(links: DataFrame) -> DataFrame:
    return stored(connected_components(links).select(F.col("node").alias("cid"), "component"), "superminhash-components")


def _links_of_open_buckets(shared: DataFrame, links: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``links`` and those of the buckets that still hold several components."""
    found = _components(links)
    placed = shared.join(found, "cid", "left").withColumn("component", F.coalesce("component", "cid"))
    placed = stored(placed, "superminhash-placed")
    open_ = stored(
        placed.groupBy("bucket").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
        .where("lo < hi").select("bucket"),
        "superminhash-open",
    )
    members = placed.join(open_, "bucket")
    # A pair is tried in the first bucket that both are in, once.
    own = members.groupBy("cid").agg(F.collect_set("bucket").alias("buckets"))
    members = stored(members.join(own, "cid"), "superminhash-members")
    pairs = (
        members.alias("x").join(members.alias("y"), "bucket")
        .where(
            (F.col("x.cid") < F.col("y.cid")) & (F.col("x.component") != F.col("y.component")) & _might_link("x", "y", percent)
            & (F.array_min(F.array_intersect("x.buckets", "y.buckets")) == F.col("bucket"))
        )
        .select(F.col("x.cid").alias("a"), F.col("y.cid").alias("b"))
    )
    return links.unionByName(_links(pairs, sets, percent))


def near_duplicates(docs: DataFrame, percent: int = 80) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` per row of ``docs``."""
    rows = stored(documents_with_bands(docs).withColumn("row", F.monotonically_increasing_id()), "superminhash-rows")
    classes = stored(
        rows.where("n > 0").groupBy("digest").agg(
            F.min("doc_id").alias("named"), F.min("row").alias("row"), F.first("bands").alias("bands")
        ).withColumn("cid", F.monotonically_increasing_id()),
        "superminhash-classes",
    )
    members = classes.select("cid", F.explode("bands").alias("bucket"))
    groups = stored(
        members.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1"), "superminhash-buckets"
    )
    seen = stored(members.join(groups, "bucket").select("bucket", "size", "cid"), "superminhash-seen")
    # What many buckets share is central: the text that copies were made from.
    central = stored(seen.groupBy("cid").agg(F.sum("size").alias("central")), "superminhash-central")
    wanted = classes.join(central, "cid").select("cid", "row")
    sets = stored(full_sets(rows.select("row", "text").join(wanted, "row")), "superminhash-sets")
    maps = sets.select("cid", "n", "map")
    shared = stored(seen.join(central.join(maps, "cid"), "cid"), "superminhash-shared")
    lead = shared.groupBy("bucket").agg(F.max_by("cid", "central").alias("lead"))
    lead = stored(lead.join(maps.withColumnRenamed("cid", "lead"), "lead"), "superminhash-leaders")
    pairs = (
        shared.alias("y").join(lead.alias("x"), "bucket").where((F.col("lead") != F.col("cid")) & _might_link("x", "y", percent))
        .select(F.least("lead", "cid").alias("a"), F.greatest("lead", "cid").alias("b")).distinct()
    )
    links = stored(_links(pairs, sets, percent), "superminhash-links")
    found = _components(_links_of_open_buckets(shared, links, sets, percent))
    named_class = stored(
        classes.join(found, "cid", "left").select("digest", "named", F.coalesce("component", "cid").alias("component")),
        "superminhash-named",
    )
    names = stored(named_class.groupBy("component").agg(F.min("named").alias("component_id")), "superminhash-names")
    by_digest = stored(named_class.join(names, "component").select("digest", "component_id"), "superminhash-digests")
    out = rows.where("n > 0").select("doc_id", "digest", "n").join(by_digest, "digest").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    alone = rows.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return out.unionByName(alone).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
