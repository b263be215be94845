"""Operator 9: mixing sources to target weights by pivotal dependent rounding.

Targets: sources in code point order (null last) weigh ``weights`` in turn; they
share ``budget`` times the size of everything by weight, no source takes more
than ``max_copies`` times its own size, and the excess is shared again by
weight until no source is above its limit.

Copies: every document of a source should be taken ``target / source_size``
times. The whole part is taken as it is; the fractional part is rounded by
pairs: two documents exchange mass, weighted by their sizes, until one of them
is integral, in a random direction whose odds keep every expectation. The words
taken by the pair do not change, so a tree ends within the size of the one
document left over. Documents that hold over 10%, then over 1% of their source
are rounded first, each tier in a tree of its own; what such a tree takes too
much or too little changes the rate of the tiers after it, so the smaller
documents make up for the larger.

The pairs form a reduction tree. Documents are dealt by hash into blocks of
about ``BLOCK`` rows a (source, block) - a source of any size is many blocks -
and each block is folded by a SQL ``aggregate``; the one document it leaves
fractional goes to the next level, until every source is one block, whose last
document is rounded by a draw. Randomness is a hash of the row - of its id, source,
size and its number among rows equal in these - and the level, so reruns agree and
rows that repeat an id are dealt out like any others.

Built from DataFrame functions only. Defined results: null and empty texts have
size 0 and take nothing; a null source is a source of its own; repeated rows are
rows of their own (they may be rounded differently); null ids are carried; a
source without words has target 0; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from martlet.llm.common import WORD_PATTERN, checkpointed, stored

BLOCK = 64
#: A source with more than this part of all rows is joined by broadcast.
HOT = 1000
#: Shares of a source above which documents are rounded before the others.
TIERS = (0.1, 0.01)
EPSILON = 1e-9


def sized(docs: DataFrame, row: Column | None = None) -> DataFrame:
    """``row, doc_id, source, size``: a number of the row and the word count of the
    whole text."""
    words = F.regexp_count(docs["text"].cast("string"), F.lit(WORD_PATTERN)).cast("long")
    return docs.select(
        (F.monotonically_increasing_id() if row is None else row).alias("row"),
        docs["doc_id"].cast("long").alias("doc_id"), docs["source"].cast("string").alias("source"),
        F.coalesce(words, F.lit(0).cast("long")).alias("size"),
    )


def with_draws(sizes: DataFrame) -> DataFrame:
    """Adds ``draw``, the hash that all of a row's randomness comes from.

    Equal rows are numbered, so each has a draw of its own, and the draws of all of
    them do not depend on how the table is dealt out. They are numbered within the
    parts the table was read in, and parts by the rows before them, so no task holds
    all rows of an id. Rows without an id count as equal where size and source are.
    """
    part = F.shiftright("row", 33).alias("part")  # of a monotonically increasing id
    equal = ["doc_id", "source", "size"]
    rows = sizes.withColumn("part", part)
    within = F.row_number().over(Window.partitionBy(*equal, "part").orderBy("row"))
    counts = rows.groupBy(*equal, "part").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy(*equal).orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.withColumn("before", before).where("before IS NOT NULL").drop("n")
    o, on = offsets.alias("o"), F.col("r.part") == F.col("o.part")
    for c in equal:
        on = on & F.col(f"r.{c}").eqNullSafe(F.col(f"o.{c}"))
    placed = rows.withColumn("place", within).alias("r").join(o, on, "left")
    nth = F.col("place") + F.coalesce("before", F.lit(0))
    # A null is part of the hash by its own flag.
    name = [F.col("r.doc_id").isNull(), F.col("r.doc_id"), F.col("r.source").isNull(), F.col("r.source"), F.col("r.size"), nth]
    return placed.select("r.row", "r.doc_id", "r.source", "r.size", F.xxhash64(*name).alias("draw"))


def _ranked(sources: DataFrame) -> DataFrame:
    """Adds ``rank``, from 0, in code point order with null last.

    The catalogue is dealt by range and counted range by range, so no task has
    to hold all sources.
    """
    order = [F.col("source").isNull(), F.col("source")]
    ranged = checkpointed(
        sources.withColumn("__null", F.col("source").isNull()).repartitionByRange("__null", "source")
        .withColumn("range", F.spark_partition_id())
    )
    before = (
        ranged.groupBy("range").agg(F.count("*").alias("n"))
        .withColumn("before", F.sum("n").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)))
        .select("range", F.coalesce("before", F.lit(0)).alias("before"))
    )
    place = F.row_number().over(Window.partitionBy("range").orderBy(*order)) - 1
    return ranged.join(before, "range").withColumn("rank", F.col("before") + place).drop("range", "before", "__null")


def source_targets(sizes: DataFrame, weights: Sequence[float], budget: float, max_copies: float) -> DataFrame:
    """``source, source_size, n_docs, target, hot`` of every source; ``hot`` ones
    hold more than a share of ``1 / HOT`` of all rows, so they are fewer than ``HOT``.

    Each round fixes the sources whose share reaches their limit; only two sums
    come to the driver. A round without a new one ends it.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    ranked = checkpointed(_ranked(totals).withColumn("weight", weight).withColumn("limit", max_copies * F.col("source_size")))
    everything, documents = (x or 0 for x in ranked.agg(F.sum("source_size"), F.sum("n_docs")).first())
    level = 0.0  # target of an unlimited source per unit of weight
    while everything:
        full = F.col("limit") <= level * F.col("weight")
        row = ranked.agg(
            F.sum(F.when(full, F.col("limit")).otherwise(0.0)), F.sum(F.when(full, 0.0).otherwise(F.col("weight")))
        ).first()
        new = (budget * everything - row[0]) / row[1] if row[1] else level
        if new <= level * (1 + 1e-12):
            break
        level = new
    target = F.least(F.col("limit"), F.lit(level) * F.col("weight")).alias("target")
    return ranked.select("source", "source_size", "n_docs", target, (F.col("n_docs") * HOT > F.lit(documents)).alias("hot"))


def _unit(*parts: Column) -> Column:
    """A draw from [0, 1) by hash."""
    return F.pmod(F.xxhash64(*parts), F.lit(1 << 52)) / F.lit(float(1 << 52))


def _fold(items: Column, level: int) -> Column:
    """``struct(done, held)``: settled documents, and the one still fractional.

    Every item is ``(size, row, p, draw)``; the fold holds one fractional item
    and pairs it with the next.
    """
    item = "struct<size:bigint,row:bigint,p:double,draw:bigint>"
    start = F.struct(F.array().cast(f"array<{item}>").alias("done"), F.lit(None).cast(item).alias("held"))

    def with_p(x: Column, p: Column) -> Column:
        return F.struct(x["size"].alias("size"), x["row"].alias("row"), p.alias("p"), x["draw"].alias("draw"))

    def step(acc: Column, x: Column) -> Column:
        held = acc["held"]
        ratio = x["size"] / held["size"]
        up = F.least(1 - held["p"], x["p"] * ratio)  # what the held one may gain
        down = F.least(held["p"], (1 - x["p"]) * ratio)  # and lose
        gains = _unit(held["draw"], x["draw"], F.lit(level)) * (up + down) < down
        move = F.when(gains, up).otherwise(-down)

        def snapped(p: Column) -> Column:
            return F.when(p < EPSILON, 0.0).when(p > 1 - EPSILON, 1.0).otherwise(p)

        a, b = with_p(held, snapped(held["p"] + move)), with_p(x, snapped(x["p"] - move / ratio))
        a_done, b_done = a["p"].isin(0.0, 1.0), b["p"].isin(0.0, 1.0)
        none = F.lit(None).cast(item)
        paired = (
            F.when(a_done & b_done, F.struct(F.concat(acc["done"], F.array(a, b)).alias("done"), none.alias("held")))
            .when(a_done, F.struct(F.concat(acc["done"], F.array(a)).alias("done"), b.alias("held")))
            .otherwise(F.struct(F.concat(acc["done"], F.array(b)).alias("done"), a.alias("held")))
        )
        settled = F.struct(F.concat(acc["done"], F.array(x)).alias("done"), held.alias("held"))
        first = F.struct(acc["done"].alias("done"), x.alias("held"))
        return F.when(x["p"].isin(0.0, 1.0), settled).when(held.isNull(), first).otherwise(paired)

    return F.aggregate(items, start, step)


def rounded(fractions: DataFrame, largest: int) -> DataFrame:
    """``source, row, size, p`` with every ``p`` 0 or 1.

    ``fractions``: ``source, row, size, draw, p, n`` where ``n`` is the number
    of rows of the source and ``largest`` the greatest of them.
    """
    levels = 1
    while BLOCK**levels < largest:
        levels += 1
    rows, settled = fractions, []
    for level in range(levels):
        blocks = F.ceil(F.col("n") / F.lit(float(BLOCK ** (level + 1))))
        block = F.pmod(F.xxhash64("draw", F.lit(level)), F.greatest(blocks, F.lit(1)))
        if level == levels - 1:
            block = F.lit(0).cast("long")  # the root: one block a source
        items = F.sort_array(F.collect_list(F.struct("size", "draw", "p", "row")), asc=False)
        items = F.transform(items, lambda x: F.struct(x["size"].alias("size"), x["row"].alias("row"), x["p"].alias("p"), x["draw"].alias("draw")))
        folded = checkpointed(
            rows.groupBy("source", "n", block.alias("block")).agg(items.alias("items"))
            .select("source", "n", _fold(F.col("items"), level).alias("f")).select("source", "n", "f.done", "f.held")
        )
        settled.append(folded.select("source", F.explode("done").alias("x")).select("source", "x.*"))
        rows = folded.where("held is not null").select("source", "n", "held.*")
    last = rows.withColumn("p", F.when(_unit(F.col("draw"), F.lit("last")) < F.col("p"), 1.0).otherwise(0.0))
    out = last.select("source", "size", "row", "p", "draw")
    for part in settled:
        out = out.unionByName(part)
    return out.drop("draw")


def _with_targets(rows: DataFrame, targets: DataFrame, hot: DataFrame) -> DataFrame:
    """``rows`` with their source's columns (null is a source like any other).

    The rows of ``hot`` sources, fewer than ``HOT``, meet a broadcast; no other
    source holds enough rows to be a hot key.
    """
    named = targets.withColumnRenamed("source", "__source")
    keys = F.broadcast(hot.withColumnRenamed("source", "__hot"))
    on = F.col("source").eqNullSafe(F.col("__source"))
    is_hot = F.col("source").eqNullSafe(F.col("__hot"))
    few = named.join(keys, F.col("__source").eqNullSafe(F.col("__hot")), "left_semi")
    others = named.join(keys, F.col("__source").eqNullSafe(F.col("__hot")), "left_anti")
    much = rows.join(F.broadcast(few), on)
    return much.unionByName(rows.join(keys, is_hot, "left_anti").join(others, on)).drop("__source")


def _of_source(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """Joins two tables of a row (or a few) a source."""
    named = sources.withColumnRenamed("source", "__source")
    return rows.join(named, F.col("source").eqNullSafe(F.col("__source")), "left").drop("__source")


def copies_of(sizes: DataFrame, weights: Sequence[float], budget: float, max_copies: float) -> DataFrame:
    """``row, size, source_size, target, copies, source`` of ``sizes`` (:func:`sized`)."""
    targets = checkpointed(source_targets(sizes, weights, budget, max_copies))
    hot = checkpointed(targets.where("hot").select("source"))
    share = F.when(F.col("source_size") > 0, F.col("size") / F.col("source_size")).otherwise(0.0)
    tier = sum((share <= bound).cast("int") for bound in TIERS)
    rows = checkpointed(
        _with_targets(with_draws(sizes), targets.select("source", "source_size"), hot)
        .select("row", "source", "size", "draw", tier.alias("tier"))
    )
    plan = checkpointed(
        rows.groupBy("source", "tier").agg(F.sum("size").alias("tier_size"), F.count("*").alias("n"))
    )
    left = targets.select("source", F.col("target").alias("target_left"), F.col("source_size").alias("size_left"))
    out = None
    for number in range(len(TIERS) + 1):
        here = plan.where(F.col("tier") == number)
        rate = F.when(F.col("size_left") > 0, F.least(F.lit(float(max_copies)), F.greatest(F.lit(0.0), F.col("target_left") / F.col("size_left")))).otherwise(0.0)
        rates = checkpointed(_of_source(here, left.withColumn("rate", rate)).select("source", "n", "rate"))
        largest = rates.agg(F.max("n")).first()[0]
        if largest is None:
            continue
        fraction = F.when(F.col("size") > 0, F.col("rate") - F.floor("rate")).otherwise(0.0)
        own = rows.where(F.col("tier") == number).select("source", "row", "size", "draw")
        fractions = _with_targets(own, rates, hot).select("source", "row", "size", "draw", "n", fraction.alias("p"))
        copies = (F.floor("rate") + F.col("p")).cast("long")
        done = _with_targets(rounded(fractions, largest), rates, hot).select("source", "row", "size", copies.alias("copies"))
        took = done.groupBy("source").agg(F.sum(F.col("copies") * F.col("size")).alias("took"), F.sum("size").alias("gone"))
        left = checkpointed(
            _of_source(left, took).select(
                "source", (F.col("target_left") - F.coalesce("took", F.lit(0))).alias("target_left"),
                (F.col("size_left") - F.coalesce("gone", F.lit(0))).alias("size_left"),
            )
        )
        out = done if out is None else out.unionByName(done)
    if out is None:  # an empty table
        out = rows.select("source", "row", "size", F.lit(0).cast("long").alias("copies"))
    return _with_targets(out, targets.select("source", "source_size", "target"), hot)


def mix(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), budget: float = 1.5, max_copies: float = 2.0) -> DataFrame:
    """``doc_id, size, source_size, target, taken, source, copies`` per document."""
    sizes = checkpointed(sized(docs))
    taken = copies_of(sizes, weights, budget, max_copies).withColumn("taken", F.col("copies") * F.col("size"))
    return sizes.select("row", "doc_id").join(taken, "row").select(
        "doc_id", "size", "source_size", "target", "taken", "source", "copies"
    )


def mixed_corpus(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), budget: float = 1.5, max_copies: float = 2.0) -> DataFrame:
    """The documents with how often the mix takes them: all columns of ``docs`` and
    ``size, source_size, target, taken, copies`` (in the place of columns so named).
    Documents taken no times have ``copies`` 0; a reader repeats the others."""
    whole = F.struct(*[docs[c] for c in docs.columns]).alias("whole")
    rows = stored(docs.select(F.monotonically_increasing_id().alias("row"), whole), "mixing-rows")
    sizes = checkpointed(sized(rows.select("row", "whole.doc_id", "whole.source", "whole.text"), F.col("row")))
    added = copies_of(sizes, weights, budget, max_copies).select(
        "row", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies"
    )
    kept = [F.col("whole")[c].alias(c) for c in docs.columns if c not in added.columns or c == "row"]
    return rows.join(added, "row").select(*kept, *[c for c in added.columns if c != "row"])
