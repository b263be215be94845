"""Bit maps of fixed size over 64-bit hashes, to leave out early what an exact
join would leave out anyway. A map of any number of hashes takes 2 MB; the more
hashes, the more pass, and the join that follows decides."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAP_BITS = 24


def bit_maps(seeds: DataFrame) -> list[np.ndarray]:
    """Two maps of ``2 ** MAP_BITS`` bits over the ``seed`` column, added up by
    Spark. What comes to the driver is at most ``2 ** MAP_BITS / 64`` longs a map.
    """
    maps = []
    for shift in (0, MAP_BITS):
        bit = F.shiftrightunsigned("seed", shift).bitwiseAND(F.lit((1 << MAP_BITS) - 1))
        words = (
            seeds.select(F.shiftright(bit, 6).alias("at"), F.expr("1L").alias("one"), bit.bitwiseAND(F.lit(63)).cast("int").alias("b"))
            .select("at", F.expr("shiftleft(one, b)").alias("bits"))
            .groupBy("at").agg(F.bit_or("bits").alias("bits")).toArrow()
        )
        found = np.zeros(1 << (MAP_BITS - 6), np.int64)
        found[words.column("at").to_numpy()] = words.column("bits").to_numpy()
        maps.append(found.view(np.uint8))
    return maps


def passes(seeds: np.ndarray, maps: list[np.ndarray]) -> np.ndarray:
    """Positions whose seeds are in both maps."""
    low = np.uint64((1 << MAP_BITS) - 1)

    def bits(of: np.ndarray, bitmap: np.ndarray) -> np.ndarray:
        return (bitmap[of >> np.uint64(3)] >> (of & np.uint64(7)).astype(np.uint8)) & np.uint8(1)

    at = np.flatnonzero(bits(seeds & low, maps[0]))
    return at[bits((seeds[at] >> np.uint64(MAP_BITS)) & low, maps[1]) != 0]


def probably_in(rows: DataFrame, column: str, maps) -> DataFrame:
    """``rows`` without most of those whose (long) ``column`` is not in the
    broadcast ``maps``; none that is gets lost."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = passes(batch.column(column).to_numpy().view(np.uint64), maps.value)
            if len(at):
                yield batch.take(pa.array(at))

    return rows.mapInArrow(run, rows.schema)
