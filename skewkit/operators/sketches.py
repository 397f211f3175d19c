"""Bounds from fixed-size sketches, where an exact answer would need a group per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Relative error and confidence of a count-min sketch, and the seed that both sides share.
EPS, CONFIDENCE, SEED = 0.001, 0.999, 11
#: Bytes before the counters of a serialized sketch of depth d: version, total, depth, width, d hash factors (fixed values).
_HEAD = 20


def _number(sketch: Column, at: Column | int, size: int) -> Column:
    """The big-endian number of ``size`` bytes from byte ``at`` (0-based)."""
    start = at if isinstance(at, Column) else F.lit(at)
    return F.conv(F.hex(sketch.substr((start + 1).cast("int"), F.lit(size))), 16, 10).cast("decimal(20,0)")


def _counters(side: DataFrame, key: Column, eps: float, confidence: float, seed: int) -> DataFrame:
    """One row per counter of a side's sketch: place, line (of the sketch), n; and the side's rows with a key."""
    sketch = side.agg(F.count_min_sketch(key, F.lit(eps), F.lit(confidence), F.lit(seed)).alias("s"), F.count(key).alias("rows"))
    depth, width = _number(F.col("s"), 12, 4).cast("int"), _number(F.col("s"), 16, 4).cast("int")
    told = sketch.withColumn("depth", depth).withColumn("width", width)
    at = told.select("s", "depth", "width", "rows", F.explode(F.sequence(F.lit(0), F.col("depth") * F.col("width") - 1)).alias("place"))
    return at.select("place", F.floor(F.col("place") / F.col("width")).alias("line"), "rows",
                     _number(F.col("s"), F.lit(_HEAD) + F.col("depth") * 8 + F.col("place") * 8, 8).alias("n"))


def fanout_bound(left: DataFrame, right: DataFrame, left_key: str, right_key: str | None = None,
                 eps: float = EPS, confidence: float = CONFIDENCE, seed: int = SEED) -> DataFrame:
    """One row: an upper bound of the rows that an inner equi-join gives, without a group per key.

    Both sides are reduced to count-min sketches by the same hash functions: one sketch a
    task crosses the shuffle, whatever the number of keys. A line's inner product counts every matching pair
    and perhaps more, so the least over the lines (``pairs_at_most``) is never below the exact number;
    with probability ``confidence`` it exceeds it by at most ``eps * left_rows * right_rows`` (``error_at_most``).
    Rows with a NULL key match nothing and are left out (``left_rows``, ``right_rows``). Keys are
    compared as strings where the two types differ. Empty sides give 0.
    """
    right_key = right_key or left_key
    same = left.schema[left_key].dataType == right.schema[right_key].dataType
    keys = [F.col(k) if same else F.col(k).cast("string") for k in (left_key, right_key)]
    a = _counters(left, keys[0], eps, confidence, seed).alias("a")
    b = _counters(right, keys[1], eps, confidence, seed).alias("b")
    # counters have at most 19 digits, products at most 38
    product = (F.col("a.n").cast("decimal(19,0)") * F.col("b.n").cast("decimal(19,0)")).cast("decimal(38,0)")
    lines = a.join(b, F.col("a.place") == F.col("b.place")).groupBy(F.col("a.line").alias("line")).agg(
        F.sum(product).cast("decimal(38,0)").alias("pairs"), F.max("a.rows").alias("left_rows"), F.max("b.rows").alias("right_rows"))
    return lines.agg(
        F.min("pairs").alias("pairs_at_most"), F.max("left_rows").alias("left_rows"), F.max("right_rows").alias("right_rows")
    ).withColumn("error_at_most", F.lit(eps) * F.col("left_rows") * F.col("right_rows"))
