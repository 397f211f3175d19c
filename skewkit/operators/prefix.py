"""Ranks, running totals and order statistics of whole tables, without a window that one task runs.

A global window needs all rows in one task, a window per key all rows of that key. Here the rows are
range-partitioned and written once; each partition's totals (one row per partition and group) are
summed along the partitions, and every partition continues from the sum before it. A hot
group spans as many partitions as its rows fill.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skewkit.functions.expressions import salt_bucket
from skewkit.operators.joins import measure_side
from skewkit.session import materialize, shuffle_partitions

#: Bits of a monotonically increasing id that count rows inside a partition (fixed value).
_ROW_BITS = (1 << 33) - 1


def running_totals(
    df: DataFrame,
    order: Sequence[str],
    sums: Mapping[str, str | Column] | None = None,
    rank: str | None = "rank",
    by: Sequence[str] = (),
    totals: Mapping[str, str] | None = None,
) -> DataFrame:
    """``df`` with its 1-based ``rank`` and inclusive running sums along ``order``, within each group of ``by``.

    ``sums`` maps a new column to what it adds up (NULL adds nothing; use whole numbers or
    decimals, whose sums do not depend on their order). ``totals`` maps a column of ``sums`` to a further one that
    holds the group's whole sum. Columns of ``order`` sort ascending, NULL first, and should tell rows apart: rows
    that tie in all of them follow each other in any order and stay in one partition.

    Two passes: a range exchange on ``by + order``, written once, so a lost executor repeats neither the sort nor
    the placing; then one exchange by partition. The table of partition totals has a row per partition and
    group in it, and is broadcast only after measuring it. An empty input gives an empty result.
    """
    sums = {k: (F.col(c) if isinstance(c, str) else c) for k, c in (sums or {}).items()}
    order = [c for c in order if c not in by]
    names = [f"_s{i}" for i in range(len(sums))]
    placed = materialize(
        df.withColumns({n: F.coalesce(c, F.lit(0)) for n, c in zip(names, sums.values(), strict=True)})
        .repartitionByRange(*by, *order).sortWithinPartitions(*by, *order)
        .withColumn("_p", F.spark_partition_id()).withColumn("_i", F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW_BITS))),
        "range-placed")
    groups = {f"_g{i}": F.col(c) for i, c in enumerate(by)}
    parts = placed.groupBy(F.col("_p").alias("_part"), *[c.alias(g) for g, c in groups.items()]).agg(
        F.count(F.lit(1)).alias("_rows"), *[F.sum(n).alias(f"_t{n}") for n in names])
    whole = Window.partitionBy(*groups)
    before = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    held = ["_rows", *[f"_t{n}" for n in names]]
    offsets = materialize(parts.select(
        "_part", *groups, *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"_before{c}") for c in held],
        *[F.sum(f"_t{names[list(sums).index(s)]}").over(whole).alias(t) for s, t in (totals or {}).items()]), "prefix-sums")
    small = F.broadcast(offsets) if measure_side(offsets).fits else offsets
    same = F.col("_p") == F.col("_part")
    for g, c in groups.items():
        same = same & c.eqNullSafe(F.col(g))
    within = Window.partitionBy("_p", *by).orderBy("_i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = placed.join(small, same).withColumns({
        s: F.sum(n).over(within) + F.col(f"_before_t{n}") for s, n in zip(sums, names, strict=True)})
    if rank:
        out = out.withColumn(rank, F.row_number().over(Window.partitionBy("_p", *by).orderBy("_i")) + F.col("_before_rows"))
    return out.select(*[F.col(f"`{c}`") for c in df.columns], *([rank] if rank else []), *sums, *(totals or {}).values())


def group_percentiles(
    df: DataFrame,
    keys: Sequence[str],
    column: str,
    fractions: Mapping[str, float],
    interpolate: bool = False,
) -> DataFrame:
    """Exact percentiles of ``column`` per group (``keys`` + one column per fraction), hot groups over many tasks.

    Percentiles do not merge from partial results, so a plain aggregate gathers all values of a group in one
    task. Here equal values are counted first (partial aggregation), the counts are added up along (keys,
    value) by :func:`running_totals`, and the values at the wanted places are selected. Without ``interpolate`` a
    percentile is the smallest value with at least that fraction of the rows at or below it (``percentile_disc``), with it
    the two neighbours of ``fraction * (rows - 1)`` are interpolated (``percentile_cont``). NULL values count for nothing;
    a group of NULLs alone has no row.
    """
    if any(not 0 <= f <= 1 for f in fractions.values()):
        raise ValueError("fractions lie between 0 and 1")
    counts = df.where(F.col(column).isNotNull()).groupBy(*keys, column).agg(F.count(F.lit(1)).alias("_n"))
    ranked = running_totals(counts, [column], {"_upto": "_n"}, rank=None, by=keys, totals={"_upto": "_all"})
    after = F.col("_upto") - F.col("_n")

    def at(place: Column) -> Column:
        """The value at a 1-based place."""
        return F.max(F.when((after < place) & (place <= F.col("_upto")), F.col(column)))

    picked, out = [], []
    for i, (name, f) in enumerate(fractions.items()):
        if interpolate:
            h = F.lit(float(f)) * (F.col("_all") - 1)
            picked += [at(F.floor(h) + 1).alias(f"_lo{i}"), at(F.ceil(h) + 1).alias(f"_hi{i}"), F.max(h - F.floor(h)).alias(f"_w{i}")]
            out.append((F.col(f"_lo{i}") + F.col(f"_w{i}") * (F.col(f"_hi{i}") - F.col(f"_lo{i}"))).alias(name))
        else:
            picked.append(at(F.greatest(F.ceil(F.lit(float(f)) * F.col("_all")), F.lit(1))).alias(f"_v{i}"))
            out.append(F.col(f"_v{i}").alias(name))
    return ranked.groupBy(*keys).agg(*picked).select(*keys, *out)


def salted_distinct(df: DataFrame, keys: Sequence[str], columns: Mapping[str, str], n_salts: int | None = None) -> DataFrame:
    """Exact distinct counts per group (``keys`` + one column per entry), hot groups over many tasks.

    ``columns`` maps a result column to the column whose distinct non-NULL values it counts. Distinct counts do not add
    up over any split of the rows, but they do over a split of the values: the salt is a hash of the value. One
    pass: grouping sets reduce the rows to (keys, value) pairs per column, whose partial aggregation takes
    copies before the shuffle; pairs are counted per (keys, salt), salts added up.
    """
    salts = shuffle_partitions(df.sparkSession) if n_salts is None else n_salts
    if salts < 1:
        raise ValueError("n_salts must be >= 1")
    used = list(dict.fromkeys(columns.values()))
    if set(used) & set(keys):
        raise ValueError("a group key has one value per group")
    n = len(used)
    pairs = df.groupingSets([[*keys, c] for c in used], *keys, *used).agg(F.grouping_id().alias("_set"))
    # the last n bits of the grouping id say which of the columns are left out
    which = {c: sum(1 << (n - 1 - j) for j in range(n) if j != i) for i, c in enumerate(used)}
    here = {c: (F.col("_set") == g) & F.col(c).isNotNull() for c, g in which.items()}
    salted = pairs.withColumn("_salt", salt_bucket(salts, *used)).groupBy(*keys, "_salt").agg(
        *[F.sum(here[c].cast("long")).alias(f"_d{i}") for i, c in enumerate(used)])
    return salted.groupBy(*keys).agg(*[F.sum(f"_d{used.index(c)}").alias(a) for a, c in columns.items()])
