"""Grouped aggregates: plain, salted two-stage, and NULL-key relabelling.

Spark already runs every mergeable aggregate in two phases (partial per map
task, final after the exchange), so a hot group key sends at most one
partial row per map task through the shuffle. ``salted_aggregate`` adds a
second exchange that spreads one hot key's *final* merge over ``n_salts``
tasks; it pays off when the per-task partial rows of a hot key are still
many (very many map tasks) or when a partial state is large.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import partial as bind

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skewkit.functions.expressions import cents, cents_to_money, money_sum, salt_bucket
from skewkit.session import materialize, shuffle_partitions

#: Groups of one task where there are many, and how many times as many a task of the session's own partitions may hold.
GROUPS_PER_TASK, GROUPS_SLACK = 1 << 18, 8

_FUNCS = {"sum", "count", "min", "max", "avg", "money"}


@dataclass(frozen=True)
class Agg:
    """One aggregate: ``fn`` over ``column`` named ``alias``.

    ``fn``: sum, count (``column="*"`` counts rows), min, max, avg, or money
    (exact sum in whole cents, returned as DOUBLE).
    """

    fn: str
    column: str
    alias: str

    def __post_init__(self):
        if self.fn not in _FUNCS:
            raise ValueError(f"unsupported aggregate {self.fn!r}; use one of {sorted(_FUNCS)}")


def _c(name: str) -> Column:
    return F.lit(1) if name == "*" else F.col(name)


def _direct(a: Agg) -> Column:
    c = _c(a.column)
    if a.fn == "money":
        return money_sum(c).alias(a.alias)
    if a.fn == "count":
        return F.count(c).alias(a.alias)
    return getattr(F, a.fn)(c).alias(a.alias)


def group_aggregate(df: DataFrame, keys: Sequence[str | Column], aggs: Sequence[Agg]) -> DataFrame:
    """``groupBy(keys).agg(...)`` (partial + final hash aggregate)."""
    return df.groupBy(*keys).agg(*[_direct(a) for a in aggs])


def salted_aggregate(
    df: DataFrame,
    keys: Sequence[str],
    aggs: Sequence[Agg],
    n_salts: int | None = None,
    salt_cols: Sequence[str] | None = None,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Same rows as :func:`group_aggregate`, computed in two grouped stages.

    Stage 1 groups by ``keys + salt`` (salt = repeatable hash of the row in
    ``0..n-1``, kept in its own column so keys are never rewritten); stage 2
    merges the partials by ``keys``. Only mergeable aggregates are accepted;
    avg is carried as sum and count.

    Without ``hot`` every group is split ``n_salts`` ways (default: the session's
    shuffle partitions). With ``hot``
    (``keys`` + ``_n_salts``, e.g. from :func:`hot_groups`; small by
    construction, broadcast after measuring) only those groups are split, each by its own
    count, and every other group keeps a single partial row, so stage 1 does
    not multiply the rows of a high-cardinality key.
    """
    n_salts = shuffle_partitions(df.sparkSession) if n_salts is None else n_salts
    if n_salts < 1:
        raise ValueError("n_salts must be >= 1")
    cols = list(salt_cols) if salt_cols else list(df.columns)
    if hot is None:
        n: Column = F.lit(n_salts)
        src = df
    else:
        h = hot.select(*[F.col(k).alias(f"_hot_{i}") for i, k in enumerate(keys)], "_n_salts")
        cond = [F.col(k).eqNullSafe(F.col(f"_hot_{i}")) for i, k in enumerate(keys)]
        from skewkit.operators.joins import measure_side

        h = F.broadcast(h) if measure_side(h).fits else h
        src = df.join(h, cond, "left").drop(*[f"_hot_{i}" for i in range(len(keys))])
        n = F.coalesce(F.col("_n_salts"), F.lit(1))
    salted = src.withColumn("_salt", salt_bucket(n, *[F.col(f"`{c}`") for c in cols]))
    if hot is not None:
        salted = salted.drop("_n_salts")
    partial, final = _partial_final(aggs)
    stage1 = salted.groupBy(*keys, "_salt").agg(*partial)
    return stage1.groupBy(*keys).agg(*final)


def hot_groups(df: DataFrame, keys: Sequence[str], rows_per_salt: int | None = None) -> DataFrame:
    """Groups of ``df`` larger than ``rows_per_salt`` rows: ``keys + _n_salts``.

    By default a part holds the rows of a mean task. The counts are written once
    to the shared folder; every group above the limit is returned.
    """
    counts = materialize(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")), "group-counts")
    if rows_per_salt is None:
        limit = F.ceil(counts.agg(F.sum("_rows")).scalar() / F.lit(shuffle_partitions(df.sparkSession)))
    else:
        limit = F.lit(int(rows_per_salt))
    limit = F.greatest(limit, F.lit(1))
    return counts.where(F.col("_rows") > limit).select(
        *keys, F.ceil(F.col("_rows") / limit).cast("int").alias("_n_salts"))


def _merged(fn: str, column: str) -> Column:
    return getattr(F, fn)(column)


def _partial_final(aggs: Sequence[Agg], merge: Callable[[str, str], Column] = _merged) -> tuple[list[Column], list[Column]]:
    """Mergeable partial states of ``aggs`` and the expressions that merge them (``merge``: function, column of the states)."""
    partial: list[Column] = []
    final: list[Column] = []
    for i, a in enumerate(aggs):
        c = _c(a.column)
        p = f"_p{i}"
        if a.fn == "money":
            partial.append(F.sum(cents(c)).alias(p))
            final.append(cents_to_money(merge("sum", p)).alias(a.alias))
        elif a.fn == "sum":
            partial.append(F.sum(c).alias(p))
            final.append(merge("sum", p).alias(a.alias))
        elif a.fn == "count":
            partial.append(F.count(c).alias(p))
            final.append(merge("sum", p).cast("long").alias(a.alias))
        elif a.fn in ("min", "max"):
            partial.append(getattr(F, a.fn)(c).alias(p))
            final.append(merge(a.fn, p).alias(a.alias))
        else:  # avg
            partial.append(F.sum(c).alias(p + "s"))
            partial.append(F.count(c).alias(p + "n"))
            final.append((merge("sum", p + "s") / merge("sum", p + "n")).cast("double").alias(a.alias))
    return partial, final


def group_parts(df: DataFrame, keys: Sequence[str]) -> int:
    """Partitions of ``GROUPS_PER_TASK`` groups of ``df``, or 0 where the session's partitions do (from one aggregate job).

    Where a partial aggregate leaves most rows, AQE may merge the session's
    partitions to few, so these are not counted on.
    """
    row = df.agg(F.count(F.lit(1)).alias("rows"), F.approx_count_distinct(F.xxhash64(*keys)).alias("groups")).first()
    parts = math.ceil(row["groups"] / GROUPS_PER_TASK)
    tasks = 1 if row["rows"] < 2 * row["groups"] else shuffle_partitions(df.sparkSession)
    return parts if parts > GROUPS_SLACK * tasks else 0


def aggregate_before_join(
    fact: DataFrame,
    dim: DataFrame,
    key: str,
    fact_keys: Sequence[str],
    dim_keys: Sequence[str],
    aggs: Sequence[Agg],
    join: Callable[[DataFrame, DataFrame, str], DataFrame] | None = None,
) -> DataFrame:
    """``fact ⋈ dim`` on ``key``, grouped by ``key + dim_keys + fact_keys``, aggregating first.

    The fact is reduced to mergeable partial states per ``(key, fact_keys)``
    before the join, so the join reads one row per group instead of one per
    fact row; the partial states are merged after the join. The result equals
    join-then-aggregate, also when ``dim`` repeats a key (each partial row
    then joins every copy, as each fact row would). The merge needs no
    further shuffle: its input is already hash-partitioned on a subset of
    its group keys (by the first aggregate, or by the join's exchange).
    ``join`` defaults to the size-checked :func:`broadcast_join`.

    Groups too many for the session's shuffle partitions (:func:`group_parts`) get
    partitions of their own number, so a task's memory does not grow with the
    input. The rows are then dealt out by their group before the aggregate, as a partial
    one would hold nearly every row of a map task; and the states are merged
    after the join only if ``dim`` repeats a row, else each is final already.
    """
    from skewkit.operators.joins import broadcast_join

    partial, final = _partial_final(aggs)
    parts = group_parts(fact, [key, *fact_keys])
    if parts:
        needed = dict.fromkeys([key, *fact_keys, *(a.column for a in aggs if a.column != "*")])
        fact = fact.select(*needed).repartition(parts, key, *fact_keys)
        join = join or bind(broadcast_join, parts=parts)
    reduced = fact.groupBy(key, *fact_keys).agg(*partial)
    joined = (join or broadcast_join)(reduced, dim.select(key, *dim_keys), key)
    keys = [key, *dim_keys, *fact_keys]
    if not parts:
        return joined.groupBy(*keys).agg(*final)
    repeats = dim.groupBy(key, *dim_keys).agg(F.count(F.lit(1)).alias("_copies")).where("_copies > 1")
    if not repeats.isEmpty():
        return joined.repartition(parts, key, *fact_keys).groupBy(*keys).agg(*final)

    def alone(fn: str, column: str) -> Column:  # a single state, in the type that its merge would have
        return F.col(column).cast(joined.agg(getattr(F, fn)(column).alias(column)).schema[column].dataType)

    return joined.select(*keys, *_partial_final(aggs, alone)[1])


def label_nulls(df: DataFrame, labels: dict[str, str]) -> DataFrame:
    """Replace NULLs in the given string columns by a label (``fillna``).

    Relabelling does not remove rows: a NULL key already forms its own group
    in ``groupBy``; this only names it.
    """
    return df.fillna(labels)


def count_by(df: DataFrame, key: str, counted: str, alias: str, null_label: str | None = None) -> DataFrame:
    """Count non-NULL ``counted`` per ``key``; NULL keys optionally relabelled."""
    src = label_nulls(df, {key: null_label}) if null_label is not None else df
    return src.groupBy(key).agg(F.count(F.col(counted)).alias(alias))


def grouping_set_summaries(
    df: DataFrame,
    analyses: Sequence[tuple[str, Sequence[str], Sequence[Agg]]],
    columns: Mapping[str, str],
) -> DataFrame:
    """Several group-bys over one input in one pass, as one tagged table.

    ``analyses`` are ``(tag, keys, aggs)``. A single ``GROUPING SETS``
    aggregate scans ``df`` once: each row is expanded once per set before the
    partial aggregation, so the shuffle carries partial rows of every set and
    nothing is cached. ``grouping_id()`` tells the sets apart (also from
    NULLs in the data). Output: ``analysis`` plus ``columns`` (name → SQL
    type); a column an analysis does not produce is NULL in its rows.
    """
    keys_per_set = [tuple(k) for _, k, _ in analyses]
    if len(set(keys_per_set)) != len(keys_per_set):
        raise ValueError("two analyses group by the same keys; merge their aggregates")
    all_keys: list[str] = []
    for ks in keys_per_set:
        all_keys += [k for k in ks if k not in all_keys]
    aggs: dict[str, Agg] = {}
    for _, _, agg_list in analyses:
        for a in agg_list:
            if a.alias in aggs and aggs[a.alias] != a:
                raise ValueError(f"aggregate alias {a.alias!r} used for two different aggregates")
            aggs[a.alias] = a
    n = len(all_keys)
    gid = {tag: sum(1 << (n - 1 - i) for i, c in enumerate(all_keys) if c not in ks)
           for tag, ks, _ in analyses}
    grouped = df.groupingSets([list(ks) for ks in keys_per_set], *all_keys).agg(
        *[_direct(a) for a in aggs.values()], F.grouping_id().alias("_gid"))
    tag_col = None
    for tag, g in gid.items():
        tag_col = (F.when(F.col("_gid") == g, F.lit(tag)) if tag_col is None
                   else tag_col.when(F.col("_gid") == g, F.lit(tag)))
    out = [tag_col.alias("analysis")]
    for name, dtype in columns.items():
        owners = [tag for tag, ks, agg_list in analyses if name in ks or name in {a.alias for a in agg_list}]
        if owners and name in df.columns + list(aggs):
            keep = F.col("_gid").isin([gid[t] for t in owners])
            out.append(F.when(keep, F.col(name)).cast(dtype).alias(name))
        else:
            out.append(F.lit(None).cast(dtype).alias(name))
    return grouped.select(*out)
