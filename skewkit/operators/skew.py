"""Joins that Spark itself splits, and hot keys found without a row per key."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skewkit.operators.joins import PARTS_PER_TASK, salted_join
from skewkit.session import materialize, shuffle_partitions

#: Join types of which AQE can split at least the left side.
_SPLIT_HOWS = {"inner", "left", "right"}

#: The frequent-items summary keeps this many counters per share of one key. Its error is at most
#: 3.5 / (counters / 0.75) of the rows, and it reports what exceeds the error twice, so with 6 counters
#: per share every key above 7/8 of the share is reported.
COUNTERS_PER_SHARE = 6
#: The largest summary that the aggregate takes (fixed value).
MOST_COUNTERS = 1_000_000


def splits_skew(spark) -> bool:
    """Whether the session lets AQE split skewed join partitions (read only)."""
    return all(str(spark.conf.get(k, "true")).lower() == "true"
               for k in ("spark.sql.adaptive.enabled", "spark.sql.adaptive.skewJoin.enabled"))


def skew_split_join(left: DataFrame, right: DataFrame, on: str | Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join of two sides past the broadcast bound, whose skewed partitions AQE splits at run time.

    AQE splits a partition of a sort-merge join by the map outputs it consists of and reads the other side's
    once per part, so nothing is counted beforehand and no side is replicated where no partition is too
    large. It refuses where a later operator relies on the join's partitioning by key, since that would then
    cost a further exchange. So the key leaves this join as ``greatest(left, right)``, which equals it for the
    join types offered but carries no partitioning: a following ``groupBy`` exchanges its partial rows
    instead of pinning a hot key to one task.

    When a partition counts as skewed is the session's choice (see ``plans.settings.scale_settings``). A session that
    has switched AQE or its skew rule off gets :func:`salted_join` for one key (inner, left), else an error.
    NULL keys match nothing; under a left join they are a skewed partition like any other.
    """
    keys = [on] if isinstance(on, str) else list(on)
    if how not in _SPLIT_HOWS:
        raise ValueError(f"skew_split_join supports {sorted(_SPLIT_HOWS)}, not {how!r}")
    for side, df in (("left", left), ("right", right)):
        missing = [k for k in keys if k not in df.columns]
        if missing:
            raise ValueError(f"join key(s) {missing} not found on the {side} side; it has {df.columns}")
    if not splits_skew(left.sparkSession):
        if len(keys) == 1 and how != "right":
            return salted_join(left, right, keys[0], how, broadcast_max_rows=0)
        raise ValueError("AQE's skew handling is off in this session")
    other = right.withColumnsRenamed({k: f"_right_{i}" for i, k in enumerate(keys)})
    matches = [F.col(k) == F.col(f"_right_{i}") for i, k in enumerate(keys)]
    joined = left.join(other.hint("merge"), matches, how)
    out = {k: F.greatest(F.col(k), F.col(f"_right_{i}")) for i, k in enumerate(keys)}
    rest = [c for c in [*left.columns, *right.columns] if c not in keys]
    return joined.select(*[c.alias(k) for k, c in out.items()], *[F.col(f"`{c}`") for c in rest])


def frequent_keys(df: DataFrame, key: str, share: float) -> DataFrame:
    """A superset of the keys above ``share`` of the rows (``key``), from a mergeable summary of bounded size.

    Every task keeps frequent-item counters (the Misra-Gries family) and sends its one summary; the
    summaries merge into one. What crosses the shuffle depends on ``share`` and the number of tasks,
    never on the number of keys. NULL is a key like any other.
    """
    if not 0 < share <= 1:
        raise ValueError("share must be above 0 and at most 1")
    counters = math.ceil(COUNTERS_PER_SHARE / share)
    if counters > MOST_COUNTERS:
        raise ValueError(f"a share below {COUNTERS_PER_SHARE / MOST_COUNTERS} needs more than {MOST_COUNTERS} counters")
    found = df.agg(F.expr(f"approx_top_k_estimate(approx_top_k_accumulate(`{key}`, {counters}), {counters})").alias("items"))
    return found.select(F.explode("items").alias("item")).select(F.col("item.item").alias(key))


def heavy_hitters(df: DataFrame, key: str, share: float, alias: str = "n_rows") -> DataFrame:
    """Exactly the keys with more than ``share`` of all rows, and their exact counts (``key, alias, share``).

    The candidates of :func:`frequent_keys` are complete by the summary's error bound; a second scan counts
    them alone, behind a broadcast of at most ``COUNTERS_PER_SHARE / share`` keys, so its shuffle
    holds that many rows a task at most. An empty input gives no rows.
    """
    candidates = materialize(frequent_keys(df.select(key), key, share), "frequent-keys").withColumnRenamed(key, "_candidate")
    counted = df.select(key).join(F.broadcast(candidates), F.col(key).eqNullSafe(F.col("_candidate")), "left_semi")
    total = df.agg(F.count(F.lit(1))).scalar()
    return (counted.groupBy(key).agg(F.count(F.lit(1)).alias(alias))
            .withColumn("share", F.col(alias) / total).where(F.col("share") > F.lit(float(share))))


def bounded_hot_keys(big: DataFrame, key: str, target_tasks: int | None = None) -> DataFrame:
    """Keys with more rows than a part, and their salts (``key, _n_salts``), for ``salted_join(hot=...)``.

    As ``joins.hot_keys`` with the parts of a mean task, but from :func:`heavy_hitters`: two scans of the key column
    and no shuffle of a row per key. A part is ``1 / target_tasks`` of the rows, by default of
    ``PARTS_PER_TASK`` times the session's shuffle partitions.
    """
    parts = target_tasks or PARTS_PER_TASK * shuffle_partitions(big.sparkSession)
    heavy = heavy_hitters(big, key, 1 / parts, "_rows")
    return heavy.select(key, F.ceil(F.col("share") * parts).cast("int").alias("_n_salts"))
