"""Joins: shuffled, size-checked broadcast, salted, left outer, guarded cross,
and the fan-out estimate that says which one a pair of tables needs.

Broadcast is only ever requested behind a measured bound on the small side
(``measure_side``); beyond the bound the join is left to the planner, where a
sort-merge join runs and AQE may still convert it or split skewed partitions.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skewkit.functions.expressions import row_bytes, salt_bucket
from skewkit.session import advisory_partition_bytes, materialize, shuffle_partitions

# Defaults for the broadcast bound. A broadcast side is collected to the
# driver and copied to every executor, so the bound is about driver and
# executor memory, not about the fact table.
BROADCAST_MAX_ROWS = 2_000_000
BROADCAST_MAX_BYTES = 64 * 1024 * 1024

_SALTED_HOWS = {"inner", "left", "leftouter", "left_outer"}
_BROADCAST_HOWS = {"inner", "left", "leftouter", "left_outer", "semi", "leftsemi", "left_semi",
                   "anti", "leftanti", "left_anti", "cross"}


@dataclass(frozen=True)
class SideSize:
    """Exact rows and payload bytes of a join side, against the broadcast bound."""

    rows: int
    bytes: int
    max_rows: int
    max_bytes: int

    @property
    def fits(self) -> bool:
        return self.rows <= self.max_rows and self.bytes <= self.max_bytes


def measure_side(
    df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS, max_bytes: int = BROADCAST_MAX_BYTES
) -> SideSize:
    """Exact size of ``df`` (rows and payload bytes) from one aggregate job.

    Partial aggregation sends one row per partition through the shuffle, so
    even a side that turns out large is measured by a distributed scan and
    never funnelled into one task (a ``limit`` probe would shuffle up to
    ``max_rows`` rows of every partition into a single one).
    """
    width = row_bytes(df.schema)
    row = df.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(width), F.lit(0)).alias("b")).first()
    return SideSize(int(row["n"]), int(row["b"]), max_rows, max_bytes)


# The three-tier broadcast rule (always below 10 MB, worth
# considering below 200 MB, otherwise left to the planner and AQE).
BROADCAST_ALWAYS_BYTES = 10 * 1024 * 1024
BROADCAST_CONSIDER_BYTES = 200 * 1024 * 1024


def join_strategy(
    small: DataFrame,
    always_bytes: int = BROADCAST_ALWAYS_BYTES,
    consider_bytes: int = BROADCAST_CONSIDER_BYTES,
    max_rows: int = BROADCAST_MAX_ROWS,
) -> tuple[str, SideSize]:
    """``"broadcast"``, ``"consider"`` or ``"planner"`` for ``small`` from its measured size.

    ``consider`` means a broadcast is safe for memory but should be weighed
    against the executors' memory and the number of joins sharing it; pass
    such a side to :func:`broadcast_join` with ``max_bytes`` raised on purpose.
    """
    size = measure_side(small, max_rows, consider_bytes)
    if size.rows <= max_rows and size.bytes <= always_bytes:
        return "broadcast", size
    if size.fits:
        return "consider", size
    return "planner", size


def _check_columns(df: DataFrame, cols: Sequence[str], side: str) -> None:
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"join key(s) {missing} not found on the {side} side; it has {df.columns}")


def _as_list(on: str | Sequence[str]) -> list[str]:
    return [on] if isinstance(on, str) else list(on)


def shuffle_join(big: DataFrame, small: DataFrame, on: str | Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join through a sort-merge join (both sides shuffled on the key).

    A per-query hint, not a session-wide threshold of -1, so other queries in
    the session keep their broadcast and AQE choices.
    """
    keys = _as_list(on)
    _check_columns(big, keys, "left")
    _check_columns(small, keys, "right")
    return big.join(small.hint("merge"), keys, how)


def broadcast_join(
    big: DataFrame,
    small: DataFrame,
    on: str | Sequence[str],
    how: str = "inner",
    max_rows: int = BROADCAST_MAX_ROWS,
    max_bytes: int = BROADCAST_MAX_BYTES,
    parts: int | None = None,
) -> DataFrame:
    """Equi-join that broadcasts ``small`` when its measured size fits the bound.

    Past the bound an inner or left join on one key splits its hot and NULL
    keys (:func:`salted_join`, over ``parts`` partitions if given); other joins are left to the planner and AQE.
    """
    keys = _as_list(on)
    _check_columns(big, keys, "left")
    _check_columns(small, keys, "right")
    if how.lower() in _BROADCAST_HOWS and measure_side(small, max_rows, max_bytes).fits:
        return big.join(F.broadcast(small), keys, how)
    if len(keys) == 1 and how.lower() in _SALTED_HOWS:
        return salted_join(big, small, keys[0], how, broadcast_max_rows=0, parts=parts)
    return big.join(small, keys, how)


def left_outer_join(
    left: DataFrame,
    right: DataFrame,
    left_on: str | Sequence[str],
    right_on: str | Sequence[str] | None = None,
    max_rows: int = BROADCAST_MAX_ROWS,
    max_bytes: int = BROADCAST_MAX_BYTES,
) -> DataFrame:
    """Left outer join; unmatched left rows get NULL right columns.

    With equal key names the key is emitted once (USING join); with different
    names both are kept. Missing keys raise a clear error up front instead of
    an analysis error deep in the plan. The right side is broadcast when its
    measured size fits the bound: the left side is then never shuffled on a
    key that may be few-valued or mostly NULL (all NULL keys would land in
    one shuffle partition).
    """
    lk = _as_list(left_on)
    rk = lk if right_on is None else _as_list(right_on)
    if len(lk) != len(rk):
        raise ValueError(f"left keys {lk} and right keys {rk} differ in number")
    _check_columns(left, lk, "left")
    _check_columns(right, rk, "right")
    fits = measure_side(right, max_rows, max_bytes).fits
    if not fits and len(lk) == 1 and (lk == rk or lk[0] not in right.columns):
        # hot keys are split, NULL keys spread; the right key stays as a column of its own name
        return salted_join(left, right if lk == rk else right.withColumn(lk[0], F.col(rk[0])), lk[0], "left", broadcast_max_rows=0)
    r = F.broadcast(right) if fits else right
    if lk == rk:
        return left.join(r, lk, "left")
    cond = [left[a] == r[b] for a, b in zip(lk, rk)]
    return left.join(r, cond, "left")


class CrossJoinTooLarge(ValueError):
    pass


def guarded_cross_join(left: DataFrame, right: DataFrame, max_right_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Every left row paired with every right row, for two aggregated tables.

    The right side is measured first and broadcast (a nested-loop join, no shuffle of left). The output grows
    as |left| x |right|, so a right side above ``max_right_rows`` or the broadcast bound is refused with an error.
    """
    if not measure_side(right, max_right_rows, BROADCAST_MAX_BYTES).fits:
        raise CrossJoinTooLarge(
            f"right side has more than {max_right_rows} rows or {BROADCAST_MAX_BYTES} bytes; "
            "aggregate it first or join on a key"
        )
    return left.crossJoin(F.broadcast(right))


def join_fanout(
    left: DataFrame, right: DataFrame, left_key: str, right_key: str | None = None, key_alias: str = "join_key"
) -> DataFrame:
    """Rows a join would produce, per key and in total, without running it.

    ``pairs = left_rows * right_rows`` per key; ``total_pairs`` is the sum over
    keys. Both sides are reduced to one row per key before the join; the
    total is an uncorrelated scalar subquery over the per-key rows, so no
    global window funnels all keys through one task.
    """
    right_key = right_key or left_key
    _check_columns(left, [left_key], "left")
    _check_columns(right, [right_key], "right")
    lc = left.groupBy(F.col(left_key).alias(key_alias)).agg(F.count(F.lit(1)).alias("left_rows"))
    rc = right.groupBy(F.col(right_key).alias(key_alias)).agg(F.count(F.lit(1)).alias("right_rows"))
    # counts have at most 19 digits, so products fit DECIMAL(38,0) where BIGINT would overflow
    wide = [F.col(c).cast("decimal(19,0)") for c in ("left_rows", "right_rows")]
    per_key = lc.join(rc, key_alias, "inner").withColumn("pairs", (wide[0] * wide[1]).cast("decimal(38,0)"))
    total = per_key.agg(F.sum("pairs").cast("decimal(38,0)")).scalar()
    return per_key.withColumn("total_pairs", total)


# --- Salted join -------------------------------------------------------------

# Salted parts per task: with several, parts that hash to one partition even out.
PARTS_PER_TASK = 8


def hot_keys(
    big: DataFrame,
    key: str,
    rows_per_salt: int | None = None,
    target_tasks: int | None = None,
    target_bytes: int | None = None,
) -> DataFrame:
    """Keys of ``big`` too large for one part, with a salt count each (``key, _n_salts``).

    A key is hot when it holds more rows than one part should: by default the
    smaller of ``|big| / target_tasks`` and the rows of ``target_bytes``
    (``target_tasks`` defaults to ``PARTS_PER_TASK`` times the session's shuffle
    partitions, ``target_bytes`` to AQE's advisory partition size), or
    ``rows_per_salt`` when given. ``n_salts = ceil(rows / limit)``, without
    a cap: a key of any size is cut to parts of that limit.

    The counts per key are written once to the shared folder (one partial
    aggregation over ``big``); the totals are read from that table.
    """
    spark = big.sparkSession
    tasks = target_tasks or PARTS_PER_TASK * shuffle_partitions(spark)
    # NULL is counted as a group too: NULL keys never match, but a left join
    # still shuffles them, and all of them hash to the same partition.
    counts = materialize(
        big.groupBy(key).agg(F.count(F.lit(1)).alias("_rows"), F.sum(row_bytes(big.schema)).alias("_bytes")),
        "key-counts")
    if rows_per_salt is not None:
        limit = F.lit(max(1, int(rows_per_salt)))
    else:
        total = counts.select(F.struct(F.sum("_rows").alias("rows"), F.sum("_bytes").alias("bytes"))).scalar()
        rows, nbytes = total.getField("rows"), total.getField("bytes")
        mean_part = F.ceil(rows / F.lit(tasks))
        width = F.greatest(nbytes / rows, F.lit(1))
        limit = F.least(mean_part, F.ceil(F.lit(target_bytes or advisory_partition_bytes(spark)) / width))
    scoped = counts.withColumn("_limit", F.greatest(limit, F.lit(1)).cast("long"))
    return scoped.where(F.col("_rows") > F.col("_limit")).select(
        key, F.ceil(F.col("_rows") / F.col("_limit")).cast("int").alias("_n_salts"))


def salted_join(
    big: DataFrame,
    small: DataFrame,
    key: str,
    how: str = "inner",
    hot: DataFrame | None = None,
    rows_per_salt: int | None = None,
    salt_cols: Sequence[str] | None = None,
    broadcast_max_rows: int = BROADCAST_MAX_ROWS,
    broadcast_max_bytes: int = BROADCAST_MAX_BYTES,
    parts: int | None = None,
) -> DataFrame:
    """Equi-join on ``key`` with hot keys of ``big`` split over several tasks.

    When ``small`` measures within the broadcast bound it is simply
    broadcast: no shuffle of ``big`` at all, so nothing to salt. Salting is
    the path beyond the bound (``broadcast_max_rows=0`` forces it):

    Each row of ``big`` with a hot key gets a salt in ``0..n_salts-1``: a hash of
    its columns and its place in its partition, so equal rows spread as well. It is
    the same on a retry where ``big`` is read in a fixed order, as a scan or a
    written table is; name ``salt_cols`` to use these columns alone;
    the ``small`` rows of that key are replicated once per salt; the join runs
    on ``(key, salt)``. Other keys use salt 0 and are not replicated. Salt is
    its own column, never glued into the key. Only ``inner`` and ``left`` (with
    ``big`` on the left) are offered: under right/full outer the replicated
    copies would each emit an unmatched row. NULL keys of ``big`` count as a
    group of their own: under a left join they are spread by salt like a hot
    key instead of all landing in one partition (they match nothing either
    way).

    ``hot`` (columns ``key, _n_salts``) may be passed in, e.g. from a profile;
    by default it is computed from ``big`` (see :func:`hot_keys`) and written
    as a table to the shared checkpoint folder, so the profile runs once and
    survives executor loss. It is broadcast only after measuring it.
    Both sides are shuffled to ``parts`` partitions if given, else to the session's.
    """
    if how.lower() not in _SALTED_HOWS:
        raise ValueError("salted_join supports only inner and left joins")
    _check_columns(big, [key], "left")
    _check_columns(small, [key], "right")
    if broadcast_max_rows > 0 and measure_side(small, broadcast_max_rows, broadcast_max_bytes).fits:
        return big.join(F.broadcast(small), key, how)
    if hot is None:
        hot = materialize(hot_keys(big, key, rows_per_salt), "hot-keys")
    hot = hot.select(F.col(key).alias("_hot_key"), "_n_salts")
    hot_b = F.broadcast(hot) if measure_side(hot).fits else hot
    salted_by = [F.col(f"`{c}`") for c in salt_cols or big.columns]
    if not salt_cols:
        salted_by.append(F.monotonically_increasing_id())
    n = F.coalesce(F.col("_n_salts"), F.lit(1))

    def with_salt_count(df: DataFrame) -> DataFrame:
        # null-safe, so a hot NULL group gets its salt count as well
        return df.join(hot_b, F.col(key).eqNullSafe(F.col("_hot_key")), "left").drop("_hot_key")

    big_s = (
        with_salt_count(big)
        .withColumn("_salt", salt_bucket(n, *salted_by))
        .drop("_n_salts")
    )
    small_s = (
        with_salt_count(small.where(F.col(key).isNotNull()))  # NULL keys match nothing
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), n - F.lit(1))))
        .drop("_n_salts")
    )
    if parts:
        big_s, small_s = (side.repartition(parts, key, "_salt") for side in (big_s, small_s))
    return big_s.join(small_s.hint("merge"), [key, "_salt"], how).drop("_salt")
