"""Totals kept up to date by batches: partial states per batch, late rows and corrections as signed deltas."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skewkit.functions.expressions import cents, cents_to_money
from skewkit.sinks.layout import replace_partitions

#: A row's sign: it joins the totals, or takes back one that an earlier batch had wrong.
ADD, RETRACT = 1, -1


def apply_batch(rows: DataFrame, path: str, batch: str, keys: Sequence[str], amount: str, sign: str | None = None) -> None:
    """Reduce a batch to one state per group and store it as partition ``batch`` of ``path``.

    ``sign`` names a column of :data:`ADD` / :data:`RETRACT` (default: all rows add). A correction is a batch with the old
    row retracted and the new one added. The partition is replaced as a whole: a batch that is run
    again, after a failure or with late files, counts once. The fact itself is never read again.
    """
    s = F.col(sign) if sign else F.lit(ADD)
    state = rows.groupBy(*keys).agg(
        F.sum(cents(amount) * s).alias("_cents"), F.sum(s.cast("bigint")).alias("_rows")).withColumn("_batch", F.lit(batch))
    replace_partitions(state, path, ["_batch"])


def current_totals(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """``keys, total_amount, n_rows`` over all batches; groups whose rows have all been taken back are gone."""
    merged = spark.read.parquet(path).groupBy(*keys).agg(F.sum("_cents").alias("_cents"), F.sum("_rows").alias("n_rows"))
    return merged.where("n_rows > 0").select(*keys, cents_to_money(F.col("_cents")).alias("total_amount"), "n_rows")


def fold_batches(spark: SparkSession, path: str, out: str, keys: Sequence[str], batch: str = "folded") -> str:
    """All states of ``path`` merged into one batch at ``out``, to keep what :func:`current_totals` reads short."""
    merged = spark.read.parquet(path).groupBy(*keys).agg(F.sum("_cents").alias("_cents"), F.sum("_rows").alias("_rows"))
    return replace_partitions(merged.withColumn("_batch", F.lit(batch)), out, ["_batch"])
