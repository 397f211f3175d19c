"""Column expressions shared by the operators.

All of them are built-in Catalyst expressions, so they stay inside
whole-stage codegen; none is a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Money is summed exactly, as whole cents in a BIGINT, and the total is turned
# into DOUBLE once: plain double sums depend on the order partial sums are
# merged in, so they differ between runs with another partitioning and
# between engines. A BIGINT sum stays in fixed-width aggregation buffers
# (a DECIMAL sum widens to DECIMAL(28,2) and runs on BigDecimal), and holds
# totals up to 9.2e16 currency units; with ANSI mode on, an overflow fails
# the query instead of wrapping.
MONEY_TYPE = "decimal(18,2)"

# 2^53: the largest power of two whose multiples are exact in a double, used to
# turn a 64-bit hash into a uniform number in [0, 1).
_UNIT_SCALE = float(1 << 53)


def col_of(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(c: str | Column) -> Column:
    """A money value as DECIMAL(18,2)."""
    return col_of(c).cast(MONEY_TYPE)


def cents(c: str | Column) -> Column:
    """A money value (at most two decimals) as whole cents, rounded half up."""
    return F.round(col_of(c) * F.lit(100)).cast("long")


def cents_to_money(total_cents: Column) -> Column:
    """Summed cents back to currency units as DOUBLE, rounded once from the exact value."""
    return (total_cents.cast("decimal(38,0)") / F.lit(100)).cast("double")


def money_sum(c: str | Column) -> Column:
    """Exact sum of a money column, returned as DOUBLE.

    Equals ``CAST(SUM(CAST(c AS DECIMAL(18,2))) AS DOUBLE)`` for values with
    at most two decimals.
    """
    return cents_to_money(F.sum(cents(c)))


def hash_uniform(*cols: str | Column, seed: int = 0) -> Column:
    """Repeatable uniform number in [0, 1) from the hash of ``cols``.

    Unlike ``rand()`` it gives the same value for the same row on every run and
    on every task retry, so it is safe inside shuffle keys.
    """
    h = F.xxhash64(F.lit(seed), *[col_of(c) for c in cols])
    return F.pmod(F.shiftright(h, 11), F.lit(1 << 53)).cast("double") / F.lit(_UNIT_SCALE)


def salt_bucket(n: int | Column, *cols: str | Column, seed: int = 17) -> Column:
    """Salt in 0..n-1 from the hash of ``cols`` (a repeatable, spread-out bucket)."""
    n_col = n if isinstance(n, Column) else F.lit(int(n))
    return F.pmod(F.xxhash64(F.lit(seed), *[col_of(c) for c in cols]), n_col.cast("long")).cast("int")


def quantity_int(c: str | Column) -> Column:
    """Quantity as INT (truncating, as the reference's generator does)."""
    return col_of(c).cast("int")


# --- Fixed values: derived skew for the uniform driver tables. -------------
# These label and share values are the product keys of the reference data set
# and must stay as they are: the keys contain "_" on purpose, so salting code
# that glues a salt onto the key with "_" would visibly break them.
SKEW_LABELS = ("PROMO_ESPECIAL", "PRODUTO_A", "PRODUTO_B", "PRODUTO_C")


def skew_key(id_col: str | Column) -> Column:
    """Skewed label from an id: shares about .80 / .18 / .018 / .002."""
    i = col_of(id_col)
    return (
        F.when(i % 10 < 8, F.lit(SKEW_LABELS[0]))
        .when(i % 100 < 98, F.lit(SKEW_LABELS[1]))
        .when(i % 1000 < 998, F.lit(SKEW_LABELS[2]))
        .otherwise(F.lit(SKEW_LABELS[3]))
    )


def skew_key_sql(id_col: str) -> str:
    """The same expression as SQL text (for oracles and ``selectExpr``)."""
    a, b, c, d = SKEW_LABELS
    return (
        f"CASE WHEN {id_col} % 10 < 8 THEN '{a}' WHEN {id_col} % 100 < 98 THEN '{b}' "
        f"WHEN {id_col} % 1000 < 998 THEN '{c}' ELSE '{d}' END"
    )


def hot_product_sql(id_col: str, product_col: str) -> str:
    """SQL text of a product key of which product 1 has about 80 % of the rows."""
    return f"CASE WHEN {id_col} % 10 < 8 THEN CAST(1 AS BIGINT) ELSE {product_col} END"


def null_region(id_col: str | Column, region_col: str | Column) -> Column:
    """About 30 % NULL regions, derived from the id, else the given region."""
    return F.when(col_of(id_col) % 10 < 3, F.lit(None).cast("string")).otherwise(col_of(region_col))


def null_region_sql(id_col: str, region_col: str) -> str:
    return f"CASE WHEN {id_col} % 10 < 3 THEN NULL ELSE {region_col} END"


def money_sum_sql(c: str) -> str:
    return f"CAST(SUM(CAST({c} AS DECIMAL(18,2))) AS DOUBLE)"


_FIXED_WIDTH = {
    T.LongType: 8, T.DoubleType: 8, T.TimestampType: 8, T.TimestampNTZType: 8,
    T.IntegerType: 4, T.FloatType: 4, T.DateType: 4, T.ShortType: 2, T.ByteType: 1,
    T.BooleanType: 1, T.DecimalType: 16,
}


def field_bytes(field: T.StructField) -> Column:
    """Payload bytes of one column value (strings by their UTF-8 length)."""
    dt = field.dataType
    c = F.col(f"`{field.name}`")
    if isinstance(dt, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(c), F.lit(0)) + F.lit(8)
    for t, w in _FIXED_WIDTH.items():
        if isinstance(dt, t):
            return F.lit(w)
    if isinstance(dt, T.ArrayType):
        for t, w in _FIXED_WIDTH.items():
            if isinstance(dt.elementType, t):
                return F.greatest(F.coalesce(F.size(c), F.lit(0)), F.lit(0)) * F.lit(w) + F.lit(16)
    # Other nested values: their JSON text length is a fair upper estimate.
    return F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0))


def row_bytes(schema: T.StructType) -> Column:
    """Estimated payload bytes of a row of ``schema``."""
    return sum((field_bytes(f) for f in schema.fields), F.lit(0))
