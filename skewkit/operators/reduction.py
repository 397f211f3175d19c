"""Semi-join reduction: rows that cannot match leave before the exchange of a shuffled join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skewkit.operators.joins import BROADCAST_MAX_BYTES, shuffle_join
from skewkit.session import materialize

#: Bits and bytes of one bitmap (fixed values of the built-in bitmap functions).
BITMAP_BITS, BITMAP_BYTES = 32768, 4096
#: Positions per key where keys are hashed: one in so many rows without a match passes.
POSITIONS_PER_KEY = 16

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
#: Other types of which equal keys have equal hashes.
_HASHED = (T.StringType, T.BinaryType, T.DateType, T.TimestampType, T.TimestampNTZType, T.DecimalType, T.BooleanType)


def _hash(df: DataFrame, key: str) -> Column:
    """Equal whole numbers have one hash, whatever their widths."""
    return F.xxhash64(F.col(key).cast("long") if isinstance(df.schema[key].dataType, _INTEGRAL) else F.col(key))


def _place(df: DataFrame, key: str, positions: int | None) -> Column:
    """A key's position: itself, or its hash modulo ``positions``."""
    return F.col(key).cast("long") if positions is None else F.pmod(_hash(df, key), F.lit(positions))


def _bitmaps(keys: DataFrame, key: str, positions: int | None) -> DataFrame:
    place = _place(keys, key, positions)
    return keys.where(F.col(key).isNotNull()).groupBy(F.bitmap_bucket_number(place).alias("_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("_bitmap"))


def key_bitmaps(keys: DataFrame, key: str, max_bytes: int = BROADCAST_MAX_BYTES) -> tuple[DataFrame, int | None] | None:
    """Bitmaps of the keys (``_bucket, _bitmap``) and the positions they are hashed to, or None past ``max_bytes``.

    Whole numbers keep their own positions, so the bitmaps are exact, unless they are so sparse
    that the hashed bitmaps are smaller. Other types are hashed: no key is ever missed, one in
    ``POSITIONS_PER_KEY`` others passes. One aggregate measures both forms before any bitmap is built.
    """
    kind = keys.schema[key].dataType
    whole = isinstance(kind, _INTEGRAL)
    place = F.col(key).cast("long") if whole else _hash(keys, key)
    # per bucket first, so that the size is a count of groups and no distinct set is held
    n = (keys.where(F.col(key).isNotNull()).groupBy(F.bitmap_bucket_number(place).alias("b")).agg(F.count(F.lit(1)).alias("n"))
         .agg(F.count(F.lit(1)).alias("buckets"), F.coalesce(F.sum("n"), F.lit(0)).alias("rows")).first())
    positions = max(BITMAP_BITS, POSITIONS_PER_KEY * n["rows"])
    hashed = -(-positions // BITMAP_BITS) * BITMAP_BYTES
    exact = n["buckets"] * BITMAP_BYTES
    if min(hashed, exact if whole else hashed) > max_bytes:
        return None
    if whole and exact <= hashed:
        return _bitmaps(keys, key, None), None
    return _bitmaps(keys, key, positions), positions


def _bit(bitmap: Column, position: Column) -> Column:
    byte = F.conv(F.hex(bitmap.substr((F.shiftright(position, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, position.bitwiseAND(F.lit(7)).cast("int")) == 1


def reduce_to_keys(fact: DataFrame, keys: DataFrame, key: str, max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """The rows of ``fact`` whose key can be among ``keys``; none that can is dropped, NULL keys go.

    The bitmaps are written once, measured before and broadcast; past ``max_bytes`` the fact is
    handed on as it is, for a join that needs no reduction to be right. So it is where the two keys' types
    differ (unless both are whole numbers) or are floating, since equal keys may then have different hashes.
    """
    kinds = [df.schema[key].dataType for df in (fact, keys)]
    alike = all(isinstance(k, _INTEGRAL) for k in kinds) or kinds[0] == kinds[1] and isinstance(kinds[0], _HASHED)
    got = key_bitmaps(keys.select(key), key, max_bytes) if alike else None
    if got is None:
        return fact
    bitmaps, positions = materialize(got[0], "key-bitmaps"), got[1]
    place = _place(fact, key, positions)
    met = fact.join(F.broadcast(bitmaps), F.bitmap_bucket_number(place) == F.col("_bucket"), "inner")
    return met.where(_bit(F.col("_bitmap"), F.bitmap_bit_position(place))).select(*[F.col(f"`{c}`") for c in fact.columns])


def reduced_join(fact: DataFrame, dim: DataFrame, key: str, how: str = "inner", max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Shuffled equi-join (inner or left_semi) whose fact rows without a match never reach the exchange."""
    if how not in ("inner", "left_semi"):
        raise ValueError("only inner and left_semi joins drop the rows that a reduction drops")
    return shuffle_join(reduce_to_keys(fact, dim, key, max_bytes), dim, key, how)
