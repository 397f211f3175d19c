"""Declared schemas.

Tables are read with an explicit ``StructType`` instead of footer inference,
so a file that drifted from the contract fails at scan time instead of
silently changing result types downstream.
"""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


L, I, D, S, TS = T.LongType(), T.IntegerType(), T.DoubleType(), T.StringType(), T.TimestampNTZType()

# Driver tables (TPC-H-ish star plus events).
TABLES: dict[str, T.StructType] = {
    "lineitem": _struct(
        ("l_orderkey", L), ("l_partkey", L), ("l_suppkey", L), ("l_linenumber", I),
        ("l_quantity", D), ("l_extendedprice", D), ("l_discount", D), ("l_tax", D),
        ("l_returnflag", S), ("l_linestatus", S), ("l_shipdate", TS),
    ),
    "part": _struct(
        ("p_partkey", L), ("p_name", S), ("p_brand", S), ("p_type", S), ("p_size", I),
        ("p_retailprice", D),
    ),
    "customer": _struct(
        ("c_custkey", L), ("c_name", S), ("c_nationkey", I), ("c_acctbal", D), ("c_mktsegment", S),
    ),
    "orders": _struct(
        ("o_orderkey", L), ("o_custkey", L), ("o_orderstatus", S), ("o_totalprice", D),
        ("o_orderdate", TS), ("o_orderpriority", S),
    ),
    "supplier": _struct(("s_suppkey", L), ("s_name", S), ("s_nationkey", I), ("s_acctbal", D)),
    "nation": _struct(("n_nationkey", I), ("n_name", S), ("n_regionkey", I)),
    "region": _struct(("r_regionkey", I), ("r_name", S)),
    "events": _struct(
        ("event_id", L), ("ts", TS), ("user_id", L), ("event_type", S), ("value", D), ("props", S),
    ),
}

# The retail star in its own shape (what the generators write).
SALES = _struct(
    ("sale_id", L), ("product_id", S), ("amount", D), ("quantity", I), ("sale_date", T.DateType()),
)
PRODUCTS = _struct(("product_id", S), ("product_name", S), ("category", S))
CUSTOMERS = _struct(("customer_id", L), ("region", S), ("monthly_income", D))
