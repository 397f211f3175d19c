from skewkit.functions.expressions import (  # noqa: F401
    MONEY_TYPE,
    SKEW_LABELS,
    cents,
    cents_to_money,
    col_of,
    hash_uniform,
    money,
    money_sum,
    money_sum_sql,
    null_region,
    null_region_sql,
    quantity_int,
    salt_bucket,
    skew_key,
    skew_key_sql,
)
