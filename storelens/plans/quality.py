"""Data-quality and reconciliation jobs."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storelens.plans.measures import ITEMS, PAYMENTS
from storelens.schemas import NOT_NULL, RELATIONSHIPS, UNIQUE_KEYS

Read = Callable[[str, str], DataFrame]


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def pk_violations(df: DataFrame, table: str, keys: Sequence[str]) -> DataFrame:
    """How many keys occur more than once, and how many rows there are beyond the first of each."""
    repeated = df.groupBy(*keys).agg(F.count("*").alias("n")).where(F.col("n") > 1)
    return repeated.agg(
        F.count("*").alias("violating_keys"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint").alias("surplus_rows"),
    ).select(
        F.lit(table).alias("table"),
        F.lit(",".join(keys)).alias("key_columns"),
        "violating_keys",
        "surplus_rows",
    )


def all_pk_violations(read: Read) -> DataFrame:
    """Every declared key."""
    return _union([pk_violations(read(layer, t), f"{layer}.{t}", keys) for layer, t, keys in UNIQUE_KEYS])


def null_counts(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    """NULLs per column, all counted in one pass over the table."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    pairs = [F.struct(F.lit(c).alias("column"), F.col(c).alias("nulls")) for c in columns]
    return counts.select(F.lit(table).alias("table"), F.inline(F.array(*pairs)))


def all_null_counts(read: Read) -> DataFrame:
    """Every column that is part of a key or declared NOT NULL."""
    required: dict[tuple[str, str], list[str]] = {}
    declared = [(layer, t, c) for layer, t, keys in UNIQUE_KEYS for c in keys]
    for layer, table, column in [*declared, *NOT_NULL]:
        columns = required.setdefault((layer, table), [])
        if column not in columns:
            columns.append(column)
    return _union([null_counts(read(layer, t), f"{layer}.{t}", cols) for (layer, t), cols in required.items()])


def orphans(many: DataFrame, column: str, one: DataFrame, key: str, table: str, dimension: str) -> DataFrame:
    """Rows whose key the dimension lacks. Rows are counted per key first, so a hot key is one row."""
    used = many.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("used")).agg(F.count("*").alias("n"))
    lost = used.join(one.select(F.col(key).alias("used")), "used", "left_anti")
    return lost.agg(
        F.count("*").alias("orphan_keys"),
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("orphan_rows"),
    ).select(
        F.lit(f"{table}.{column}").alias("many_side"),
        F.lit(f"{dimension}.{key}").alias("one_side"),
        "orphan_keys",
        "orphan_rows",
    )


def all_orphans(read: Read) -> DataFrame:
    return _union(
        [
            orphans(read("gold", r.table), r.column, read("gold", r.dimension), r.key, r.table, r.dimension)
            for r in RELATIONSHIPS
        ]
    )


def dedup_profile(bronze: DataFrame, silver: DataFrame, table: str) -> DataFrame:
    """Rows in, rows kept and the share kept."""
    rows_in = bronze.agg(F.count("*").alias("bronze_rows"))
    kept = silver.agg(F.count("*").alias("silver_rows"))
    both = rows_in.unionByName(kept, allowMissingColumns=True)
    return both.agg(
        F.max("bronze_rows").alias("bronze_rows"), F.max("silver_rows").alias("silver_rows")
    ).select(
        F.lit(table).alias("table"),
        "bronze_rows",
        "silver_rows",
        F.try_divide(F.col("silver_rows").cast("double"), F.col("bronze_rows").cast("double")).alias("kept_share"),
    )


def cast_failures(bronze: DataFrame, columns: Sequence[str], table: str) -> DataFrame:
    """Per text column: values present that do not read as a timestamp."""
    counts = bronze.agg(
        *[
            F.count_if(F.col(c).isNotNull() & F.col(c).try_cast("timestamp_ntz").isNull()).alias(c)
            for c in columns
        ]
    )
    pairs = [F.struct(F.lit(c).alias("column"), F.col(c).alias("failures")) for c in columns]
    return counts.select(F.lit(table).alias("table"), F.inline(F.array(*pairs)))


def layer_row_counts(tables: Sequence[tuple[str, str, DataFrame]]) -> DataFrame:
    """Rows per table, per layer (table NULL) and in all (both NULL)."""
    counts = _union(
        [
            df.agg(F.count("*").alias("n")).select(F.lit(layer).alias("layer"), F.lit(name).alias("table"), "n")
            for layer, name, df in tables
        ]
    )
    return counts.rollup("layer", "table").agg(F.sum("n").alias("rows"))


def reconcile(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of either build that the other lacks, repeated rows included; empty when the two agree."""
    right = right.select(*left.columns)
    only_left = left.exceptAll(right).withColumn("_side", F.lit("left"))
    only_right = right.exceptAll(left).withColumn("_side", F.lit("right"))
    return only_left.unionByName(only_right)


def payments_vs_gmv(read: Read) -> DataFrame:
    """Per order: what was sold, what was paid, and the difference. Orders with only one side stay."""
    sold = read("gold", ITEMS).groupBy("order_id").agg(F.sum("total_value").alias("sold"))
    paid = read("gold", PAYMENTS).groupBy("order_id").agg(F.sum("payment_value").alias("paid"))
    money = "decimal(28,2)"
    zero = F.lit(0).cast(money)
    return sold.join(paid, "order_id", "full").select(
        "order_id",
        F.col("sold").cast(money).alias("gmv"),
        F.col("paid").cast(money).alias("payments"),
        (F.coalesce(F.col("paid").cast(money), zero) - F.coalesce(F.col("sold").cast(money), zero))
        .cast(money)
        .alias("difference"),
    )
