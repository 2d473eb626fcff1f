"""Model prices and routing advice, and what a call costs.

Prices carry six decimals per thousand tokens, so the price of one token is a
whole number of nano-dollars and a call's cost is exact BIGINT arithmetic.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tracewaste.schemas import MODEL_CATALOG, column_names

# Synthetic prices for tests and examples; real ones are configuration.
SYNTHETIC_CATALOG = [
    ("gpt-5", "0.010000", "0.030000", True, "gpt-5-mini"),
    ("gpt-5-mini", "0.000400", "0.001600", False, None),
    ("claude-opus-4-6", "0.015000", "0.075000", True, "claude-haiku-4-5"),
    ("claude-sonnet-4-6", "0.003000", "0.015000", False, None),
    ("claude-haiku-4-5", "0.000800", "0.004000", False, None),
    ("gemini-pro", "0.001250", "0.005000", False, None),
    ("text-embedding-3-small", "0.000020", "0.000000", False, None),
]


def synthetic_catalog(spark: SparkSession) -> DataFrame:
    # A literal relation: its size is known to the optimizer without running a job.
    rows = ", ".join(
        f"('{model}', {price_in}, {price_out}, {frontier}, {f"'{other}'" if other else 'NULL'})"
        for model, price_in, price_out, frontier, other in SYNTHETIC_CATALOG
    )
    names = ", ".join(column_names(MODEL_CATALOG))
    return spark.sql(f"SELECT * FROM VALUES {rows} AS catalog({names})").to(
        StructType.fromDDL(MODEL_CATALOG)
    )


BROADCAST_ROWS = 100_000


def _token_nanos(price: str) -> Column:
    return F.coalesce((F.col(price) * 1_000_000).cast("bigint"), F.lit(0).cast("bigint"))


def price_table(catalog: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """One row per model with nano-dollar token prices, its own and the alternative's.

    Marked for broadcast when the catalog's size allows; a larger catalog joins
    by shuffle, where adaptive execution splits the popular models.
    """
    size = catalog.agg(F.count("*").alias("n"), F.count_distinct("model").alias("models")).first()
    if size["n"] != size["models"]:
        raise ValueError("the model catalog names a model twice or leaves one unnamed")
    base = catalog.select(
        *column_names(MODEL_CATALOG),
        _token_nanos("price_in_per_1k").alias("in_nanos"),
        _token_nanos("price_out_per_1k").alias("out_nanos"),
    )
    other = base.select(
        F.col("model").alias("alternative"),
        F.col("in_nanos").alias("alt_in_nanos"),
        F.col("out_nanos").alias("alt_out_nanos"),
    )
    small = size["n"] <= max_rows
    joined = base.join(F.broadcast(other) if small else other, "alternative", "left").select(
        "model",
        "is_frontier",
        "alternative",
        "in_nanos",
        "out_nanos",
        F.coalesce("alt_in_nanos", F.lit(0)).alias("alt_in_nanos"),
        F.coalesce("alt_out_nanos", F.lit(0)).alias("alt_out_nanos"),
    )
    return F.broadcast(joined) if small else joined


def with_cost(calls: DataFrame, prices: DataFrame) -> DataFrame:
    """Calls with the columns of :func:`price_table` and ``cost_nanos``; an unknown model costs 0."""
    cost = F.col("prompt_tokens") * F.coalesce("in_nanos", F.lit(0)) + F.col(
        "completion_tokens"
    ) * F.coalesce("out_nanos", F.lit(0))
    return calls.join(prices, "model", "left").withColumn("cost_nanos", cost)
