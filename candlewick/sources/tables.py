"""S21 table reads.

Driver test tables live as one parquet file each under an ``sf`` folder;
persisted market tables are parquet folders partitioned by date.  Reads never
infer: projections and filters applied later are pushed into the scan by
Catalyst (``PushedFilters`` / ``ReadSchema`` in the plan).
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TEST_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def read_test_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in TEST_TABLES:
        raise ValueError(f"unknown test table {name!r}")
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


# Declared columns of the market tables.
_PRICES = {c: "decimal(18,6)" for c in ("open_price", "close_price", "last_price", "min_price", "max_price", "avg_price")}
_DAILY = {"ticker": "string", "trade_date": "date", **_PRICES, "variation_pct": "decimal(10,4)", "financial_volume": "decimal(24,2)",
          "trade_count": "bigint", "source_file_name": "string"}
MARKET_TABLES: dict[str, dict[str, str]] = {
    "dim_assets": {
        "ticker": "string", "asset_name": "string", "isin": "string", "segment": "string", "instrument_type": "string",
        "source_file_date": "date", "is_active": "boolean", "created_at": "timestamp_ntz", "updated_at": "timestamp_ntz"},
    "fact_daily_trades": {c: t for c, t in _DAILY.items() if c != "last_price"},
    "fact_daily_quotes": {c: t for c, t in _DAILY.items() if c not in ("open_price", "close_price")},
    "fact_quotes": {
        "ticker": "string", "quoted_at": "timestamp_ntz", "trade_date": "date", "close_price": "decimal(18,6)",
        "price_fluctuation_pct": "decimal(10,4)", "source_jsonl": "string"},
}


def conform(df: DataFrame, table: str) -> DataFrame:
    """Cast to the declared types of a market table (half-up to its scale; a
    value that does not fit is null); undeclared columns stay as they are."""
    types = MARKET_TABLES[table]
    return df.select(*[F.col(c).try_cast(types[c]).alias(c) if c in types else F.col(c) for c in df.columns])


def read_market_table(spark: SparkSession, root: str, table: str) -> DataFrame:
    """A persisted market table with its declared schema: nothing is inferred."""
    schema = ", ".join(f"{c} {t}" for c, t in MARKET_TABLES[table].items())
    return spark.read.schema(schema).parquet(os.path.join(root, table))
