"""Registered queries: name -> (Spark builder, oracle SQL or None).

Every builder takes ``(spark, sf_dir)``, reads the given test tables (or
tables Spark derives from them) in full and returns a lazy DataFrame.  The
oracle SQL restates the same question for DuckDB over the same parquet files.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            # Market times are UTC wall-clock values: pin the session zone.
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return fn(spark, sf_dir)

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


def load_all() -> None:
    """Import the modules that register queries."""
    from candlewick.plans import q_analytics, q_candles, q_files, q_hist, q_landing, q_reads, q_stream, q_tables, q_universe  # noqa: F401
