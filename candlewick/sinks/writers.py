"""File writers (K8, K9, K10).  Spark's commit protocol makes each write
atomic at the folder level (files appear on job commit)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.sources.jsonl import record_json, write_jsonl_records
from candlewick.sources.payloads import batch_report, payload_records


def write_jsonl(points: DataFrame, path: str) -> None:
    """K8: JSONL quote histories, one folder per trade date."""
    write_jsonl_records(points).select("trade_date", "value").write.mode("overwrite") \
        .partitionBy("trade_date").text(path)


def write_payload_records(landed: DataFrame, path: str) -> None:
    """The JSONL record of every readable payload, one folder per trade date."""
    payload_records(landed).select("trade_date", record_json(F.col("record")).alias("value")).write.mode("overwrite") \
        .partitionBy("trade_date").text(path)


def write_report(landed: DataFrame, path: str) -> None:
    """K9: the per-ticker report CSV (header, seven columns)."""
    batch_report(landed).write.mode("overwrite").option("header", True).csv(path)


def write_normalized_csv(df: DataFrame, path: str) -> None:
    """``;``-separated UTF-8 CSV with a header and minimal quoting."""
    df.write.mode("overwrite").option("sep", ";").option("header", True).option("encoding", "UTF-8") \
        .option("quoteAll", False).csv(path)
