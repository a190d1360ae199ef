"""File and table quality checks.

Each check is one aggregate pass and returns a small check table
(scope, rule, ok, detail); ``raise_on_failure`` turns it into an error on the
driver, reading only that small table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.functions.headers import missing_columns
from candlewick.functions.numbers import locale_number
from candlewick.session import ensure_checkpoint_dir

SAMPLE_INVALID = 3


def validate_frame(df: DataFrame, *, required_columns: list[str], key_columns: list[str],
                   min_rows: int = 1, max_rows: int | None = None, enforce_unique_keys: bool = True,
                   scope: str = "file_name", scopes: DataFrame | None = None) -> DataFrame:
    """A9 + U1: per ``scope`` value (e.g. file): row count bounds, blank keys,
    duplicate keys, and missing required columns.  ``scopes`` lists every scope
    value (a manifest): those without rows then count as 0 rows instead of
    being absent."""
    missing = missing_columns(df.columns, required_columns)
    present_keys = [k for k in key_columns if k in df.columns]
    blank = F.lit(False)
    for k in present_keys:
        blank = blank | F.col(k).isNull() | (F.trim(F.col(k).cast("string")) == "")
    g = df.groupBy(scope).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(blank).alias("blank_keys"),
        F.count_distinct(F.struct(*[F.col(k) for k in present_keys])).alias("distinct_keys") if present_keys
        else F.lit(0).alias("distinct_keys"),
    )
    if scopes is not None:
        g = scopes.select(scope).distinct().join(g, scope, "left").fillna(0, ["rows", "blank_keys", "distinct_keys"])
    dup = F.col("rows") - F.col("distinct_keys")
    checks = F.array(
        F.struct(F.lit("min_rows").alias("rule"), (F.col("rows") >= min_rows).alias("ok"),
                 F.col("rows").cast("string").alias("detail")),
        F.struct(F.lit("max_rows").alias("rule"),
                 (F.lit(True) if max_rows is None else (F.col("rows") <= max_rows)).alias("ok"),
                 F.col("rows").cast("string").alias("detail")),
        F.struct(F.lit("required_columns").alias("rule"), F.lit(not missing).alias("ok"),
                 F.lit(",".join(missing)).alias("detail")),
        F.struct(F.lit("blank_keys").alias("rule"), (F.col("blank_keys") == 0).alias("ok"),
                 F.col("blank_keys").cast("string").alias("detail")),
        F.struct(F.lit("duplicate_keys").alias("rule"), (F.lit(not enforce_unique_keys) | (dup == 0)).alias("ok"),
                 dup.cast("string").alias("detail")),
    )
    return g.select(F.col(scope).alias("scope"), F.explode(checks).alias("c")).select(
        "scope", "c.rule", "c.ok", "c.detail")


def raise_on_failure(checks: DataFrame) -> None:
    """Error with the number of failed checks and, by rule, how many scopes failed and one of them."""
    bad = checks.where(~F.col("ok")).groupBy("rule").agg(F.count(F.lit(1)).alias("n"), F.min("scope").alias("scope"), F.min_by("detail", "scope").alias("detail")).orderBy("rule").collect()
    if bad:
        raise ValueError(f"{sum(r.n for r in bad)} validation checks failed: " + "; ".join(f"{r.rule}: {r.n}, such as {r.scope} ({r.detail})" for r in bad))


def locale_profile(df: DataFrame, columns: list[str], scope: str = "file_name") -> DataFrame:
    """A10: per scope and numeric column, raw / parsed / invalid counts and the
    three smallest invalid raw values (a bounded top-k, not a collect)."""
    long = df.select(scope, F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("raw")) for c in columns
    ])).alias("v")).select(scope, "v.column", "v.raw")
    long = long.withColumn("parsed", locale_number("raw"))
    present = F.col("raw").isNotNull() & ~F.trim("raw").isin("", "-")
    invalid = present & F.col("parsed").isNull()
    # One pass: what is invalid is counted by its value, the rest by the column.
    ensure_checkpoint_dir(df.sparkSession)
    per_value = long.groupBy(scope, "column", F.when(invalid, F.col("raw")).alias("bad")).agg(
        F.count_if(present).alias("raw_count"), F.count(F.col("parsed")).alias("parsed_count")).checkpoint(eager=True)
    bad = F.col("bad").isNotNull()
    counts = per_value.groupBy(scope, "column").agg(
        F.sum("raw_count").alias("raw_count"), F.sum("parsed_count").alias("parsed_count"),
        F.coalesce(F.sum(F.when(bad, F.col("raw_count"))), F.lit(0)).alias("invalid_count"))
    from pyspark.sql.window import Window
    w = Window.partitionBy(scope, "column").orderBy("bad")
    samples = (per_value.where(bad).select(scope, "column", "bad")
               .withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= SAMPLE_INVALID)
               .groupBy(scope, "column").agg(F.array_sort(F.collect_list("bad")).alias("invalid_samples")))
    return counts.join(samples, [scope, "column"], "left").select(
        scope, "column", "raw_count", "parsed_count", "invalid_count",
        F.coalesce("invalid_samples", F.array().cast("array<string>")).alias("invalid_samples"))
