"""Text files as ordered lines, whatever their folder, encoding or wrapping.

A line's file is its full path: files of one name in different folders stay
apart.  A line's place is ``line_no``, the pair (start of its block in the
file, row of the reading task), which orders the lines of a file for any file
size and any number of tasks, since one task reads a block from its start on.
The pair holds for one scan: how Spark packs files into tasks depends on the
cores of the moment, so another scan may number the same line otherwise.  What
refers to lines by number reads them from ``once``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

from candlewick.session import ensure_checkpoint_dir, scratch_path

#: Largest per-file table that is broadcast; a larger one is joined by shuffle.
MAX_BROADCAST_FILES = 50_000
_ROW_BITS = (1 << 33) - 1
# Separators with a pattern of their own; residues that lines are dealt into to bound the first ones.
USUAL_SEPARATORS = {"|": "\\|", "\t": "\t", ",": ",", ";": ";"}
FIRST_LINES_SALTS = 64
MARK = "\u0001"


def base_name(path) -> Column:
    c = F.col(path) if isinstance(path, str) else path
    return F.substring_index(c, "/", -1)  # a pattern would try every place of the path


def decode_line(value: Column, encoding: str | None = None) -> Column:
    """UTF-8 where the bytes are valid UTF-8 (byte order mark dropped),
    else ISO-8859-1; or the one encoding given."""
    if encoding:
        return F.decode(value.cast("binary"), encoding)
    text = F.when(F.is_valid_utf8(value), value).otherwise(F.decode(value.cast("binary"), "ISO-8859-1"))
    return F.regexp_replace(text, "^\ufeff", "")


def scan(spark: SparkSession, paths, *, encoding: str | None = None, path_glob: str | None = None) -> DataFrame:
    """(file_name, line_no, line): file_name is the full path."""
    reader = spark.read.format("text")
    if path_glob:
        reader = reader.option("pathGlobFilter", path_glob)
    df = reader.load(paths if isinstance(paths, str) else list(paths))
    place = F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW_BITS)).alias("row"))
    return df.select(F.col("_metadata.file_path").alias("file_name"), place.alias("line_no"), decode_line(F.col("value"), encoding).alias("line"))


def same_path(path) -> Column:
    """A file's path as ``scan`` names it, whichever reader listed it."""
    return F.regexp_replace(path, "^file:/+", "file:///")


def scan_any(spark: SparkSession, paths, *, kind: str = "csv", encoding: str | None = None, tolerant: bool = False) -> DataFrame:
    """``scan`` for plain files and zip archives together (S4, S5); with
    ``tolerant`` a column ``problem`` marks broken archives."""
    from candlewick.sources.archives import zip_lines

    paths = [paths] if isinstance(paths, str) else list(paths)
    zips = [p for p in paths if p.lower().endswith(".zip")]
    plain = [p for p in paths if p not in zips]
    parts = []
    if plain:
        df = scan(spark, plain, encoding=encoding)
        parts.append(df.withColumn("problem", F.lit(None).cast("string")) if tolerant else df)
    if zips:
        z = zip_lines(spark, zips, kind=kind, encoding=encoding, tolerant=tolerant)
        parts.append(z.select(F.col("archive").alias("file_name"), F.struct(F.lit(0).cast("long").alias("block"), F.col("line_no").alias("row")).alias("line_no"), "line",
                              *(["problem"] if tolerant else [])))
    if not parts:
        raise ValueError("no input paths")
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def once(rows: DataFrame, name: str = "lines") -> DataFrame:
    """The lines of one scan, kept in the shared folder: every reader sees the
    same numbers, and archives and other encodings are decoded once.  So are
    other rows of which several readers need some of the columns."""
    path = scratch_path(rows.sparkSession, name)
    rows.write.option("compression", "zstd").parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def first_lines(lines: DataFrame, n: int) -> DataFrame:
    """The first ``n`` lines of every file.

    No file is sorted.  Scanned lines are numbered without gaps inside a block,
    so a block's first lines follow from its smallest number.  Other numbers
    are dealt into residues of a hash: the ``n``-th smallest of the residues'
    smallest numbers has ``n`` lines up to it, so later lines are none of the
    first.  Both are combining aggregates; only the lines left are ranked.
    """
    by_file = Window.partitionBy("file_name").orderBy("line_no")
    if isinstance(lines.schema["line_no"].dataType, StructType):
        start = per_file(lines.groupBy("file_name", F.col("line_no.block").alias("_block")).agg(F.min("line_no.row").alias("_first")))
        near = lines.withColumn("_block", F.col("line_no.block")).join(start, ["file_name", "_block"])
        lines = near.where(F.col("line_no.row") < F.col("_first") + n).drop("_block", "_first")
    else:
        salt = F.pmod(F.xxhash64("line_no"), F.lit(max(FIRST_LINES_SALTS, 4 * n)))
        least = lines.groupBy("file_name", salt.alias("_salt")).agg(F.min("line_no").alias("_least"))
        bound = per_file(least.groupBy(F.col("file_name").alias("_file")).agg(F.try_element_at(F.sort_array(F.collect_list("_least")), F.lit(n)).alias("_bound")))
        near = lines.join(bound, F.col("file_name").eqNullSafe(F.col("_file")))
        lines = near.where(F.col("_bound").isNull() | F.col("line_no").isNull() | (F.col("line_no") <= F.col("_bound"))).drop("_file", "_bound")
    return lines.withColumn("_pos", F.row_number().over(by_file)).where(F.col("_pos") <= n).drop("_pos")


def per_file(df: DataFrame) -> DataFrame:
    """A table with one row per file: evaluated once into the shared checkpoint
    folder, and marked for broadcast if its count proves it small."""
    ensure_checkpoint_dir(df.sparkSession)
    df = df.checkpoint(eager=True)
    return F.broadcast(df) if df.count() <= MAX_BROADCAST_FILES else df


def split_fields(line: Column, sep: Column) -> Column:
    """Fields of a line; separators inside double quotes do not count, and
    quoted fields lose their quotes (doubled ones become one).  Usual
    separators are split by a constant pattern, which is not compiled per line."""
    plain = F.split(line, F.concat(F.lit("\\Q"), sep, F.lit("\\E")))
    for usual, pattern in USUAL_SEPARATORS.items():
        plain = F.when(sep == usual, F.split(line, pattern)).otherwise(plain)
    outside = F.concat(F.lit("\\Q"), sep, F.lit("\\E(?=(?:[^\"]*\"[^\"]*\")*[^\"]*$)"))

    def unquote(x):
        t = F.trim(x)
        return F.when(t.rlike('^".*"$'), F.regexp_replace(F.substring(t, F.lit(2), F.length(t) - 2), '""', '"')).otherwise(x)

    # A separator is outside where an even number of quotes follows it.  Where all
    # quotes are paired it stands in every other piece and is marked there, since
    # the pattern looks ahead from every separator.
    paired = (F.size(F.split(line, '"')) % 2 == 1) & ~line.contains(MARK)
    marked = F.array_join(F.transform(F.split(line, '"'), lambda x, i: F.when(i % 2 == 0, F.replace(x, sep, F.lit(MARK))).otherwise(x)), '"')
    quoted = F.when(paired, F.split(marked, MARK)).otherwise(F.split(line, outside))
    return F.when(line.contains('"'), F.transform(quoted, unquote)).otherwise(plain)
