"""Delimited files: register and trades CSVs (S1-S3, S6, S7, S7a-S7d, C1, C2).

``normalize_lines`` finds the header of every file *in Spark* (preamble
skipped, delimiter sniffed, data-looking lines rejected); ``load_files`` maps
the fields of many files at once to internal names by header position, so
files with different headers and separators go through one job.  Separators
inside double quotes are honoured.  What is known of a file is one row of a
small table that is broadcast if its size is proven; lines are not shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.functions.headers import normalize_name
from candlewick.functions.text import header_key
from candlewick.session import ensure_checkpoint_dir
from candlewick.sources.lines import first_lines, once, per_file, split_fields

# Separators tried in order, header search depth.
SEPARATORS = (";", ",", "\t", "|")
HEADER_SEARCH_LINES = 10
# Header words expected per table kind (whole-word match).
EXPECTED_TOKENS = {
    "instruments": ("instrumento", "ticker", "tckrsymb", "isin", "ativo", "segmento"),
    "trades": ("instrumento", "ticker", "tckrsymb", "negocios", "preco", "fechamento", "volume"),
}


# --------------------------------------------------------------------------- many files, in Spark

def _outside_quotes(line: Column) -> Column:
    return F.regexp_replace(line, '"[^"]*"', "")


def sniff_separators(head: DataFrame) -> DataFrame:
    """(file_name, sniffed) from the first lines of every file.

    For each separator the number of its occurrences outside quotes is counted
    per line; the separator whose most frequent number (above zero) recurs in
    most lines wins, then the one that occurs more often, then the earlier of
    ``SEPARATORS``.  A file without any gets ``;``.
    """
    bare = _outside_quotes(F.col("line"))
    counts = [(F.length(bare) - F.length(F.translate(bare, s, ""))).alias(f"n{k}") for k, s in enumerate(SEPARATORS)]
    rows = head.where(F.trim("line") != "").select("file_name", *counts)
    lists = rows.groupBy("file_name").agg(*[F.collect_list(f"n{k}").alias(f"n{k}") for k in range(len(SEPARATORS))])  # a few lines a file

    def usual(k: int) -> Column:
        seen = F.col(f"n{k}")
        often = F.transform(F.array_distinct(F.filter(seen, lambda x: x > 0)), lambda v: F.struct(F.size(F.filter(seen, lambda y: y == v)).alias("lines"), v.alias("times")))
        most = F.array_max(often)
        return F.struct(F.coalesce(most["lines"], F.lit(0)).alias("lines"), F.coalesce(most["times"], F.lit(0)).alias("times"), F.lit(-k).alias("rank"))

    best = F.array_max(F.array(*[usual(k) for k in range(len(SEPARATORS))]))
    return lists.select("file_name", F.element_at(F.array(*map(F.lit, SEPARATORS)), 1 - best["rank"]).alias("sniffed"))


def looks_like_data(fields: Column) -> Column:
    """At least half of all fields are numbers, ISIN-like or upper-case
    codes."""
    datalike = F.filter(fields, lambda x: F.trim(x).rlike(r"^[0-9.,]+$|^[A-Z]{2}[A-Z0-9]{10}$|^[A-Z0-9]{4,}$"))
    return (F.size(fields) > 0) & (F.size(datalike) * 2 >= F.size(fields))


def normalize_lines(lines: DataFrame, table_key: str | None, *, min_fields: int = 3) -> tuple[DataFrame, DataFrame]:
    """S7 / S7a / S7d for many files: returns (headers, data).

    The separator is ``;`` where the line has one outside quotes, else the
    file's (S7c).  A ``table_key`` without expected tokens takes the generic
    rule (S7a): the first line with a separator, >= 2 fields and a letter, else
    the third line, or the first of a shorter file.

    ``headers``: one row per file (file_name, header_line_no, sep, header array,
    token_detected, valid).  The header is the first line with the delimiter,
    >= ``min_fields`` non-empty fields and an expected whole-word token that
    does not look like data; else the first line with >= 2 fields and a
    letter; else the first non-empty line.
    ``data``: (file_name, line_no, fields) of the lines below the header.
    """
    ensure_checkpoint_dir(lines.sparkSession)
    head = first_lines(lines, HEADER_SEARCH_LINES).checkpoint(eager=True)  # a few lines a file, searched several times
    head = head.withColumn("line", F.regexp_replace("line", "^\ufeff", ""))
    head = head.join(per_file(sniff_separators(head)), "file_name", "left")
    line = F.col("line")
    sep = F.when(_outside_quotes(line).contains(";"), F.lit(";")).otherwise(F.coalesce("sniffed", F.lit(";")))
    fields = split_fields(line, sep)
    nonempty = F.size(F.filter(fields, lambda x: F.trim(x) != ""))
    words = F.transform(fields, lambda x: header_key(x))
    known = table_key in EXPECTED_TOKENS
    token_re = r"\b(" + "|".join(EXPECTED_TOKENS[table_key]) + r")\b" if known else None
    has_token = F.exists(words, lambda w: w.rlike(token_re)) if known else F.lit(False)
    has_letter = F.exists(fields, lambda x: x.rlike(r"\p{L}"))
    cand = head.select(
        "file_name", "line_no", line.alias("line"), sep.alias("sep"), fields.alias("fields"),
        (F.col("line").contains(sep) & (nonempty >= min_fields) & has_token & ~looks_like_data(fields)).alias("strong"),
        (F.col("line").contains(sep) & (F.size(fields) >= 2) & has_letter).alias("weak"),
        (F.trim(line) != "").alias("nonblank"),
    )
    order = F.col("line_no")
    found = cand.groupBy("file_name").agg(
        F.min_by(F.struct("line_no", "sep", "fields"), F.when(F.col("strong"), order)).alias("s"),
        F.min_by(F.struct("line_no", "sep", "fields"), F.when(F.col("weak"), order)).alias("w"),
        F.min_by(F.struct("line_no", "sep", "fields"), F.when(F.col("nonblank"), order)).alias("n"),
        F.sort_array(F.collect_list(F.struct("line_no", "sep", "fields"))).alias("all"),  # the first lines only
    )
    third = F.when(F.size("all") >= 3, F.element_at("all", 3)).otherwise(F.element_at("all", 1))
    chosen = F.coalesce("s", "w", "n") if known else F.coalesce("w", third)
    headers = found.select(
        "file_name",
        chosen["line_no"].alias("header_line_no"),
        chosen["sep"].alias("sep"),
        F.transform(chosen["fields"], lambda x: F.trim(x)).alias("header"),
        F.col("s").isNotNull().alias("token_detected"),
        ((F.size(chosen["fields"]) >= 2) & F.exists(chosen["fields"], lambda x: F.trim(x) != "")).alias("valid"),
    )
    small = per_file(headers.select("file_name", "header_line_no", "sep"))
    data = (
        lines.join(small, "file_name")
        .where((F.col("line_no") > F.col("header_line_no")) & (F.trim("line") != ""))
        .select("file_name", "line_no", split_fields(F.col("line"), F.col("sep")).alias("fields"))
    )
    return headers, data


def header_positions(headers: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """C2 in Spark: per file, the 1-based position of the left-most header field
    mapping to each internal name (null when absent)."""
    keyed: dict[str, str] = {}
    for src, target in mapping.items():  # later keys win on a normalised clash
        keyed[normalize_name(src)] = target
    by_target: dict[str, list[str]] = {}
    for k, t in keyed.items():
        by_target.setdefault(t, []).append(k)
    norm = F.transform("header", lambda x: header_key(x))
    idx = F.sequence(F.lit(1), F.greatest(F.size("header"), F.lit(1)))
    cols = []
    for target, keys in by_target.items():
        arr = F.array(*[F.lit(k) for k in keys])
        hits = F.filter(idx, lambda i: F.array_contains(arr, F.element_at(norm, i)))
        cols.append(F.array_min(hits).alias(f"pos_{target}"))
    return headers.select("file_name", *cols)


def mapped_columns(data: DataFrame, positions: DataFrame, targets: list[str]) -> DataFrame:
    """Project split data lines onto internal names (string columns)."""
    j = data.join(per_file(positions), "file_name")
    out = [F.col("file_name"), F.col("line_no")]
    for t in targets:
        pc = f"pos_{t}"
        if pc in positions.columns:
            out.append(F.when(F.col(pc).isNotNull(), F.try_element_at(F.col("fields"), F.col(pc))).alias(t))
    return j.select(*out)


def judge_files(lines: DataFrame, table_key: str, mapping: dict[str, str], *, min_fields: int = 3, min_columns: int = 2,
                required: tuple[str, ...] = ("ticker",)) -> DataFrame:
    """The layout and the verdict of every file, one row each, kept in the
    shared folder: header line, separator, number of columns, position of each
    target (``pos_*``), ``missing`` targets (U1) and ``problem``.

    ``problem`` is null, or why the file cannot be loaded: its reader's own
    (``lines.problem``, as of a broken archive), no usable header (S7d), fewer
    than ``min_columns`` columns or a lack of ``required`` targets (S2).
    """
    headers, _ = normalize_lines(lines.drop("problem"), table_key, min_fields=min_fields)
    layout = headers.join(header_positions(headers, mapping), "file_name")
    names = [c for c in layout.columns if c.startswith("pos_")]
    if "problem" in lines.columns:
        unread = lines.where(F.col("problem").isNotNull())
        layout = layout.join(unread.groupBy("file_name").agg(F.min("problem").alias("unread")), "file_name", "left")
    else:
        layout = layout.withColumn("unread", F.lit(None).cast("string"))
    n_columns = F.coalesce(F.size("header"), F.lit(0))
    missing = F.filter(F.array(*[F.when(F.col(c).isNull(), F.lit(c[4:])) for c in names]), lambda x: x.isNotNull())
    lacking = F.array_intersect(missing, F.array(*map(F.lit, required)))
    problem = F.when(F.col("unread").isNotNull(), F.col("unread")) \
        .when(~F.coalesce("valid", F.lit(False)), F.lit("no usable header")) \
        .when(n_columns < min_columns, F.concat(n_columns.cast("string"), F.lit(f" columns, {min_columns} are needed"))) \
        .when(F.size(lacking) > 0, F.concat(F.lit("no column for "), F.array_join(lacking, ", ")))
    ensure_checkpoint_dir(lines.sparkSession)
    return layout.select("file_name", "header_line_no", "sep", n_columns.alias("n_columns"), missing.alias("missing"), problem.alias("problem"), *names).checkpoint(eager=True)


#: Files that an error message names.
NAMED_FILES = 100


def load_files(lines: DataFrame, table_key: str, mapping: dict[str, str], targets: list[str], *, min_fields: int = 3,
               min_columns: int = 2, required: tuple[str, ...] = ("ticker",), fallback: dict[str, Column] | None = None) -> DataFrame:
    """S1 / S3 / S7 for any number of files: the rows of ``load_good_files``,
    where a file that cannot be loaded is an error, which names the first of
    them and counts all."""
    rows, verdicts = load_good_files(lines, table_key, mapping, targets, min_fields=min_fields, min_columns=min_columns, required=required, fallback=fallback)
    bad = verdicts.where(F.col("problem").isNotNull())
    if failed := bad.count():
        named = [f"{r.file_name} ({r.problem})" for r in bad.orderBy("file_name").limit(NAMED_FILES).collect()]
        raise ValueError(f"{failed} {table_key} file(s) without a usable header: {named}{' ...' if failed > NAMED_FILES else ''}")
    return rows


def load_good_files(lines: DataFrame, table_key: str, mapping: dict[str, str], targets: list[str], *, min_fields: int = 3, min_columns: int = 2,
                    required: tuple[str, ...] = ("ticker",), fallback: dict[str, Column] | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows, verdicts) of any number of files in one load.

    The files are scanned once; headers and data are told apart on the kept
    lines.  ``verdicts`` is the table of ``judge_files``; ``rows`` holds the
    mapped fields of the files without a problem, so one bad file among many
    keeps none of the others out.  Targets that no file has are left out;
    where a file lacks a target of ``fallback``, its rows get that expression
    (which may use ``file_name``).
    """
    lines = once(lines)
    verdicts = judge_files(lines, table_key, mapping, min_fields=min_fields, min_columns=min_columns, required=required)
    names = [c for c in verdicts.columns if c.startswith("pos_")]
    layout = verdicts.where(F.col("problem").isNull()).drop("problem", "missing", "n_columns")
    present = layout.agg(*[F.count(c).alias(c) for c in names]).first()
    fallback = fallback or {}
    j = lines.drop("problem").join(per_file(layout), "file_name").where((F.col("line_no") > F.col("header_line_no")) & (F.trim("line") != ""))
    fields = j.select("file_name", "line_no", split_fields(F.col("line"), F.col("sep")).alias("fields"), *names)
    out = [F.col("file_name"), F.col("line_no")]
    for t in targets:
        pc = f"pos_{t}"
        value = F.when(F.col(pc).isNotNull(), F.try_element_at(F.col("fields"), F.col(pc))) if pc in names and present[pc] else None
        if t in fallback:
            own = F.col(pc).isNotNull() if pc in names else F.lit(False)
            out.append(F.when(own, value if value is not None else F.lit(None)).otherwise(fallback[t]).alias(t))
        elif value is not None:
            out.append(value.alias(t))
    return fields.select(*out), verdicts
