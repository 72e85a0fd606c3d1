"""Readers for the delimited-text inputs: points, words, matrices, coefficients, logs.

Each reader is a parse step over a DataFrame of lines, so it works the same on
``read_lines(path)`` and on any other column of text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import TOLERANCE, col
from ..plans import ordered as od

_WORD = r"[^ \t\n\x0B\f\r]+"


def read_lines(spark: SparkSession, path) -> DataFrame:
    """(file, block, pos, line): ``block, pos`` gives the line order within a file.

    A large file is read in many blocks by many tasks; the byte offset of the block
    and the position inside the task put the lines back in order.
    """
    raw = spark.read.text(path)
    return raw.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("pos"),
        F.col("value").alias("line"),
    )


LINE_ORDER = ["block", "pos"]


def fields(text) -> Column:
    """The whitespace-separated fields of a text, in one pass; an empty array for a blank one."""
    return F.regexp_extract_all(col(text), F.lit(_WORD), F.lit(0))


def number(text: Column) -> Column:
    """A text as a double, or null. A Java type suffix such as ``1.5d`` is no number."""
    suffixed = F.right(text, F.lit(1)).isin("d", "D", "f", "F") & ~F.lower(text).endswith("inf")
    return F.when(~suffixed, text.try_cast("double"))


# ----------------------------------------------------------------------------- points


def parse_points(lines: DataFrame, line: str = "line") -> DataFrame:
    """``x`` and ``y`` of a two-column line; ``rejected`` where they are not two numbers."""
    # plain string steps instead of patterns: this runs once per line of input
    blank = F.btrim(F.translate(col(line), "\t\n\x0b\f\r", "     "))
    first = F.substring_index(F.col("_t"), " ", 1)
    x = number(first)
    y = number(F.ltrim(F.substr(F.col("_t"), F.length(first) + 1)))
    ok = F.col("_x").isNotNull() & F.col("_y").isNotNull()
    return (
        lines.withColumn("_t", blank)
        .withColumns({"_x": x, "_y": y})
        .withColumns({"x": F.when(ok, F.col("_x")), "y": F.when(ok, F.col("_y")), "rejected": ~ok})
        .drop("_t", "_x", "_y")
    )


def read_points(spark: SparkSession, path) -> tuple[DataFrame, DataFrame]:
    """Points (x, y) and the rejected lines."""
    parsed = parse_points(read_lines(spark, path))
    good = parsed.filter(~F.col("rejected")).select("x", "y")
    return good, parsed.filter("rejected").select("file", *LINE_ORDER, "line")


# ----------------------------------------------------------------------------- words


def tokenize(df: DataFrame, doc: str, text: str, max_len: int = 256) -> DataFrame:
    """(doc, pos, word, rejected): one row per token; tokens of ``max_len`` or more are rejected whole."""
    # the outer form keeps Spark from splitting every text twice, once to test for words
    tokens = df.select(doc, F.posexplode_outer(fields(text)).alias("pos", "word"))
    return tokens.filter(F.col("word").isNotNull()).withColumn("rejected", F.length("word") >= max_len)


def words_of(df: DataFrame, doc: str, text: str) -> DataFrame:
    """(doc, pos, word): every word, however long."""
    return tokenize(df, doc, text).drop("rejected")


# ----------------------------------------------------------------------------- matrices

# Reasons of a malformed matrix file.
REASONS: dict[int, str] = {
    0: "ok",
    4: "too many columns",
    5: "not enough columns",
    6: "too many rows",
    7: "not enough rows",
}
# reasons of our own
REASONS |= {20: "unreadable dimensions", 21: "unreadable number", 97: "no dimensions"}


def _dimension(i: int) -> Column:
    return F.regexp_extract(F.get("_f", F.lit(i)), r"^\+?(\d+)", 1).try_cast("int")


def validate_matrices(lines: DataFrame, file: str = "file", order=LINE_ORDER, line: str = "line",
                      split=None, max_rows: int | None = None,
                      files: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Cells (file, row, col, val) of the good files, and (file, reason, why, ...) for every file.

    The reason is that of the first offending line. A blank line counts as a short
    row, unless every declared row came before it. All steps share one ordering of
    the lines of a file, so there is no join and a very large file is cut.
    An empty file has no line: it is judged only if ``files``, a table with the column
    ``file``, names it.
    """
    split = split or od.measure(lines, file, order, max_rows)
    body = ~F.col(line).startswith("#")
    numbered = od.scan(lines, file, order, split, _n=od.running_sum(F.when(body, 1)))
    numbered = numbered.withColumn("_f", F.when(body, fields(line)))
    header = body & (F.col("_n") == 1)
    numbered = od.scan(
        numbered, file, order, split,
        _dim=od.last_value(F.when(header, F.struct(_dimension(0).alias("rows"), _dimension(1).alias("cols")))),
    )
    width, row = F.size("_f"), (F.col("_n") - 1).cast("long")
    rows, cols = F.col("_dim.rows"), F.col("_dim.cols")
    # blank lines after the last declared row are no rows
    is_row = body & (F.col("_n") > 1) & ~((width == 0) & (row > rows))
    unreadable = F.exists("_f", lambda f: number(f).isNull())
    wrong = F.when(is_row, F.when(width > cols, 4).when(width < cols, 5).when(row > rows, 6).when(unreadable, 21))
    numbered = numbered.withColumns({
        "rows": rows,
        "cols": cols,
        "row": F.when(is_row, row),
        "_wrong": F.when(wrong.isNotNull(), F.struct(row.alias("at"), wrong.alias("code"))),
    })

    def reason(has, n_rows, n_cols, first_wrong, seen) -> Column:
        return (
            F.when(~has, 97)
            .when(n_rows.isNull() | n_cols.isNull(), 20)
            .when(n_cols != n_rows + 1, 4)
            .when(first_wrong.isNotNull(), first_wrong["code"])
            .when(F.coalesce(seen, F.lit(0)) < n_rows, 7)
            .otherwise(0)
        )

    verdict = (
        numbered.groupBy(file)
        .agg(
            F.max("_n").alias("_n"),
            F.max("rows").alias("rows"),
            F.max("cols").alias("cols"),
            F.min("_wrong").alias("_wrong"),
            F.count("row").alias("seen_rows"),
        )
        .withColumn("reason", reason(F.col("_n") > 0, F.col("rows"), F.col("cols"), F.col("_wrong"),
                                     F.col("seen_rows")))
    )
    if files is not None:
        verdict = files.select(file).distinct().join(verdict, file, "left").withColumns({
            "reason": F.coalesce("reason", F.lit(97)), "seen_rows": F.coalesce("seen_rows", F.lit(0).cast("long"))})
    why = F
    for code, words in REASONS.items():
        why = why.when(F.col("reason") == code, words)
    verdict = verdict.select(file, "reason", why.otherwise(F.lit(None)).alias("why"), "rows", "cols",
                             "seen_rows")

    judged = od.scan(numbered, file, order, split,
                     _first=od.whole_min("_wrong"), _seen=od.whole_max("row"))
    good = judged.filter(
        F.col("row").isNotNull()
        & (reason(F.lit(True), F.col("rows"), F.col("cols"), F.col("_first"), F.col("_seen")) == 0)
    )
    cells = good.select(file, "row", F.posexplode("_f").alias("_c", "_t"))
    return cells.select(file, "row", (F.col("_c") + 1).alias("col"), number(F.col("_t")).alias("val")), verdict


# ----------------------------------------------------------------------------- coefficients and numbers


def parse_coeffs(text, tol: float = TOLERANCE) -> Column:
    """The numbers of a line, highest power first, leading zeros stripped; null if a field is no number."""
    values = F.transform(fields(text), number)
    flags = F.transform(values, lambda v: F.abs(v) > tol)
    first = F.array_position(flags, True)
    kept = F.when(first > 0, F.slice(values, first.cast("int"), F.size(values))).otherwise(
        F.array().cast("array<double>")
    )
    return F.when(~F.exists(values, lambda v: v.isNull()), kept)


def read_coeffs(spark: SparkSession, path) -> DataFrame:
    """(file, order, line, coefs, rejected) of every line; ``coefs`` is null on a rejected one."""
    lines = read_lines(spark, path).withColumn("coefs", parse_coeffs("line"))
    return lines.select("file", *LINE_ORDER, "line", "coefs", F.col("coefs").isNull().alias("rejected"))


_NUMBER = r"[+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?"


def leading_numbers(text) -> Column:
    """All numbers a line starts with; the first thing that is no number ends it. CR and LF end the line.

    Every number is put between two marks and the line is cut at the first thing outside of marks, so no
    pattern repeats a group, which would overflow the stack on a long line.
    """
    one_line = F.translate(F.substring_index(F.translate(col(text), "\r", "\n"), "\n", 1), "\x01\x02", "??")
    # blanks are taken from the first of a run and never given back, so long runs cost no more than their length
    marked = F.regexp_replace(one_line, rf"(?<![ \t\x0B\f])[ \t\x0B\f]*+{_NUMBER}", "\x01$0\x02")
    run = F.regexp_replace(marked, r"(?s)(?:^|(?<=\x02))(?!\x01).*$", "")
    found = F.regexp_extract_all(run, F.lit(_NUMBER), F.lit(0))
    return F.transform(found, lambda t: t.cast("double"))


def extract_numbers(df: DataFrame, text: str) -> DataFrame:
    return df.withColumn("values", leading_numbers(text)).withColumn("n", F.size("values"))


# ----------------------------------------------------------------------------- timing logs

_TIMING = (r"^Elapsed CPU Time (?:per Iteration \((\w+), (\d+)\)|(\w+)) = ([0-9.eE+-]+) seconds")
_HEADER = r"^-{5,} *(\S+)"


def parse_timing_log(lines: DataFrame, file: str = "file", order=LINE_ORDER, line: str = "line",
                     split=None, max_rows: int | None = None) -> DataFrame:
    """(file, order, config, timer, iterations, seconds), one row per timing line.

    ``config`` is the latest header line before it. ``iterations`` is null on a total.
    """
    # counted before parsing: all lines of a file are at least as many as its marked ones
    split = split or od.measure(lines, file, order, max_rows)
    text = F.col(line)

    def part(pattern: str, group: int) -> Column:
        return F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))

    timing = text.startswith("Elapsed CPU Time ")
    marked = lines.withColumns({
        "_config": F.when(text.startswith("-----"), part(_HEADER, 1)),
        "timer": F.when(timing, F.coalesce(part(_TIMING, 3), part(_TIMING, 1))),
        "iterations": F.when(timing, part(_TIMING, 2).cast("long")),
        "seconds": F.when(timing, part(_TIMING, 4).try_cast("double")),
    })
    # only headers and timings matter from here on
    marked = marked.filter(F.col("_config").isNotNull() | F.col("timer").isNotNull())
    held = od.scan(marked, file, order, split, config=od.last_value("_config"))
    return held.filter(F.col("timer").isNotNull()).select(
        file, *od.names(order), "config", "timer", "iterations", "seconds"
    )


def bench_summary(parsed: DataFrame) -> DataFrame:
    """Mean over repeats per configuration and timer; totals and per-iteration times apart."""
    return parsed.groupBy("config", "timer", "iterations").agg(
        F.count(F.lit(1)).alias("repeats"), F.avg("seconds").alias("mean_seconds")
    )
