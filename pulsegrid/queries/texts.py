"""Sources, sinks and word search."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import queueing as qu
from ..operators import search
from ..session import workspace
from ..sources import generate as gen
from ..sources import text as tx
from .registry import EV, query

# ----------------------------------------------------------------------------- points


@query("s1_read_points", """
SELECT l_orderkey, l_linenumber,
       CASE WHEN l_linenumber < 6 THEN l_quantity END AS x,
       CASE WHEN l_linenumber < 6 THEN l_extendedprice END AS y,
       l_linenumber >= 6 AS rejected
FROM lineitem
""")
def read_points(t):
    """Line items written as two-column text; some lines are short of a number or too long."""
    line = (
        F.when(F.col("l_linenumber") == 7, F.format_string("%s  n/a", F.col("l_quantity").cast("string")))
        .when(F.col("l_linenumber") == 6, F.concat_ws(" ", "l_quantity", "l_extendedprice", "l_tax"))
        .otherwise(F.concat(F.lit(" \t"), F.col("l_quantity").cast("string"), F.lit("   "),
                            F.col("l_extendedprice").cast("string"), F.lit("\r")))
    )
    lines = t.lineitem.select("l_orderkey", "l_linenumber", line.alias("line"))
    return tx.parse_points(lines).select("l_orderkey", "l_linenumber", "x", "y", "rejected")


# ----------------------------------------------------------------------------- words

WORDS = r"""
words AS (
  SELECT doc_id, unnest(w) AS word, unnest(range(len(w))) AS pos FROM (
    SELECT doc_id, CASE WHEN s = '' THEN [] ELSE regexp_split_to_array(s, '[ \t\n\x0B\f\r]+') END AS w FROM (
      SELECT doc_id, regexp_replace(text, '^[ \t\n\x0B\f\r]+|[ \t\n\x0B\f\r]+$', '', 'g') AS s FROM documents)))
"""


@query("s2_tokenize", f"""
WITH {WORDS}
SELECT doc_id, count(*) FILTER (length(word) < 256) AS words,
       count(*) FILTER (length(word) >= 256) AS rejected,
       CAST(sum(length(word)) AS BIGINT) AS chars, max(pos) AS last_pos
FROM words GROUP BY doc_id
""")
def tokenize(t):
    tokens = tx.tokenize(t.documents, "doc_id", "text")
    return tokens.groupBy("doc_id").agg(
        F.count(F.when(~F.col("rejected"), 1)).alias("words"),
        F.count(F.when(F.col("rejected"), 1)).alias("rejected"),
        F.sum(F.length("word")).alias("chars"),
        F.max("pos").cast("long").alias("last_pos"),
    )


@query("s2_tokenize_short", f"""
WITH {WORDS}
SELECT word, count(*) AS n, count(DISTINCT doc_id) AS docs, length(word) >= 8 AS rejected
FROM words GROUP BY word
""")
def tokenize_short(t):
    """A low length limit, so that rejection has work to do."""
    tokens = tx.tokenize(t.documents, "doc_id", "text", max_len=8)
    per_doc = tokens.groupBy("word", "rejected", "doc_id").agg(F.count(F.lit(1)).alias("n"))
    return per_doc.groupBy("word", "rejected").agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("docs")
    )


@query("a8_row_count", f"WITH {WORDS} SELECT count(*) AS n FROM words")
def row_count(t):
    return qu.row_count(tx.words_of(t.documents, "doc_id", "text"))


@query("f3_find_exact", f"""
WITH {WORDS}
SELECT doc_id, pos, word FROM words WHERE word = 'the' ORDER BY doc_id, pos LIMIT 1
""")
def find_exact(t):
    words = tx.words_of(t.documents, "doc_id", "text")
    found = search.find_exact(words, "word", "the", ["doc_id", "pos"])
    return found.withColumn("pos", F.col("pos").cast("long"))


BENCH_WORDS = r"""
asked AS (
  SELECT DISTINCT unnest(regexp_split_to_array(s, '[ \t\n\x0B\f\r]+')) AS word FROM (
    SELECT regexp_replace(text, '^[ \t\n\x0B\f\r]+|[ \t\n\x0B\f\r]+$', '', 'g') AS s FROM benchmark)
  WHERE s <> '')
"""


@query("j3_word_hits", f"""
WITH {WORDS}, {BENCH_WORDS}
SELECT word, word IN (SELECT word FROM words) AS found FROM asked
""")
def word_hits(t):
    return search.word_hits(tx.words_of(t.documents, "doc_id", "text"),
                            tx.words_of(t.benchmark, "item_id", "text"))


@query("j3_occurring", f"""
WITH {WORDS}, {BENCH_WORDS} SELECT word FROM asked WHERE word IN (SELECT word FROM words)
""")
def occurring(t):
    return search.occurring(tx.words_of(t.documents, "doc_id", "text"), tx.words_of(t.benchmark, "item_id", "text"))


@query("j3_missing", f"""
WITH {WORDS}, {BENCH_WORDS} SELECT word FROM asked WHERE word NOT IN (SELECT word FROM words)
""")
def missing(t):
    return search.missing(tx.words_of(t.documents, "doc_id", "text"), tx.words_of(t.benchmark, "item_id", "text"))


# ----------------------------------------------------------------------------- matrices


def matrix_lines(t):
    """Three orders make a matrix file; by file number it is well formed or wrong in one way."""
    key = F.col("o_orderkey")
    file = F.floor(key / 3).cast("long")
    r, kind = key % 3, F.floor(key / 3) % 7
    cents = F.round(F.col("o_totalprice") * 100).cast("long")
    row = F.concat_ws("\t ", F.lit(" "), *[c.cast("string") for c in (F.col("o_custkey"), key, cents)])
    row = F.concat(row, F.lit("  "), r.cast("string"), F.lit(" \r"))
    row = F.when((kind == 1) & (r == 1), F.concat(row, F.lit(" 5"))).when(
        (kind == 2) & (r == 1), F.lit("7 8 9")
    ).otherwise(row)
    header = F.when(kind == 0, "3 5").when(kind == 5, "three 4").otherwise(" 3  4")
    lines = F.array_compact(F.array(
        F.when(r == 0, F.lit("# made of three orders")),
        F.when(r == 0, header),
        F.when(~((kind == 4) & (r == 2)), row),
        F.when((kind == 3) & (r == 2), row),
        F.when((r == 2) & (kind == 6), F.lit("  ")),
    ))
    return t.orders.select(file.alias("file"), key.alias("block"), F.posexplode(lines).alias("pos", "line"))


VERDICT = """
SELECT file,
  CASE kind WHEN 0 THEN 4 WHEN 1 THEN 4 WHEN 2 THEN 5 WHEN 3 THEN 6 WHEN 4 THEN 7 WHEN 5 THEN 20 ELSE 0 END AS reason,
  CASE kind WHEN 0 THEN 'too many columns' WHEN 1 THEN 'too many columns' WHEN 2 THEN 'not enough columns'
    WHEN 3 THEN 'too many rows' WHEN 4 THEN 'not enough rows' WHEN 5 THEN 'unreadable dimensions' ELSE 'ok' END AS why,
  CASE WHEN kind <> 5 THEN 3 END AS rows,
  CASE WHEN kind = 0 THEN 5 ELSE 4 END AS cols,
  n + CASE kind WHEN 3 THEN 1 WHEN 4 THEN -1 ELSE 0 END AS seen_rows
FROM (SELECT o_orderkey // 3 AS file, (o_orderkey // 3) % 7 AS kind, count(*) AS n FROM orders GROUP BY ALL)
"""

CELLS = """
SELECT o_orderkey // 3 AS file, o_orderkey % 3 + 1 AS row, unnest([1, 2, 3, 4]) AS col,
  CAST(unnest([o_custkey, o_orderkey, CAST(round(o_totalprice * 100) AS BIGINT), o_orderkey % 3]) AS DOUBLE) AS val
FROM orders WHERE (o_orderkey // 3) % 7 = 6
"""


@query("s3_validate_matrices", VERDICT)
def validate_matrices(t):
    return tx.validate_matrices(matrix_lines(t))[1]


@query("s3_matrix_cells", CELLS)
def matrix_cells(t):
    return tx.validate_matrices(matrix_lines(t))[0]


@query("s3_validate_matrices_cut", VERDICT)
def validate_matrices_cut(t):
    """The same with files cut into segments of a few lines."""
    return tx.validate_matrices(matrix_lines(t), max_rows=4)[1]


@query("s3_unreadable_matrices", """
SELECT file, CASE WHEN file % 3 = 0 THEN 97 WHEN file % 3 = 1 THEN 21 ELSE 0 END AS reason,
  CASE WHEN file % 3 = 0 THEN 'no dimensions' WHEN file % 3 = 1 THEN 'unreadable number' ELSE 'ok' END AS why,
  CASE WHEN file % 3 > 0 THEN 1 END AS rows, CASE WHEN file % 3 > 0 THEN 2 END AS cols,
  CASE WHEN file % 3 > 0 THEN 1 ELSE 0 END AS seen_rows
FROM (SELECT o_orderkey AS file FROM orders)
""")
def unreadable_matrices(t):
    """One file per order: empty, with a word among its numbers, or good."""
    file = F.col("o_orderkey")
    row = F.concat_ws(" ", F.col("o_custkey").cast("string"), F.when(file % 3 == 1, "abc").otherwise("4"))
    lines = t.orders.filter(file % 3 > 0).select(
        file.alias("file"), F.lit(0).alias("block"), F.posexplode(F.array(F.lit("1 2"), row)).alias("pos", "line"))
    return tx.validate_matrices(lines, files=t.orders.select(file.alias("file")))[1]


# ----------------------------------------------------------------------------- files


def written(t, name, lines):
    """Lines as text files in the shared folder, and their path."""
    path = workspace(t.spark, name)
    gen.write_report(lines, path)
    return path


@query("s1_read_points_files", """
SELECT l_quantity AS x, l_extendedprice AS y, count(*) AS n FROM lineitem WHERE l_linenumber < 6 GROUP BY ALL
UNION ALL SELECT NULL, NULL, count(*) FROM lineitem WHERE l_linenumber >= 6 HAVING count(*) > 0
""")
def read_points_files(t):
    """Points written to files and read again; the rejected lines are one row."""
    line = F.concat_ws(" ", "l_quantity", F.when(F.col("l_linenumber") < 6, F.col("l_extendedprice").cast("string"))
                       .otherwise("n/a"))
    good, bad = tx.read_points(t.spark, written(t, "points", t.lineitem.select(line.alias("line"))))
    rows = good.unionByName(bad.select(F.lit(None).cast("double").alias("x"), F.lit(None).cast("double").alias("y")))
    return rows.groupBy("x", "y").agg(F.count(F.lit(1)).alias("n"))


@query("s4_read_coeffs_files", """
SELECT p_size % 4 = 0 AS rejected, count(*) AS n, CASE WHEN p_size % 4 > 0 THEN round(sum(p_retailprice), 2) END AS total
FROM part GROUP BY p_size % 4 = 0, CASE WHEN p_size % 4 > 0 THEN 1 END, p_size % 4 > 0
""")
def read_coeffs_files(t):
    """Coefficients written to files and read again."""
    line = F.concat_ws(" ", F.lit("0"), F.col("p_retailprice").cast("string"), F.when(F.col("p_size") % 4 == 0, "x"))
    rows = tx.read_coeffs(t.spark, written(t, "coefficients", t.part.select(line.alias("line"))))
    return rows.groupBy("rejected").agg(F.count(F.lit(1)).alias("n"),
                                        F.round(F.sum(F.get("coefs", F.lit(0))), 2).alias("total"))


@query("s3_read_matrix_file", """
WITH cells AS (SELECT l_orderkey // 1000 AS matrix, l_linenumber AS i, count(*) AS n, count(*) FILTER (l_suppkey % 8 = 0) AS first
  FROM lineitem GROUP BY ALL)
SELECT matrix, CASE WHEN count(*) < 7 THEN 7 ELSE 0 END AS reason, CASE WHEN count(*) < 7 THEN 'not enough rows' ELSE 'ok' END AS why,
  7 AS rows, 8 AS cols, count(*) AS seen_rows, CASE WHEN count(*) = 7 THEN sum(n)::DOUBLE END AS total,
  CASE WHEN count(*) = 7 THEN sum(first)::DOUBLE END AS first
FROM cells GROUP BY matrix
""")
def read_matrix_file(t):
    """A matrix for each thousand orders, in a file of its own: a row per line number, line items counted by supplier."""
    counts = [F.count(F.when(F.col("l_suppkey") % 8 == k, 1)).cast("string") for k in range(8)]
    body = t.lineitem.groupBy(F.expr("l_orderkey div 1000").alias("matrix"), F.col("l_linenumber").cast("int").alias("i")).agg(
        F.concat_ws(" ", *counts).alias("line"))
    head = body.select("matrix", F.lit(0).alias("i"), F.lit("7 8").alias("line")).distinct()
    path = workspace(t.spark, "matrices")
    lines = head.unionByName(body).repartition("matrix").sortWithinPartitions("matrix", "i")
    lines.select("matrix", F.col("line").alias("value")).write.partitionBy("matrix").text(path)
    cells, verdict = tx.validate_matrices(tx.read_lines(t.spark, path))
    totals = cells.groupBy("file").agg(F.sum("val").alias("total"), F.sum(F.when(F.col("col") == 1, F.col("val"))).alias("first"))
    matrix = F.regexp_extract("file", "matrix=([0-9]+)", 1).cast("long")
    return verdict.join(totals, "file", "left").withColumn("matrix", matrix).drop("file")


# ----------------------------------------------------------------------------- coefficients, numbers


@query("s4_read_coeffs", """
WITH p AS (
  SELECT p_partkey,
    list_concat(CASE WHEN p_size % 3 = 0 THEN [0.0e0] ELSE [] END,
                CASE WHEN p_size % 2 = 0 THEN [0.0e0] ELSE [] END,
                [CAST(p_size - 25 AS DOUBLE), 0.5e0, CAST(p_size AS DOUBLE), p_retailprice]) AS c FROM part),
q AS (SELECT p_partkey, c[list_position(list_transform(c, lambda v: abs(v) > 1e-8), true):] AS c FROM p)
SELECT p_partkey, p_partkey % 5 = 0 AS rejected, CASE WHEN p_partkey % 5 > 0 THEN CAST(len(c) AS INTEGER) END AS n,
  CASE WHEN p_partkey % 5 > 0 THEN c[1] END AS lead, CASE WHEN p_partkey % 5 > 0 THEN round(list_sum(c), 4) END AS total FROM q
""")
def read_coeffs(t):
    zero = F.lit("0")
    line = F.concat_ws(
        " ", F.when(F.col("p_size") % 3 == 0, zero), F.when(F.col("p_size") % 2 == 0, F.lit("0.0")),
        (F.col("p_size") - 25).cast("string"), F.lit("0.5"), F.col("p_size").cast("string"),
        F.col("p_retailprice").cast("string"), F.when(F.col("p_partkey") % 5 == 0, F.lit("abc")),
    )
    coefs = t.part.select("p_partkey", tx.parse_coeffs(line).alias("c"))
    return coefs.select(
        "p_partkey", F.col("c").isNull().alias("rejected"), F.when(F.col("c").isNotNull(), F.size("c")).alias("n"), F.get("c", F.lit(0)).alias("lead"),
        F.round(F.aggregate("c", F.lit(0.0), lambda a, v: a + v), 4).alias("total"),
    )


@query("s5_extract_numbers", """
SELECT o_orderkey, 4 AS n,
  round(o_orderkey + o_custkey + o_totalprice + CAST(left(o_orderpriority, 1) AS INTEGER), 2) AS total
FROM orders
""")
def extract_numbers(t):
    """A priority such as ``5-LOW`` gives 5 and ends the numbers; the line break hides the rest."""
    line = F.concat(F.concat_ws("  ", *[F.col(c).cast("string") for c in
                                        ("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority")]),
                    F.lit(" 12\r\n99"))
    found = tx.extract_numbers(t.orders.select("o_orderkey", line.alias("line")), "line")
    total = F.aggregate("values", F.lit(0.0), lambda a, v: a + v)
    return found.select("o_orderkey", "n", F.round(total, 2).alias("total"))


@query("s5_extract_numbers_documents", r"""
WITH l AS (SELECT doc_id, regexp_extract(text, '^[^\r\n]*') AS line FROM documents),
r AS (SELECT doc_id, regexp_extract(line, '^([ \t\x0B\f]*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?)*') AS run FROM l)
SELECT doc_id, CAST(len(regexp_extract_all(run, '[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?')) AS INTEGER) AS n FROM r
""")
def extract_numbers_documents(t):
    return tx.extract_numbers(t.documents, "text").select("doc_id", "n")


# ----------------------------------------------------------------------------- timing logs


def log_lines(t):
    """A timing log made of events: sign-ups are headers, purchases per-iteration lines, errors noise."""
    text = F.col("value").cast("string")
    kind = F.col("event_type")
    line = (
        F.when(kind == "signup", F.concat(F.lit("-------------- run"), (F.col("event_id") % 5).cast("string"),
                                          F.lit("  x1, no move")))
        .when(kind == "purchase", F.concat(F.lit("Elapsed CPU Time per Iteration (payTimer, 400) = "), text,
                                           F.lit("e-02 seconds")))
        .when(kind == "error", F.concat(F.lit("Y = "), text, F.lit(" * X + ")))
        .otherwise(F.concat(F.lit("Elapsed CPU Time "), kind, F.lit("Timer = "), text, F.lit(" seconds")))
    )
    return t.ev.select((F.col("user_id") % 4).alias("file"), "event_id", line.alias("line"))


LOG = f"""
WITH {EV}, l AS (
  SELECT event_id, user_id % 4 AS file, event_type,
    last_value(CASE WHEN event_type = 'signup' THEN 'run' || (event_id % 5) END IGNORE NULLS) OVER (
      PARTITION BY user_id % 4 ORDER BY event_id) AS config,
    CASE event_type WHEN 'purchase' THEN 'payTimer' ELSE event_type || 'Timer' END AS timer,
    CASE event_type WHEN 'purchase' THEN 400 END::BIGINT AS iterations,
    CASE event_type WHEN 'purchase' THEN CAST(value || 'e-02' AS DOUBLE) ELSE value END AS seconds FROM ev),
parsed AS (SELECT * FROM l WHERE event_type IN ('purchase', 'click', 'view'))
"""


@query("s6_parse_timing_log", LOG + "SELECT file, event_id, config, timer, iterations, seconds FROM parsed")
def parse_timing_log(t):
    return tx.parse_timing_log(log_lines(t), order="event_id")


@query("s6_parse_timing_log_cut", LOG + "SELECT file, event_id, config, timer, iterations, seconds FROM parsed")
def parse_timing_log_cut(t):
    return tx.parse_timing_log(log_lines(t), order="event_id", max_rows=500)


@query("a10_bench_summary", LOG + """
SELECT config, timer, iterations, count(*) AS repeats, round(avg(seconds), 6) AS mean_seconds
FROM parsed GROUP BY config, timer, iterations
""")
def bench_summary(t):
    parsed = tx.parse_timing_log(log_lines(t), order="event_id")
    return tx.bench_summary(parsed).withColumn("mean_seconds", F.round("mean_seconds", 6))


# ----------------------------------------------------------------------------- generators and report


@query("s7_range_generate", """
SELECT o_orderkey AS id, 4 * o_orderkey AS v FROM orders
""")
def range_generate(t):
    """A value for every order."""
    return gen.range_values(t.orders, "o_orderkey")


@query("s7_range_verify", """
SELECT count(*) AS n, count(*) FILTER (o_orderkey % 100 = 99) AS mismatches FROM orders
""")
def range_verify(t):
    """Order keys as a sequence, with one value in a hundred spoiled."""
    spoiled = F.when(F.col("o_orderkey") % 100 == 99, 1).otherwise(0)
    return gen.range_verify(t.orders.select(F.col("o_orderkey").alias("id"),
                                            (F.col("o_orderkey") * 4 + spoiled).alias("v")))


@query("s8_bounded_uniform", """
WITH d AS (SELECT o_orderkey, CAST('0x' || left(md5(o_orderkey || '|42'), 15) AS BIGINT) AS x FROM orders)
SELECT o_orderkey, x % 31 + 50 AS u, (x % 1001 - 500) / 10.0e0 AS d FROM d
""")
def bounded_uniform(t):
    drawn = gen.bounded_decimal(gen.bounded_uniform(t.orders, "o_orderkey", 50, 80), "o_orderkey", name="d")
    return drawn.select("o_orderkey", "u", "d")


@query("s9_render_report", """
SELECT p_partkey, unnest([0, 1]) AS line_no,
  unnest(['Part ' || p_partkey || ' size: ' || p_size || ' 0x' || lower(to_hex(p_size)),
          'Part ' || p_partkey || ' price: ' || printf('%.2f', p_retailprice) || ' minutes']) AS line
FROM part
""")
def render_report(t):
    return gen.render_report(
        t.part,
        [("Part %d size: %d 0x%s", ["p_partkey", "p_size", gen.hex_text("p_size")]),
         ("Part %d price: %.2f minutes", ["p_partkey", "p_retailprice"])],
        keep=["p_partkey"],
    )


@query("a13_segment_progress", """
WITH n AS (SELECT count(*) AS n, CAST(ceil(count(*) / 5.0) AS BIGINT) AS size FROM orders),
s AS (SELECT o_orderkey // size AS segment, o_orderkey % size AS place,
             least(size, n - (o_orderkey // size) * size) AS segment_rows FROM orders, n)
SELECT segment, place * 10 // segment_rows AS step, segment_rows, count(*) AS rows,
       (place * 10 // segment_rows + 1) * 10 AS percent
FROM s GROUP BY ALL
""")
def segment_progress(t):
    return gen.segment_progress(t.orders, "o_orderkey", t.orders.count(), 5)
