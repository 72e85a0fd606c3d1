"""Readers on real files with small hand fixtures."""

import time

import pytest
from pyspark.sql import functions as F

from pulsegrid.operators.fit import linear_fit
from pulsegrid.sources import generate as gen
from pulsegrid.sources import text as tx


@pytest.fixture()
def files(tmp_path):
    def write(**named):
        for name, body in named.items():
            (tmp_path / f"{name}.txt").write_bytes(body.encode())
        return str(tmp_path)

    return write


def test_points(spark, files):
    path = files(a="1 2\n3   4\n\t5 6 \r\n", b="x 1\n7\n8 9 10\n1.5d 2\n\ninf -1e3\n")
    good, bad = tx.read_points(spark, path)
    assert sorted(map(tuple, good.collect())) == [(1, 2), (3, 4), (5, 6), (float("inf"), -1000)]
    assert bad.count() == 5
    fit = linear_fit(good.filter("x < 100"), "x", "y").first()
    assert (round(fit["a"], 9), round(fit["b"], 9), fit["n"]) == (1, 1, 3)


def test_line_order_over_many_blocks(spark, files):
    path = files(big="\n".join(f"{i} {i}" for i in range(20000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        lines = tx.read_lines(spark, path)
        assert lines.rdd.getNumPartitions() > 3
        ordered = [int(r["line"].split()[0]) for r in lines.orderBy("file", *tx.LINE_ORDER).collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert ordered == list(range(20000))


@pytest.mark.parametrize("body,words", [("", 0), ("one", 1), ("one\ntwo\n", 2), (" a\tb\n\nc d\x0be\n", 5)])
def test_words(spark, files, body, words):
    lines = tx.read_lines(spark, files(w=body))
    assert tx.words_of(lines, "file", "line").count() == words


def test_long_word_is_rejected_whole(spark):
    df = spark.createDataFrame([(1, "a " + "x" * 255 + " " + "y" * 256 + " z")], "doc long, text string")
    got = {r["pos"]: r["rejected"] for r in tx.tokenize(df, "doc", "text").collect()}
    assert got == {0: False, 1: False, 2: True, 3: False}


MATRICES = dict(
    ok="# comment\n 3 4\n -20 55 -10 0 \n -10 -10 50 200 \n 30 -20 -10 0 \n",
    crlf="# one\r\n# two\r\n2  3\r\n1 2 3\r\n4 5 6\r\n",
    many_cols="3 4\n 1 2 3 4\n 1 2 3 4 5\n 1 2 3 4\n",
    many_rows="2 3\n1 2 3\n4 5 6\n7 8 9\n",
    bad_header="three 4\n1 2 3 4\n",
    few_cols="3 4\n-3 9 1 -5\n-2 6 -8\n-4 12 1 -9\n",
    few_rows="3 4\n1 2 3 4\n5 6 7 8\n",
    not_square="3 5\n1 2 3 4\n",
    only_comments="# nothing\n# here\n",
    trailing_blank="1 2\n1 2\n\n  \n",
    early_blank="2 3\n1 2 3\n\n4 5 6\n",
)
REASONS = dict(ok=0, crlf=0, many_cols=4, many_rows=6, bad_header=20, few_cols=5, few_rows=7, not_square=4,
               only_comments=97, trailing_blank=0, early_blank=5)


@pytest.mark.parametrize("max_rows", [None, 2])
def test_matrices(spark, files, max_rows):
    lines = tx.read_lines(spark, files(**MATRICES))
    cells, verdict = tx.validate_matrices(lines, max_rows=max_rows)
    got = {r["file"].rsplit("/", 1)[1][:-4]: r["reason"] for r in verdict.collect()}
    assert got == REASONS
    ok = cells.filter(F.col("file").endswith("/ok.txt")).orderBy("row", "col").collect()
    assert [r["val"] for r in ok] == [-20, 55, -10, 0, -10, -10, 50, 200, 30, -20, -10, 0]
    assert {r["file"].rsplit("/", 1)[1] for r in cells.select("file").distinct().collect()} == {
        "ok.txt", "crlf.txt", "trailing_blank.txt"}


def test_coeffs(spark, files):
    got = tx.read_coeffs(spark, files(c="1 0 1\n0 -9 3 5 -3\n0 0.5 0\n0 0\n3 abc 5\n")).orderBy(*tx.LINE_ORDER).collect()
    assert [r["coefs"] for r in got] == [[1, 0, 1], [-9, 3, 5, -3], [0.5, 0], [], None]
    assert [r["rejected"] for r in got] == [False] * 4 + [True]


def test_matrix_with_a_word_and_an_empty_file(spark, files):
    lines = tx.read_lines(spark, files(a="1 2\nabc 4\n", b="1 2\n3 4\n"))
    names = lines.select("file").distinct().union(spark.createDataFrame([("none.txt",)], "file string"))
    cells, verdict = tx.validate_matrices(lines, files=names)
    found = {r["file"].rsplit("/", 1)[-1]: (r["reason"], r["why"]) for r in verdict.collect()}
    assert found == {"a.txt": (21, "unreadable number"), "b.txt": (0, "ok"), "none.txt": (97, "no dimensions")}
    assert [r["val"] for r in cells.collect()] == [3, 4]


def test_very_many_numbers_on_a_line(spark):
    line = " ".join(str(i) for i in range(100_000))
    df = spark.createDataFrame([(line,), (line + " x 1",), ("1-2" * 5000,)], "line string")
    assert [r["n"] for r in tx.extract_numbers(df, "line").collect()] == [100_000, 100_000, 5_001]


@pytest.mark.parametrize("line,values", [
    ("1 2 3", [1, 2, 3]), ("4    5 6    7     ", [4, 5, 6, 7]), ("8 9\r", [8, 9]), ("", []), ("x 1", []),
    ("1 -2.5e1abc 7", [1, -25]), (".5 +3.", [0.5, 3]), ("1-2", [1, -2]), ("3\n4", [3]),
])
def test_numbers(spark, line, values):
    row = tx.extract_numbers(spark.createDataFrame([(line,)], "line string"), "line").first()
    assert row["values"] == values and row["n"] == len(values)


LOG = """-------------- hw_1  x1, no move
Elapsed CPU Time DataTimer = 6.66 seconds
Elapsed CPU Time per Iteration (DataTimer, 400) = 1.665000e-02 seconds
some noise
Elapsed CPU Time DataTimer = 6.61 seconds
Elapsed CPU Time DataTimer = 6.62 seconds
-------------- hw_2  x2
Elapsed CPU Time DataTimer = 13.67 seconds
"""


def test_timing_log(spark, files):
    parsed = tx.parse_timing_log(tx.read_lines(spark, files(log=LOG)))
    first = parsed.orderBy(*tx.LINE_ORDER).first()
    assert (first["config"], first["timer"], first["seconds"]) == ("hw_1", "DataTimer", 6.66)
    means = {(r["config"], r["iterations"]): (r["repeats"], round(r["mean_seconds"], 6))
             for r in tx.bench_summary(parsed).collect()}
    assert means == {("hw_1", None): (3, 6.63), ("hw_1", 400): (1, 0.01665), ("hw_2", None): (1, 13.67)}


def test_range_and_report(spark, tmp_path):
    made = gen.range_generate(spark, 1003, 4)
    assert made.rdd.getNumPartitions() == 4
    assert tuple(gen.range_verify(made).first()) == (1003, 0)
    progress = gen.segment_progress(made, "id", 1003, 5).groupBy("segment").agg(
        F.sum("rows").alias("n"), F.max("percent").alias("p")).orderBy("segment").collect()
    assert [r["n"] for r in progress] == [201, 201, 201, 201, 199]
    assert {r["p"] for r in progress} == {100}
    lines = gen.render_report(made.filter("id = 11"), [("%d is 0x%s", ["v", gen.hex_text("v")])])
    gen.write_report(lines, str(tmp_path / "report"))
    assert [r["value"] for r in spark.read.text(str(tmp_path / "report")).collect()] == ["44 is 0x2c"]


def test_uniform_is_stable_under_repartition(spark):
    df = spark.range(2000)
    one = gen.bounded_uniform(df, "id", 5, 14).collect()
    two = gen.bounded_uniform(df.repartition(7), "id", 5, 14).orderBy("id").collect()
    assert sorted(one) == sorted(two)
    assert {r["u"] for r in one} == set(range(5, 15))


def test_numbers_after_very_long_blanks(spark):
    """In time that grows with the length, wherever the blanks are."""
    lines = [" " * 1_000_000 + "x", " " * 1_000_000 + "5 x", "\t " * 500_000 + "1\t" * 5, "1 " * 100_000 + "z", "5-LOW 3", "1-2 .5e3x"]
    df = spark.createDataFrame(list(enumerate(lines)), "id long, line string").repartition(1)
    begun = time.perf_counter()
    rows = {r["id"]: r for r in tx.extract_numbers(df, "line").collect()}
    assert time.perf_counter() - begun < 60
    assert [rows[i]["n"] for i in range(6)] == [0, 1, 5, 100_000, 1, 3]
    assert rows[5]["values"] == [1.0, -2.0, 500.0]
