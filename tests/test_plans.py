"""Plans: what is read, how often data moves, and that large keys spread out."""

from pyspark.sql import functions as F

import __spark_entry__ as entry_points
from pulsegrid.operators import states as st
from pulsegrid.plans import ordered as od
from pulsegrid.queries.registry import Tables

FOLDER = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_fit_reads_three_columns_and_moves_once(spark):
    text = plan(entry_points.queries()["a2_linear_fit"](spark, FOLDER))
    assert "ReadSchema: struct<l_quantity:double,l_extendedprice:double,l_returnflag:string>" in text
    assert text.count("Exchange") == 1


def test_filters_reach_the_scan(spark):
    text = plan(entry_points.queries()["f1_band_filter"](spark, FOLDER))
    assert "PushedFilters: [IsNotNull(o_custkey), GreaterThanOrEqual(o_custkey,50), LessThanOrEqual(o_custkey,150)]" in text


def test_chained_scans_share_one_shuffle(spark):
    text = plan(entry_points.queries()["w2_depth_over_time"](spark, FOLDER))
    assert text.count("Exchange hashpartitioning") == 1
    assert text.count("Sort [") == 1


def test_first_rows_are_trimmed_before_they_move(spark):
    text = plan(entry_points.queries()["o5_cap_first"](spark, FOLDER))
    before = text[text.rindex("Exchange"):]
    assert "WindowGroupLimit" in before


def test_a_third_of_all_rows_in_one_key(spark):
    """A hot key is cut, no task gets much more than the limit, and the answer stays the same."""
    df = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 200)).alias("k"),
        F.col("id").alias("ts"),
    ).repartition(6)
    limit = 500
    split = od.measure(df, "k", "ts", limit)
    assert [r["_h0"] for r in split.cuts.collect()] == ["hot"]
    sizes = od.segmented(df, split).groupBy("k", od.SEG).count()
    assert sizes.agg(F.max("count")).first()[0] < 3 * limit
    got = st.debounce(df, "k", "ts", 40, split=split)
    want = st.debounce(df, "k", "ts", 40, split=od.whole("k", "ts"))
    assert got.exceptAll(want).count() == 0 and got.count() == want.count()
    positions = od.scan(df, "k", "ts", split, rn=od.row_number()).filter("k = 'hot'")
    assert positions.filter(F.col("rn") != F.col("ts") / 3 + 1).count() == 0


def test_results_do_not_depend_on_partitioning(spark):
    ev = Tables(spark, FOLDER).ev.select("event_id", "user_id", "tick")
    a = st.debounce(ev, "user_id", "tick", 3_600_000, tie="event_id", max_rows=15)
    b = st.debounce(ev.repartition(7, "tick"), "user_id", "tick", 3_600_000, tie="event_id", max_rows=40)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
