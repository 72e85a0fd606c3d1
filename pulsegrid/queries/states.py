"""Stateful operators in batch and stream form."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.scalars import code_label
from ..operators import signal as sg
from ..operators import states as st
from ..plans import ordered as od
from ..session import workspace
from ..streaming import stateful as ss
from .queues import CLOSING, TOTALS, depths
from .registry import EV, ORACLES, query, with_ticks

GAP = 6 * 3600 * 1000


def live_events(t):
    """The events as a stream of files."""
    return with_ticks(ss.table_stream(t.spark, t.folder, "events", t.events.schema))


SLICES = 6


def feed(rows, by):
    """A table as a feed: a slice of ``by`` after the other is written to a folder, and streamed a half of one at a time.
    Also how late a row can be: a slice's files may come in any order."""
    spark, folder = rows.sparkSession, workspace(rows.sparkSession, "feed")
    lo, hi = rows.agg(F.min(by), F.max(by)).first()
    span = ((hi or 0) - (lo or 0)) // SLICES + 1
    for i in range(SLICES):
        part = F.col(by).between((lo or 0) + i * span, (lo or 0) + (i + 1) * span - 1)
        rows.filter(part).write.mode("append").parquet(folder)
    # as many micro-batches whatever the number of files, until they would be large ones
    where = spark._jvm.org.apache.hadoop.fs.Path(folder)
    size = where.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(where).getLength()
    most = max(1, min(size // (2 * SLICES), 512 << 20))
    return spark.readStream.schema(rows.schema).option("maxBytesPerTrigger", most).parquet(folder), span


def event_feed(t, by="tick"):
    return feed(with_ticks(t.events), by)


# ----------------------------------------------------------------------------- debounce

DEBOUNCE = f"""
WITH RECURSIVE {EV}, e AS (SELECT user_id, tick, min(event_id) AS event_id FROM ev GROUP BY user_id, tick),
d AS (SELECT user_id, min(tick) AS t FROM e WHERE tick >= {GAP} GROUP BY user_id
  UNION ALL SELECT e.user_id, min(e.tick) FROM d JOIN e ON e.user_id = d.user_id AND e.tick >= d.t + {GAP} GROUP BY e.user_id)
SELECT e.event_id, e.user_id, e.tick FROM d JOIN e ON e.user_id = d.user_id AND e.tick = d.t
"""


@query("t3_debounce", DEBOUNCE)
def debounce(t):
    df = t.ev.select("event_id", "user_id", "tick")
    return st.debounce(df, "user_id", "tick", GAP, 0, "event_id")


@query("t3_debounce_cut", DEBOUNCE)
def debounce_cut(t):
    df = t.ev.select("event_id", "user_id", "tick")
    return st.debounce(df, "user_id", "tick", GAP, 0, "event_id", max_rows=20)


@query("t3_debounce_stream", DEBOUNCE)
def debounce_stream(t):
    live = live_events(t).select("event_id", "user_id", "tick")
    return ss.run_to_table(ss.debounce(live, "user_id", "tick", GAP, 0, "event_id"), "debounce")


@query("t3_debounce_live", DEBOUNCE)
def debounce_live(t):
    """On the feed as it comes: a key keeps a slice of rows and its last accepted time, and timers send what is due."""
    live, late = event_feed(t)
    out = ss.debounce(live.select("event_id", "user_id", "tick"), "user_id", "tick", GAP, 0, "event_id", late)
    return ss.run_to_table(out, "debounce")


ONE = DEBOUNCE.replace("user_id, tick, min(event_id)", "0 AS user_id, tick, min(event_id)").replace(
    "GROUP BY user_id, tick)", "GROUP BY tick)").replace("SELECT e.event_id, e.user_id, e.tick", "SELECT e.event_id, e.tick")


@query("t3_debounce_shared", ONE)
def debounce_shared(t):
    """One state for all sources, as on the device: a single group, cut into segments."""
    df = t.ev.select("event_id", "tick")
    return st.debounce(df, [], "tick", GAP, 0, "event_id", max_rows=800)


# ----------------------------------------------------------------------------- frames

MARK_SQL = "CASE event_type WHEN 'click' THEN -1 WHEN 'error' THEN -2 WHEN 'signup' THEN -3 WHEN 'purchase' THEN -4 ELSE cents END"
FRAMES = f"""
{EV}, m AS (SELECT user_id, event_id, {MARK_SQL} AS v FROM ev),
s AS (SELECT *, CAST(sum(CASE WHEN v < 0 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS BIGINT)
  - CASE WHEN v < 0 THEN 1 ELSE 0 END AS frame_id FROM m),
c AS (SELECT user_id, frame_id, min(v) AS close, count(*) FILTER (v >= 0) AS n FROM s GROUP BY user_id, frame_id
  HAVING min(v) = -4 OR (min(v) = -2 AND count(*) FILTER (v >= 0) >= 2)),
rows AS (SELECT user_id, frame_id, row_number() OVER (PARTITION BY user_id, frame_id ORDER BY event_id) - 1 AS idx, v AS value, close, n AS n_samples
  FROM s JOIN c USING (user_id, frame_id) WHERE v >= 0)
"""
FRAME_SUMS = """
SELECT user_id, frame_id, close, n_samples, CAST(sum(value * (idx + 1)) AS BIGINT) AS weighted
FROM rows GROUP BY user_id, frame_id, close, n_samples
"""
LEAST = {-2: 2, -4: 0}


def marked(df):
    mark = code_label("event_type", {"click": "-1", "error": "-2", "signup": "-3", "purchase": "-4"}, None)
    return df.select("user_id", "event_id", F.coalesce(mark.cast("long"), "cents").alias("value"))


def weigh(arrays):
    """Frames as arrays, one row each, condensed in a way that tells order apart."""
    weighted = F.aggregate(F.transform("samples", lambda v, i: v * (i + 1)), F.lit(0).cast("long"), lambda a, v: a + v)
    return arrays.select("user_id", "frame_id", "close", F.size("samples").cast("long").alias("n_samples"),
                         weighted.alias("weighted"))


@query("t4_frames", f"WITH {FRAMES} SELECT * FROM rows")
def frames(t):
    return st.frames(marked(t.ev), "user_id", "event_id", "value", min_samples=LEAST)


@query("t4_frames_cut", f"WITH {FRAMES} SELECT * FROM rows")
def frames_cut(t):
    return st.frames(marked(t.ev), "user_id", "event_id", "value", min_samples=LEAST, max_rows=20)


@query("t4_frame_arrays", f"WITH {FRAMES} {FRAME_SUMS}")
def frame_arrays(t):
    rows = st.frames(marked(t.ev), "user_id", "event_id", "value", min_samples=LEAST)
    arrays = st.frame_arrays(rows, "user_id", "value")
    sums = rows.groupBy("user_id", "frame_id").agg(F.first("close").alias("close"))
    return weigh(arrays.join(sums, ["user_id", "frame_id"]))


@query("t4_frames_stream", f"""
WITH {FRAMES}, sent AS ({FRAME_SUMS})
SELECT c.user_id, c.frame_id, c.close, c.n AS n_samples, coalesce(weighted, 0) AS weighted
FROM c LEFT JOIN sent USING (user_id, frame_id)
""")
def frames_stream(t):
    """Frames without samples are sent too, as empty arrays."""
    live = ss.frames(marked(live_events(t)), "user_id", "event_id", "value", min_samples=LEAST)
    return weigh(ss.run_to_table(live, "frames"))


@query("t4_frames_live", ORACLES["t4_frames_stream"])
def frames_live(t):
    """On the feed as it comes: a frame is sent when the watermark has passed its closing marker."""
    live, late = event_feed(t, "event_id")
    return weigh(ss.run_to_table(
        ss.frames(marked(live), "user_id", "event_id", "value", min_samples=LEAST, lateness=late), "frames"))


@query("line_scan", f"""
WITH {FRAMES}, smooth AS (SELECT *, avg(value) OVER (PARTITION BY user_id, frame_id ORDER BY idx
  ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) AS smooth FROM rows)
SELECT user_id, frame_id, idx, round(smooth, 6) AS smooth,
  CASE WHEN smooth >= 0.7e0 * max(smooth) OVER (PARTITION BY user_id, frame_id) THEN 1 ELSE 0 END AS bit FROM smooth
""")
def line_scan(t):
    """Frames, smoothed and turned into bits, as one plan."""
    rows = st.frames(marked(t.ev), "user_id", "event_id", "value", min_samples=LEAST)
    frame = ["user_id", "frame_id"]
    split = od.measure(rows, frame, "idx")
    smooth = sg.moving_mean(rows, frame, "idx", "value", split=split)
    bits = sg.threshold_binary(smooth, frame, "idx", "smooth", split=split)
    return bits.select(*frame, "idx", F.round("smooth", 6).alias("smooth"), "bit")


# ----------------------------------------------------------------------------- lines

TYPED = """
typed AS (SELECT conv_id, string_agg(replace(replace(text, 't', chr(8)), '. ', chr(13)) || chr(10), '' ORDER BY turn) AS s
  FROM conversations GROUP BY conv_id),
pieces AS (SELECT conv_id, string_split(replace(s, chr(13), chr(10)), chr(10)) AS p FROM typed),
each AS (SELECT conv_id, unnest(range(len(p) - 1)) AS line_no, unnest(p[:len(p) - 1]) AS raw FROM pieces),
lines AS (SELECT conv_id, line_no, list_reduce(list_concat([''], string_split(raw, '')), lambda a, c:
  CASE WHEN c = chr(8) THEN CASE WHEN ltrim(a, chr(1)) = '' THEN a ELSE a[:length(a) - 1] END
    WHEN length(ltrim(a, chr(1))) < 80 THEN a || c ELSE chr(1) || a END) AS held FROM each)
"""
LINES = f"""
WITH {TYPED} SELECT conv_id, line_no, ltrim(held, chr(1)) AS line, length(held) - length(ltrim(held, chr(1))) AS dropped FROM lines
"""


def typed(df):
    """Conversations as typed text, a turn per row; a ``t`` is a backspace, ``. `` a carriage return."""
    text = F.concat(F.replace(F.replace("text", F.lit("t"), F.lit("\b")), F.lit(". "), F.lit("\r")), F.lit("\n"))
    return df.select("conv_id", "turn", text.alias("text")).filter("text is not null")


def lines(t, max_rows=None):
    out = st.assemble_lines(typed(t.conversations), "conv_id", "turn", "text", max_rows=max_rows)
    return out.select("conv_id", "line_no", "line", "dropped")


@query("t5_assemble_lines", LINES)
def assemble_lines(t):
    return lines(t)


@query("t5_assemble_lines_cut", LINES)
def assemble_lines_cut(t):
    return lines(t, max_rows=3)


@query("t5_assemble_lines_stream", LINES)
def assemble_lines_stream(t):
    live = ss.table_stream(t.spark, t.folder, "conversations", t.conversations.schema)
    out = ss.run_to_table(ss.assemble_lines(typed(live), "conv_id", "turn", "text"), "lines")
    return out.select("conv_id", "line_no", "line", "dropped")


# ----------------------------------------------------------------------------- state machine

EVENTS = {"click": "continued", "view": "servo_at_position", "signup": "recipe_restarted",
          "purchase": "paused", "error": "error_detected"}

MACHINE = f"""
WITH RECURSIVE {EV}, e AS (SELECT user_id, event_id,
  CASE event_type {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in EVENTS.items())} END AS event,
  row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rn FROM ev),
table_(s, ev_, n) AS (VALUES {', '.join(f"('{s}', '{e}', '{n}')" for (s, e), n in st.SERVO_TRANSITIONS.items())}),
r AS (SELECT user_id, event_id, event, rn, 'paused' AS "from", coalesce(n, 'paused') AS "to"
    FROM e LEFT JOIN table_ ON s = 'paused' AND ev_ = event WHERE rn = 1
  UNION ALL SELECT e.user_id, e.event_id, e.event, e.rn, r."to", coalesce(n, r."to")
    FROM r JOIN e ON e.user_id = r.user_id AND e.rn = r.rn + 1 LEFT JOIN table_ ON s = r."to" AND ev_ = e.event)
SELECT user_id, event_id, event, "from", "to" FROM r
"""


def commands(df):
    return df.select("user_id", "event_id", code_label("event_type", EVENTS, None).alias("event"))


@query("t6_state_machine", MACHINE)
def state_machine(t):
    return st.state_machine(commands(t.ev), "user_id", "event_id", "event")


@query("t6_state_machine_cut", MACHINE)
def state_machine_cut(t):
    return st.state_machine(commands(t.ev), "user_id", "event_id", "event", max_rows=20)


@query("t6_state_machine_stream", MACHINE)
def state_machine_stream(t):
    live = ss.state_machine(commands(live_events(t)), "user_id", "event_id", "event")
    return ss.run_to_table(live, "machine")


@query("t6_state_machine_live", MACHINE)
def state_machine_live(t):
    live, late = event_feed(t)
    timed = live.select("user_id", "event_id", "tick", code_label("event_type", EVENTS, None).alias("event"))
    out = ss.state_machine(timed, "user_id", ["tick", "event_id"], "event", lateness=late)
    return ss.run_to_table(out, "machine").drop("tick")


# ----------------------------------------------------------------------------- periodic, totals, report

WINDOWS = """
w AS (SELECT time_bucket(INTERVAL 6 HOUR, ts, TIMESTAMP '1970-01-01') AS s, event_type, count(*) AS n,
        CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS cents FROM events GROUP BY ALL)
SELECT epoch_us(s) // 1000000 AS window_start, epoch_us(s) // 1000000 + 21600 AS window_end, event_type, n, cents FROM w
"""


def periodic(df):
    # files come in any order, so a row may be as late as the table is long
    out = ss.periodic_metrics(
        df, "ts", "6 hours", "36500 days", "event_type",
        n=F.count(F.lit(1)), cents=F.sum(F.round(F.col("value") * 100).cast("long")),
    )
    return out


def as_seconds(df):
    return df.withColumns({c: F.unix_seconds(c) for c in ("window_start", "window_end")})


@query("t1_periodic_metrics", f"WITH {WINDOWS}")
def periodic_metrics(t):
    return as_seconds(periodic(t.events))


@query("t1_periodic_metrics_stream", f"WITH {WINDOWS}")
def periodic_metrics_stream(t):
    """All windows; the last ones close when the input ends."""
    live = ss.table_stream(t.spark, t.folder, "events", t.events.schema)
    return as_seconds(ss.run_to_table(periodic(live), "periodic"))


@query("t2_running_totals_stream", TOTALS)
def running_totals_stream(t):
    live = live_events(t).withColumn("server", F.col("user_id") % 7)
    return ss.run_updates(ss.running_totals(live, "server", "cents"), "server", "totals")


@query("t7_final_report_stream", f"SELECT queue, report_ts AS ts FROM ({CLOSING}) WHERE report_ts IS NOT NULL")
def final_report_stream(t):
    """The depth feed, written as a table first, then streamed."""
    feed = workspace(t.spark, "depth-feed")
    depths(t).select("queue", "ts", "event_id", "delta", "depth").write.parquet(feed)
    live = t.spark.readStream.schema(t.spark.read.parquet(feed).schema).parquet(feed)
    return ss.run_to_table(ss.final_report(live, "queue", "ts", "depth", 1_500_000_000, ["event_id", "delta"]), "report")


@query("t7_final_report_live", ORACLES["t7_final_report_stream"])
def final_report_live(t):
    """The depths as a feed with a finite lateness. A queue that is empty at closing time reports by its timer."""
    table = workspace(t.spark, "depths")
    depths(t).select("queue", "ts", "event_id", "delta", "depth").write.parquet(table)
    live, late = feed(t.spark.read.parquet(table), "ts")
    out = ss.final_report(live, "queue", "ts", "depth", 1_500_000_000, ["event_id", "delta"], late)
    return ss.run_to_table(out, "report")


@query("t8_collect_n_stream", f"""
WITH {EV} SELECT user_id, event_id FROM ev WHERE cents > 300
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id) <= 5
""")
def collect_n_stream(t):
    live = live_events(t).filter("cents > 300").select("user_id", "event_id")
    return ss.run_to_table(ss.collect_n(live, "user_id", "event_id", 5), "collected")


@query("x3_each_batch", """
SELECT 'events ' || event_type || ': ' || count(*) AS line FROM events GROUP BY event_type
""")
def each_batch(t):
    """A handler per micro-batch that writes its counts; the report adds them up."""
    out = workspace(t.spark, "batch-counts")

    def handler(batch, batch_id):
        batch.groupBy("event_type").agg(F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    ss.each_batch(ss.table_stream(t.spark, t.folder, "events", t.events.schema), handler)
    counts = t.spark.read.schema("event_type string, n long").parquet(out).groupBy("event_type").agg(F.sum("n").alias("n"))
    return counts.select(F.format_string("events %s: %d", "event_type", "n").alias("line"))
