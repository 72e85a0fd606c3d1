"""Queue and server metrics.

A purchase is a customer: arriving at its tick, waiting and being served for
times that follow from its value. Error events are breaks of a server.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.scalars import busy_label, tick_to_clock
from ..operators import joins, sorting
from ..operators import queueing as qu
from ..operators import states as st
from ..sources import generate as gen
from ..streaming import stateful as ss
from .registry import EV, ORACLES, query

DAY0 = 1704067200000

CUSTOMERS = f"""
{EV}, customers AS (
  SELECT event_id, user_id % 3 AS queue, user_id % 7 AS server, tick - {DAY0} AS arrived,
    tick - {DAY0} + cents * 200 AS start, tick - {DAY0} + cents * 1200 AS finish
  FROM ev WHERE event_type = 'purchase'),
breaks AS (SELECT user_id % 6 AS server, tick - {DAY0} AS start, tick - {DAY0} + cents * 30 AS finish
  FROM ev WHERE event_type = 'error')
"""


def customers(t):
    at = F.col("tick") - DAY0
    return t.ev.filter("event_type = 'purchase'").select(
        "event_id", (F.col("user_id") % 3).alias("queue"), (F.col("user_id") % 7).alias("server"),
        at.alias("arrived"), (at + F.col("cents") * 200).alias("start"),
        (at + F.col("cents") * 1200).alias("finish"),
    )


def breaks(t):
    """Servers 0 to 5 take them, server 6 takes none."""
    at = F.col("tick") - DAY0
    return t.ev.filter("event_type = 'error'").select(
        (F.col("user_id") % 6).alias("server"), at.alias("start"),
        (at + F.col("cents") * 30).alias("finish"),
    )


# ----------------------------------------------------------------------------- matching, depth

FIFO = f"""
{CUSTOMERS}, a AS (SELECT queue, arrived, row_number() OVER (PARTITION BY queue ORDER BY arrived, event_id) AS k FROM customers),
s AS (SELECT queue, start AS started, row_number() OVER (PARTITION BY queue ORDER BY start, event_id) AS k FROM customers),
matched AS (SELECT queue, k, arrived, started, started - arrived AS wait FROM a JOIN s USING (queue, k))
"""


def matched(t, **opts):
    c = customers(t)
    return joins.fifo_match(c.select("queue", F.col("arrived").alias("ts"), "event_id"),
                            c.select("queue", F.col("start").alias("ts"), "event_id"),
                            "queue", "ts", "event_id", **opts)


@query("j4_fifo_match", f"WITH {FIFO} SELECT * FROM matched")
def fifo_match(t):
    return matched(t)


@query("j4_fifo_match_cut", f"WITH {FIFO} SELECT * FROM matched")
def fifo_match_cut(t):
    return matched(t, max_rows=150)


DEPTH = f"""
moves AS (SELECT queue, arrived AS ts, event_id, 1 AS delta FROM customers
  UNION ALL SELECT queue, finish, event_id, -1 FROM customers),
deep AS (SELECT *, CAST(sum(delta) OVER (PARTITION BY queue ORDER BY ts, delta DESC, event_id
  ROWS UNBOUNDED PRECEDING) AS BIGINT) AS depth FROM moves),
depths AS (SELECT *, max(depth) OVER (PARTITION BY queue ORDER BY ts, delta DESC, event_id
  ROWS UNBOUNDED PRECEDING) AS peak FROM deep)
"""


def depths(t, **opts):
    c = customers(t)
    return qu.depth_over_time(c.select("queue", F.col("arrived").alias("ts"), "event_id"),
                              c.select("queue", F.col("finish").alias("ts"), "event_id"),
                              "queue", "ts", "event_id", **opts)


@query("w2_depth_over_time", f"WITH {CUSTOMERS}, {DEPTH} SELECT queue, ts, event_id, delta, depth, peak FROM depths")
def depth_over_time(t):
    return depths(t)


@query("w2_depth_over_time_cut", f"WITH {CUSTOMERS}, {DEPTH} SELECT queue, ts, event_id, delta, depth, peak FROM depths")
def depth_over_time_cut(t):
    return depths(t, max_rows=150)


def queue_day(t, **opts):
    c = customers(t)
    sides = (c.select("queue", F.col(at).alias("ts"), "event_id") for at in ("arrived", "start", "finish"))
    return qu.queue_day(*sides, "queue", "ts", "event_id", **opts)


@query("a6_queue_report", f"""
WITH {FIFO}, {DEPTH},
w AS (SELECT queue, count(*) AS served, CAST(sum(wait) AS BIGINT) // count(*) // 100 AS avg_wait, max(wait) // 100 AS max_wait
      FROM matched GROUP BY queue),
d AS (SELECT queue, max(depth) AS max_depth FROM depths GROUP BY queue)
SELECT queue, served, avg_wait, max_wait, max_depth FROM w JOIN d USING (queue)
""")
def queue_report(t):
    return queue_day(t)


@query("a6_queue_report_cut", ORACLES["a6_queue_report"])
def queue_report_cut(t):
    return queue_day(t, max_rows=150)


@query("a6_queue_report_joined", ORACLES["a6_queue_report"])
def queue_report_joined(t):
    """The same report from the matched customers and the depths, where these are at hand already."""
    return qu.queue_report(matched(t), depths(t), "queue")


CLOSING = f"""
WITH {CUSTOMERS}, {DEPTH}
SELECT queue, CASE WHEN coalesce(max_by(depth, (ts, event_id, delta)) FILTER (ts <= 1500000000), 0) = 0 THEN 1500000000
  ELSE min(ts) FILTER (ts > 1500000000 AND depth = 0) END AS report_ts
FROM depths GROUP BY queue
"""


@query("t7_final_report", f"SELECT * FROM ({CLOSING}) WHERE report_ts IS NOT NULL")
def final_report(t):
    return st.final_report(depths(t), "ts", "depth", 1_500_000_000, "queue", tie=["event_id", "delta"])


@query("t7_final_report_drained", f"""
WITH {CUSTOMERS}, {DEPTH}
SELECT queue, max(ts) + 1 AS report_ts FROM depths WHERE queue = 1 GROUP BY queue
""")
def final_report_drained(t):
    """A queue whose last customer left before closing time reports at closing time."""
    d = depths(t).filter("queue = 1")
    return st.final_report(d, "ts", "depth", d.agg(F.max("ts") + 1).first()[0], "queue", tie=["event_id", "delta"])


# ----------------------------------------------------------------------------- servers


@query("w3_idle_gaps", f"""
WITH {CUSTOMERS} SELECT event_id, server,
  start - lag(finish, 1, 0) OVER (PARTITION BY server ORDER BY start, event_id) AS idle FROM customers
""")
def idle_gaps(t):
    return qu.idle_gaps(customers(t), "server", "start", "finish", tie="event_id").select(
        "event_id", "server", "idle"
    )


SERVERS = f"""
{CUSTOMERS},
g AS (SELECT *, start - lag(finish, 1, 0) OVER (PARTITION BY server ORDER BY start, event_id) AS idle FROM customers),
w AS (SELECT server, count(*) AS served, CAST(sum(finish - start) AS BIGINT) AS service, max(finish - start) AS longest,
  CAST(sum(idle) AS BIGINT) AS idle, max(idle) AS longest_idle FROM g GROUP BY server),
b AS (SELECT server, count(*) AS breaks, CAST(sum(finish - start) AS BIGINT) AS total, max(finish - start) AS longest,
  min(finish - start) AS shortest FROM breaks GROUP BY server),
report AS (SELECT server, coalesce(served, 0) AS served,
  CAST(trunc(trunc(service / served) / 100) AS BIGINT) AS avg_service, coalesce(w.longest, 0) // 100 AS max_service,
  CAST(trunc(trunc(idle / served) / 100) AS BIGINT) AS avg_idle,
  CAST(trunc(trunc(coalesce(idle, 0) / (SELECT count(*) FROM (SELECT server FROM w UNION SELECT server FROM b))) / 100) AS BIGINT) AS ref_idle_div,
  CAST(trunc(coalesce(longest_idle, 0) / 100) AS BIGINT) AS max_idle, coalesce(breaks, 0) AS breaks,
  coalesce(CAST(total // breaks // 100 AS VARCHAR), 'none') AS avg_break,
  coalesce(b.longest, 0) // 100 AS longest_break, coalesce(CAST(shortest // 100 AS VARCHAR), 'none') AS shortest_break
  FROM w FULL JOIN b USING (server))
"""


@query("a5_server_report", f"WITH {SERVERS} SELECT * FROM report")
def server_report(t):
    return qu.server_report(customers(t), breaks(t), "server", "start", "finish", tie="event_id")


@query("s9_server_report_text", f"""
WITH {SERVERS} SELECT server, unnest([0, 1, 2]) AS line_no, unnest([
  'server ' || server || ': ' || served || ' served',
  'server ' || server || ': ' || breaks || ' pauses',
  'server ' || server || ': briefest pause ' || shortest_break]) AS line FROM report
""")
def server_report_text(t):
    report = qu.server_report(customers(t), breaks(t), "server", "start", "finish", tie="event_id")
    return gen.render_report(report, [
        ("server %d: %d served", ["server", "served"]),
        ("server %d: %d pauses", ["server", "breaks"]),
        ("server %d: briefest pause %s", ["server", "shortest_break"]),
    ], keep=["server"])


SNAPSHOT = f"""
WITH {CUSTOMERS}, moves AS (
  SELECT queue, arrived AS ts, event_id, 1 AS delta, 0 AS done FROM customers
  UNION ALL SELECT queue, finish, event_id, -1, 1 FROM customers),
ticks AS (SELECT unnest(range((SELECT CAST(ceil(min(ts) / 21600000) * 21600000 AS BIGINT) FROM moves),
  (SELECT CAST(ceil(max(ts) / 21600000) * 21600000 AS BIGINT) FROM moves) + 1, 21600000)) AS tick),
m AS (SELECT *, CAST(sum(delta) OVER w AS BIGINT) AS waiting, CAST(sum(done) OVER w AS BIGINT) AS served
  FROM moves WINDOW w AS (PARTITION BY queue ORDER BY ts, event_id, done ROWS UNBOUNDED PRECEDING)),
last AS (SELECT *, row_number() OVER (PARTITION BY queue ORDER BY ts, event_id, done) AS rn FROM m),
pos AS (SELECT tick, q.queue, max(rn) AS rn FROM ticks, (SELECT DISTINCT queue FROM moves) q
  LEFT JOIN last ON last.queue IS NOT DISTINCT FROM q.queue AND last.ts <= tick GROUP BY tick, q.queue)
SELECT tick, pos.queue, waiting, served,
  CASE WHEN done = 1 THEN 'left' WHEN done = 0 THEN 'came' END AS status
FROM pos JOIN last ON last.queue IS NOT DISTINCT FROM pos.queue AND last.rn = pos.rn
"""


def moves(t):
    c = customers(t)
    return c.select("queue", F.col("arrived").alias("ts"), "event_id", F.lit(0).alias("done")).unionByName(
        c.select("queue", F.col("finish").alias("ts"), "event_id", F.lit(1).alias("done"))
    )


@query("j5_snapshot", SNAPSHOT)
def snapshot(t):
    status = F.when(F.col("done") == 1, "left").otherwise("came")
    return joins.snapshot(
        moves(t), "queue", "ts", 21_600_000,
        sums={"waiting": 1 - 2 * F.col("done"), "served": F.col("done")},
        latest={"status": status}, tie=["event_id", "done"],
    )


@query("j5_snapshot_text", f"""
WITH s AS ({SNAPSHOT})
SELECT tick, queue, unnest([0, 1]) AS line_no, unnest([
  'at ' || printf('%02d:%02d', 9 + tick // 6000, (tick // 100) % 60),
  'waiting ' || waiting || ', now ' || CASE WHEN waiting > 0 THEN 'Busy' WHEN served % 2 = 1 THEN 'On Break' ELSE 'Idle' END]) AS line
FROM s
""")
def snapshot_text(t):
    """The periodic screen: clock, depth and status."""
    shot = snapshot(t)
    return gen.render_report(shot, [
        ("at %s", [tick_to_clock("tick")]),
        ("waiting %d, now %s",
         ["waiting", busy_label(F.col("waiting") > 0, F.col("served") % 2 == 1)]),
    ], keep=["tick", "queue"])


# ----------------------------------------------------------------------------- positional joins

PASTE = f"""
WITH {EV}, c AS (SELECT user_id, event_id AS click, row_number() OVER (PARTITION BY user_id ORDER BY us, event_id) AS k
  FROM ev WHERE event_type = 'click'),
v AS (SELECT user_id, event_id AS seen, row_number() OVER (PARTITION BY user_id ORDER BY us, event_id) AS k
  FROM ev WHERE event_type = 'view')
SELECT user_id, k, click, seen FROM c FULL JOIN v USING (user_id, k)
"""


def paste(t, **opts):
    ev = t.ev
    a = ev.filter("event_type = 'click'").select("user_id", F.col("event_id").alias("click"))
    b = ev.filter("event_type = 'view'").select("user_id", F.col("event_id").alias("seen"))
    # event ids rise with time
    return joins.positional_join(a, b, "click", "seen", "user_id", **opts)


@query("j1_positional_join", PASTE)
def positional_join(t):
    return paste(t)


ALL = """
WITH o AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS k FROM orders),
p AS (SELECT event_id, row_number() OVER (ORDER BY event_id) AS k FROM events)
SELECT k, o_orderkey, event_id FROM o FULL JOIN p USING (k)
"""


@query("j1_positional_join_cut", ALL)
def positional_join_cut(t):
    """Two whole tables side by side: one group, cut on both sides."""
    return joins.positional_join(t.orders.select("o_orderkey"), t.events.select("event_id"),
                                 "o_orderkey", "event_id", max_rows=1000)


# ----------------------------------------------------------------------------- watches and audits


@query("w5_stopwatch", f"""
WITH {EV}, c AS (SELECT user_id, tick, row_number() OVER w AS rn, lead(tick) OVER w AS stop FROM ev
  WHERE event_type = 'click' WINDOW w AS (PARTITION BY user_id ORDER BY tick, event_id))
SELECT user_id, tick AS start, stop, stop - tick AS elapsed FROM c WHERE rn % 2 = 1 AND stop IS NOT NULL
""")
def stopwatch(t):
    return qu.stopwatch(t.ev.filter("event_type = 'click'"), "user_id", "tick", "event_id")


SESSIONS = f"""
WITH {EV}, c AS (SELECT user_id, tick, event_id, event_type AS kind, lag(event_type) OVER w AS pk, lag(tick) OVER w AS pt
  FROM ev WHERE event_type IN ('click', 'error') WINDOW w AS (PARTITION BY user_id ORDER BY tick, event_id))
SELECT user_id, CAST(coalesce(sum(tick - pt) FILTER (kind = 'error' AND pk = 'click'), 0) AS BIGINT) AS elapsed,
  count(*) FILTER (kind = 'error' AND pk = 'click') AS sessions,
  count(*) FILTER (kind = 'click' AND pk = 'click') AS start_errors,
  count(*) FILTER (kind = 'error' AND coalesce(pk, 'error') = 'error') AS stop_errors,
  arg_max(kind, [tick, event_id]) = 'click' AS running
FROM c GROUP BY user_id
"""


@query("w6_timer_sessions", SESSIONS)
def timer_sessions(t):
    return qu.timer_sessions(t.ev, "user_id", "tick", "event_type", "event_id", "click", "error")


@query("w6_timer_sessions_cut", SESSIONS)
def timer_sessions_cut(t):
    return qu.timer_sessions(t.ev, "user_id", "tick", "event_type", "event_id", "click", "error", max_rows=15)


EXTREMES = f"""
WITH {EV} SELECT event_id, max(cents) OVER w AS running_max, min(cents) OVER w AS running_min FROM ev
WINDOW w AS (PARTITION BY user_id ORDER BY us, event_id ROWS UNBOUNDED PRECEDING)
"""


@query("w7_running_extremes", EXTREMES)
def running_extremes(t):
    return qu.running_extremes(t.ev, "user_id", ["us", "event_id"], "cents").select(
        "event_id", "running_max", "running_min")


@query("w7_running_extremes_cut", EXTREMES)
def running_extremes_cut(t):
    return qu.running_extremes(t.ev, "user_id", ["us", "event_id"], "cents", max_rows=25).select(
        "event_id", "running_max", "running_min")


@query("a11_balance_audit", f"""
WITH {EV} SELECT user_id, CAST(sum(CASE event_type WHEN 'click' THEN 1 ELSE -1 END) AS BIGINT) AS balance, count(*) AS events
FROM ev WHERE event_type IN ('click', 'error') GROUP BY user_id HAVING balance <> 0
""")
def balance_audit(t):
    return qu.balance_audit(t.ev, "user_id", "event_type", "click", "error")


TOTALS = f"""
WITH {EV} SELECT user_id % 7 AS server, count(*) AS served, CAST(sum(cents) AS BIGINT) AS total_service, max(cents) AS max_service
FROM ev GROUP BY user_id % 7
"""


@query("t2_running_totals", TOTALS)
def running_totals(t):
    return ss.running_totals(t.ev.withColumn("server", F.col("user_id") % 7), "server", "cents")


@query("t8_collect_n", f"""
WITH {EV} SELECT user_id, event_id FROM ev WHERE cents > 300
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY us, event_id) <= 5
""")
def collect_n(t):
    out = st.collect_n(t.ev, "user_id", ["us", "event_id"], 5, F.col("cents") > 300)
    return out.select("user_id", "event_id")


@query("o4_traverse_front", "SELECT o_orderkey FROM orders ORDER BY o_orderkey")
def traverse_front(t):
    return sorting.sort_by(t.orders.select("o_orderkey"), "o_orderkey")
