"""Every registered query of the engine, with the SQL it is held against.

Queries run whole tables of the driver's star schema through the engine's operators. Days are compared as text and doubles
rounded where two engines may add in another order.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark import schemas, specs
from tidemark.functions import scalars
from tidemark.operators import diff, facts, flags, folds, matching, pit, quality
from tidemark.plans import jobs, streams
from tidemark.plans.streams import table
from tidemark.sources import publish, scans
from tidemark.streaming import listings

QUERIES: dict[str, Callable] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


def day(c: str):
    return F.date_format(c, "yyyy-MM-dd").alias(c.split(".")[-1])


# --- point in time -------------------------------------------------------------------------------------------------

_STREAM = f"""
t AS (SELECT user_id, CAST(ts AS DATE) AS date, event_id AS seq, CASE WHEN event_type <> 'error' THEN event_type END AS post FROM events),
tr AS (SELECT *, lag(post) OVER (PARTITION BY user_id ORDER BY seq) AS pre FROM t),
lg AS (SELECT * FROM tr WHERE pre IS DISTINCT FROM post AND date >= DATE '{streams.LOG_START}'),
cur AS (SELECT user_id, arg_max(coalesce(post, ''), seq) AS record FROM tr GROUP BY user_id)
"""
_INTERVALS = f"""
{_STREAM},
d AS (SELECT DISTINCT user_id, date FROM lg UNION SELECT DISTINCT user_id, DATE '{streams.BOUNDARY}' FROM tr),
st AS (
  SELECT d.user_id, d.date, coalesce(
    (SELECT arg_min(coalesce(l.pre, ''), l.seq) FROM lg l WHERE l.user_id = d.user_id AND l.date > d.date),
    (SELECT record FROM cur c WHERE c.user_id = d.user_id)) AS state FROM d),
ch AS (SELECT *, lag(state) OVER (PARTITION BY user_id ORDER BY date) AS was FROM st),
tu AS (SELECT user_id, state, date AS valid_from, lead(date) OVER (PARTITION BY user_id ORDER BY date) AS valid_to FROM ch WHERE was IS NULL OR was <> state),
iv AS (SELECT user_id, state, valid_from, valid_to, valid_from <> DATE '{streams.BOUNDARY}' AS provable_from FROM tu WHERE state <> '')
"""


def _parts(spark, sf_dir):
    rows = streams.transitions(spark, sf_dir)
    return streams.current(rows), streams.log(rows)


def _intervals(spark, sf_dir) -> DataFrame:
    now, log = _parts(spark, sf_dir)
    return pit.build_intervals(now, log, ["user_id"], streams.BOUNDARY)


@query(f"WITH {_INTERVALS} SELECT user_id, state, CAST(valid_from AS VARCHAR) AS valid_from, CAST(valid_to AS VARCHAR) AS valid_to, provable_from FROM iv")
def pit_intervals(spark, sf_dir):
    return _intervals(spark, sf_dir).select("user_id", F.col("record").alias("state"), day("valid_from"), day("valid_to"), "provable_from")


@query(f"WITH {_INTERVALS} SELECT user_id, state FROM iv WHERE valid_from <= DATE '{streams.AS_OF}' AND (valid_to IS NULL OR DATE '{streams.AS_OF}' < valid_to)")
def pit_asof(spark, sf_dir):
    return pit.as_of(_intervals(spark, sf_dir), streams.AS_OF, streams.BOUNDARY).select("user_id", F.col("record").alias("state"))


@query(f"""WITH {_STREAM}, r AS (
  SELECT c.user_id, coalesce((SELECT arg_min(coalesce(l.pre, ''), l.seq) FROM lg l WHERE l.user_id = c.user_id AND l.date > DATE '{streams.AS_OF}'), c.record) AS state FROM cur c)
SELECT user_id, state FROM r WHERE state <> ''""")
def pit_members_replay(spark, sf_dir):
    now, log = _parts(spark, sf_dir)
    return pit.members_asof(now, log, ["user_id"], streams.AS_OF).select("user_id", F.col("record").alias("state"))


_DAYS = ("2024-01-07", "2024-01-08", "2024-01-15", "2024-01-22", "2024-01-30")


@query(f"""WITH {_INTERVALS}, q AS (SELECT CAST(unnest([{", ".join(f"'{d}'" for d in _DAYS)}]) AS DATE) AS d)
SELECT CAST(d AS VARCHAR) AS day, CAST(count(iv.user_id) AS BIGINT) AS members, CAST(0 AS BIGINT) AS mismatches
FROM q LEFT JOIN iv ON valid_from <= d AND (valid_to IS NULL OR d < valid_to) GROUP BY d""")
def pit_equivalence(spark, sf_dir):
    """Slicing the intervals and undoing the log must agree on every day."""
    now, log = _parts(spark, sf_dir)
    days = list(_DAYS)
    sliced = pit.as_of_days(_intervals(spark, sf_dir), days).select("day", "user_id", F.col("record").alias("s"))
    replayed = pit.members_on(now, log, ["user_id"], days).select("day", "user_id", F.col("record").alias("r"))
    both = sliced.join(replayed, ["day", "user_id"], "full_outer").groupBy("day").agg(F.count("s").alias("members"), F.count_if(~F.col("s").eqNullSafe(F.col("r"))).alias("mismatches"))
    return both.select(day("day"), "members", "mismatches")


@query(f"""WITH {_INTERVALS} SELECT e.event_id, iv.state FROM events e JOIN iv ON e.user_id = iv.user_id
AND iv.valid_from <= CAST(e.ts AS DATE) AND (iv.valid_to IS NULL OR CAST(e.ts AS DATE) < iv.valid_to) WHERE e.event_type = 'purchase'""")
def pit_fact_join(spark, sf_dir):
    bought = table(spark, sf_dir, "events").filter("event_type = 'purchase'").select("event_id", "user_id", F.to_date("ts").alias("d"))
    return pit.join_as_of(bought, _intervals(spark, sf_dir), ["user_id"], "d").select("event_id", F.col("record").alias("state"))


@query(f"""SELECT event_type AS source, CAST(greatest(min(CAST(ts AS DATE)) + 3, (SELECT min(CAST(ts AS DATE)) - 1 FROM events WHERE ts >= TIMESTAMP '{streams.LOG_START}')) AS VARCHAR) AS floor
FROM events GROUP BY event_type""")
def source_floor(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(F.col("event_type").alias("source"), F.to_date("ts").alias("date"))
    seen = e.groupBy("source").agg(F.date_add(F.min("date"), 3).alias("first_observed"))
    return pit.source_floors(e.filter(F.col("date") >= F.lit(streams.LOG_START)), seen).select("source", day("floor"))


@query("""WITH e AS (SELECT CASE WHEN event_id % 97 = 0 THEN NULL ELSE CAST(ts AS DATE) END AS date, CASE event_type WHEN 'view' THEN 'added' WHEN 'click' THEN 'removed'
  WHEN 'error' THEN 'lost' ELSE 'changed' END AS event, CASE WHEN event_id % 89 <> 0 THEN event_type END AS previous FROM events)
SELECT CAST(count(*) FILTER (date IS NULL) AS BIGINT) AS bad_date, CAST(count(*) FILTER (event NOT IN ('added', 'removed', 'changed')) AS BIGINT) AS bad_kind,
CAST(count(*) FILTER (event = 'changed' AND previous IS NULL) AS BIGINT) AS no_previous FROM e""")
def validate_events(spark, sf_dir):
    kind = F.when(F.col("event_type") == "view", "added").when(F.col("event_type") == "click", "removed").when(F.col("event_type") == "error", "lost").otherwise("changed")
    rows = table(spark, sf_dir, "events").select(
        F.when(F.col("event_id") % 97 != 0, F.to_date("ts")).alias("date"), kind.alias("event"), F.when(F.col("event_id") % 89 != 0, F.col("event_type")).alias("previous")
    )
    return pit.violations(rows)


# --- snapshots and logs --------------------------------------------------------------------------------------------


@query("""WITH p AS (SELECT c_custkey AS k, c_mktsegment AS s FROM customer WHERE c_custkey % 7 <> 0),
n AS (SELECT c_custkey AS k, CASE WHEN c_custkey % 5 = 0 THEN 'moved' ELSE c_mktsegment END AS s FROM customer WHERE c_custkey % 11 <> 0)
SELECT CASE WHEN p.k IS NULL THEN 'added' WHEN n.k IS NULL THEN 'removed' ELSE 'changed' END AS event, coalesce(n.k, p.k) AS custkey,
coalesce(n.s, p.s) AS segment, CASE WHEN p.k IS NOT NULL AND n.k IS NOT NULL THEN p.s END AS previous_segment
FROM p FULL OUTER JOIN n ON p.k = n.k WHERE p.k IS NULL OR n.k IS NULL OR p.s <> n.s""")
def snapshot_diff(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("custkey"), F.col("c_mktsegment").alias("segment"))
    new = c.filter("custkey % 11 <> 0").withColumn("segment", F.when(F.col("custkey") % 5 == 0, "moved").otherwise(F.col("segment")))
    found = diff.snapshot_diff(c.filter("custkey % 7 <> 0"), new, ["custkey"], "customer", "2024-01-31")
    return found.select("event", "record.custkey", "record.segment", F.col("previous.segment").alias("previous_segment"))


@query("""SELECT l_orderkey, l_linenumber, l_extendedprice FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber DESC, l_extendedprice DESC) AS n FROM lineitem) WHERE n = 1""")
def dup_key_last_wins(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    return diff.last_wins(rows, ["l_orderkey"], ["l_linenumber", "l_extendedprice"])


@query("""SELECT user_id, event_id, event_type FROM (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY event_id) AS b FROM events) WHERE b IS DISTINCT FROM event_type""")
def append_dedupe_latest(spark, sf_dir):
    """The events arrive in two batches; each drops what its user's event before says already."""
    e = table(spark, sf_dir, "events").select(F.lit("events").alias("source"), "user_id", "event_id", F.lit("seen").alias("event"), F.col("event_type").alias("record"), F.lit(None).cast("string").alias("previous"))
    e = e.withColumn("order_key", F.lpad(F.col("event_id").cast("string"), 12, "0"))
    half = (e.agg(F.max("event_id")).first()[0] or 0) // 2
    empty = e.limit(0).drop("order_key").withColumn("seq", F.lit(0).cast("long"))
    first = diff.append_batch(empty, e.filter(F.col("event_id") <= half), ["user_id"], ["event_id"])
    second = diff.append_batch(first, e.filter(F.col("event_id") > half), ["user_id"], ["event_id"])
    return first.unionByName(second).select("user_id", "event_id", F.col("record").alias("event_type"))


@query("SELECT user_id, event_type, min(event_id) AS event_id FROM events GROUP BY user_id, event_type")
def first_seen_dedupe(spark, sf_dir):
    return diff.first_wins(table(spark, sf_dir, "events").select("user_id", "event_type", "event_id"), ["user_id", "event_type"], ["event_id"])


@query("SELECT user_id, min(event_id) AS first_seen FROM events GROUP BY user_id ORDER BY first_seen LIMIT 50")
def first_seen_limit(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(F.col("user_id").alias("cik"), F.col("event_id").alias("ord"))
    return scans.universe(e, 50, first="first_seen").withColumnRenamed("cik", "user_id")


@query("""SELECT DISTINCT user_id FROM events WHERE user_id NOT IN (SELECT user_id FROM events WHERE event_type = 'purchase' AND extract(isoyear FROM ts) = 2024 AND extract(week FROM ts) = 2)""")
def progress_anti(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    done = e.filter("event_type = 'purchase'").select(F.col("user_id").alias("cik"), scalars.iso_week(F.to_date("ts")).alias("week")).distinct()
    everyone = e.select(F.col("user_id").alias("cik")).distinct()
    return flags.pending(everyone, done, "2024-01-10").select(F.col("cik").alias("user_id"))


@query("""SELECT e AS event_type FROM (SELECT unnest(['view', 'signup', 'refund', 'click', 'chargeback']) AS e) WHERE e NOT IN (SELECT event_type FROM events)""")
def never_succeeded(spark, sf_dir):
    expected = spark.createDataFrame([(t,) for t in ("view", "signup", "refund", "click", "chargeback")], "event_type string")
    return quality.never_succeeded(expected, table(spark, sf_dir, "events"), "event_type")


@query("""SELECT event_type AS source, CAST(max(CAST(ts AS DATE)) AS VARCHAR) AS last_success, date_diff('day', max(CAST(ts AS DATE)), DATE '2024-02-05') > 5 + 2 AS stale FROM events
WHERE event_type <> 'error' OR ts < TIMESTAMP '2024-01-20' GROUP BY event_type""")
def watermark_staleness(spark, sf_dir):
    e = table(spark, sf_dir, "events").filter("event_type <> 'error' OR ts < TIMESTAMP_NTZ '2024-01-20 00:00:00'")
    marks = e.groupBy(F.col("event_type").alias("source")).agg(F.max(F.to_date("ts")).alias("last_success"))
    return quality.stale_sources(marks, "2024-02-05", 5).select("source", day("last_success"), "stale")


# --- matching ------------------------------------------------------------------------------------------------------


@query("""WITH g AS (SELECT user_id, event_type, ts, CASE WHEN date_diff('second', lag(ts) OVER w, ts) <= 43200 THEN 0 ELSE 1 END AS s FROM events WINDOW w AS (PARTITION BY user_id, event_type ORDER BY ts)),
n AS (SELECT *, sum(s) OVER (PARTITION BY user_id, event_type ORDER BY ts) AS g FROM g)
SELECT user_id, event_type, CAST(g AS BIGINT) AS group_no, CAST(count(*) AS BIGINT) AS n, CAST(CAST(min(ts) AS DATE) AS VARCHAR) AS first_day, CAST(CAST(max(ts) AS DATE) AS VARCHAR) AS last_day FROM n GROUP BY ALL""")
def split_clusters(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("user_id", "event_type", "ts")
    far = F.unix_timestamp(F.col("ts").cast("timestamp")) - F.unix_timestamp(F.col("__prev").cast("timestamp")) > 43200
    numbered = folds.chained_groups(e, ["user_id", "event_type"], "ts", far)
    grouped = numbered.groupBy("user_id", "event_type", "group_no").agg(F.count("*").alias("n"), F.to_date(F.min("ts")).alias("first_day"), F.to_date(F.max("ts")).alias("last_day"))
    return grouped.select("user_id", "event_type", "group_no", "n", day("first_day"), day("last_day"))


_SECONDS = "epoch_ms({}) // 1000"


def _timed(spark, sf_dir, kind: str) -> DataFrame:
    e = table(spark, sf_dir, "events").filter(F.col("event_type") == kind)
    # seconds of the time rounded to milliseconds, as the SQL's epoch_ms has it
    return e.select("user_id", "event_id", "value", F.expr("(unix_micros(CAST(ts AS TIMESTAMP)) + 500) DIV 1000 DIV 1000").alias("t"))


_VIEWS = f"v AS (SELECT user_id, {_SECONDS.format('ts')} AS t, min(value) AS value FROM events WHERE event_type = 'view' GROUP BY ALL), p AS (SELECT user_id, event_id, {_SECONDS.format('ts')} AS t FROM events WHERE event_type = 'purchase')"


@query(f"""WITH {_VIEWS}, c AS (SELECT p.event_id, v.t AS at, v.value, row_number() OVER (PARTITION BY p.event_id ORDER BY abs(v.t - p.t), v.t) AS n FROM p JOIN v ON p.user_id = v.user_id AND abs(v.t - p.t) <= 21600)
SELECT p.event_id, coalesce(c.at, -1) AS matched_at, c.value AS matched_value FROM p LEFT JOIN c ON p.event_id = c.event_id AND c.n = 1""")
def nearest_asof(spark, sf_dir):
    found = matching.nearest(_timed(spark, sf_dir, "purchase").drop("value"), _timed(spark, sf_dir, "view"), ["user_id"], "t", "t", "value", 21600, lambda a, b: F.abs(a - b))
    return found.select("event_id", F.coalesce("match.at", F.lit(-1).cast("long")).alias("matched_at"), F.col("match.value").alias("matched_value"))


@query(f"""WITH {_VIEWS}, b AS (SELECT p.event_id, arg_max(v.value, v.t) AS before FROM p JOIN v ON p.user_id = v.user_id AND v.t <= p.t - 3600 GROUP BY 1),
a AS (SELECT p.event_id, arg_min(v.value, v.t) AS after FROM p JOIN v ON p.user_id = v.user_id AND v.t >= p.t + 3600 GROUP BY 1),
r AS (SELECT p.event_id, CASE p.event_id % 3 WHEN 0 THEN 0.25 WHEN 1 THEN 2.0 ELSE 8.0 END::DOUBLE AS ratio, before, after FROM p LEFT JOIN b USING (event_id) LEFT JOIN a USING (event_id))
SELECT event_id, CASE WHEN before > 0 AND after > 0 AND abs(ln(after / before * ratio)) < abs(ln(after / before / ratio)) - ln(2.0) THEN 1 / ratio ELSE ratio END AS ratio FROM r""")
def split_direction(spark, sf_dir):
    bought = _timed(spark, sf_dir, "purchase").drop("value").withColumn("ratio", F.when(F.col("event_id") % 3 == 0, 0.25).when(F.col("event_id") % 3 == 1, 2.0).otherwise(8.0))
    found = matching.neighbours(bought, _timed(spark, sf_dir, "view"), ["user_id"], "t", "t", "value", shift=(lambda t: t - 3600, lambda t: t + 3600))
    return found.select("event_id", scalars.corrected_ratio(F.col("ratio"), F.col("before.value"), F.col("after.value")).alias("ratio"))


_RATIO = "CASE event_id % 3 WHEN 0 THEN 0.5 WHEN 1 THEN 1.0 ELSE 2.0 END::DOUBLE"
_FACTORS = f"""p AS (SELECT user_id, event_id, value, ts FROM events WHERE event_type = 'purchase'), s AS (SELECT user_id, ts, {_RATIO} AS ratio FROM events WHERE event_type = 'signup'),
f AS (SELECT p.event_id, p.value, coalesce((SELECT product(s.ratio) FROM s WHERE s.user_id = p.user_id AND s.ts > p.ts), 1.0) AS factor FROM p)"""


def _factored(spark, sf_dir) -> DataFrame:
    e = table(spark, sf_dir, "events")
    ratio = F.when(F.col("event_id") % 3 == 0, 0.5).when(F.col("event_id") % 3 == 1, 1.0).otherwise(2.0)
    changes = e.filter("event_type = 'signup'").select("user_id", "ts", ratio.alias("ratio"))
    return matching.later_product(e.filter("event_type = 'purchase'"), changes, ["user_id"], "ts", "ts", "ratio")


@query(f"WITH {_FACTORS} SELECT event_id, factor FROM f")
def cumulative_factor(spark, sf_dir):
    return _factored(spark, sf_dir).select("event_id", "factor")


@query(f"WITH {_FACTORS} SELECT event_id, value / factor AS based FROM f")
def basis_normalize(spark, sf_dir):
    return _factored(spark, sf_dir).select("event_id", (F.col("value") / F.col("factor")).alias("based"))


@query("""WITH o AS (SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS s, CAST(o_orderdate AS DATE) + CAST(10 + o_orderkey % 60 AS INT) AS e FROM orders)
SELECT o_orderkey FROM o a WHERE o_orderkey % 2 = 1 AND NOT EXISTS (SELECT 1 FROM o b WHERE b.o_orderkey % 2 = 0 AND b.o_custkey = a.o_custkey
AND date_diff('day', greatest(a.s, b.s), least(a.e, b.e)) + 1 >= 20)""")
def overlap_anti(spark, sf_dir):
    start = F.to_date("o_orderdate")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", start.alias("period_start"), F.date_add(start, (10 + F.col("o_orderkey") % 60).cast("int")).alias("period_end"))
    return matching.not_overlapping(o.filter("o_orderkey % 2 = 1"), o.filter("o_orderkey % 2 = 0"), ["o_custkey"], 20).select("o_orderkey")


_VARIANTS = """up AS (SELECT p_partkey, upper(trim(p_name)) AS u FROM parts), ds AS (SELECT p_partkey, u, regexp_replace(regexp_replace(u, '[. ]', '-', 'g'), '-{2,}', '-', 'g') AS d FROM up),
va AS (SELECT p_partkey, [u, d, replace(d, '-', '.'), replace(d, '-', ' ')] AS v FROM ds)"""
_PARTS = "parts AS (SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN replace(p_name, ' ', '.') WHEN 1 THEN replace(p_name, ' ', '  ') ELSE p_name END AS p_name FROM part)"


def _parts_named(spark, sf_dir) -> DataFrame:
    k = F.col("p_partkey") % 3
    return table(spark, sf_dir, "part").select("p_partkey", F.when(k == 0, F.regexp_replace("p_name", " ", ".")).when(k == 1, F.regexp_replace("p_name", " ", "  ")).otherwise(F.col("p_name")).alias("p_name"))


@query(f"WITH {_PARTS}, {_VARIANTS} SELECT p_partkey, d AS symbol FROM ds")
def canonical_symbol(spark, sf_dir):
    return _parts_named(spark, sf_dir).select("p_partkey", scalars.canonical_symbol(F.col("p_name")).alias("symbol"))


@query(f"""WITH {_PARTS}, {_VARIANTS}, x AS (SELECT p_partkey, unnest(v) AS s, unnest(range(1, 5)) AS i FROM va), d2 AS (SELECT p_partkey, s, min(i) AS i FROM x WHERE s <> '' GROUP BY ALL)
SELECT p_partkey, string_agg(s, '|' ORDER BY i) AS variants FROM d2 GROUP BY p_partkey""")
def symbol_variants(spark, sf_dir):
    return _parts_named(spark, sf_dir).select("p_partkey", F.array_join(scalars.symbol_variants(F.col("p_name")), "|").alias("variants"))


_LOOKUP = "lk AS (SELECT upper(replace(p_name, ' ', '-')) AS t, max(p_partkey) AS cik FROM part WHERE p_partkey % 5 <> 0 AND p_name >= 'h' GROUP BY 1), ask AS (SELECT DISTINCT p_name FROM parts)"
_RESOLVED = f"""{_PARTS}, {_LOOKUP}, v AS (SELECT upper(trim(p_name)) AS ticker, regexp_replace(regexp_replace(upper(trim(p_name)), '[. ]', '-', 'g'), '-{{2,}}', '-', 'g') AS d FROM ask),
re AS (SELECT DISTINCT v.ticker, coalesce(a.cik, b.cik) AS cik FROM v LEFT JOIN lk a ON a.t = v.ticker LEFT JOIN lk b ON b.t = v.d)"""


def _resolved(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    asked = _parts_named(spark, sf_dir).select(F.col("p_name").alias("ticker")).distinct()
    known = table(spark, sf_dir, "part").filter("p_partkey % 5 <> 0 AND p_name >= 'h'").select(F.regexp_replace("p_name", " ", "-").alias("ticker"), F.col("p_partkey").alias("cik"))
    return asked, matching.resolve_symbols(asked, known)


@query(f"WITH {_RESOLVED} SELECT ticker, cik FROM re WHERE cik IS NOT NULL")
def resolve_variants(spark, sf_dir):
    return _resolved(spark, sf_dir)[1]


@query(f"WITH {_RESOLVED} SELECT p_name AS ticker FROM ask WHERE upper(trim(p_name)) IN (SELECT ticker FROM re WHERE cik IS NULL)")
def unresolved(spark, sf_dir):
    return matching.unresolved(*_resolved(spark, sf_dir))


# --- periods -------------------------------------------------------------------------------------------------------

_SPAN = "CASE WHEN s IS NULL THEN 'instant' WHEN n BETWEEN 25 AND 35 THEN 'monthly' WHEN n BETWEEN 70 AND 100 THEN 'quarterly' WHEN n BETWEEN 150 AND 200 THEN 'semiannual' WHEN n BETWEEN 330 AND 400 THEN 'annual' ELSE 'other' END"


@query(f"WITH o AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS s, CAST(o_orderkey % 420 AS INT) AS n FROM orders) SELECT o_orderkey, {_SPAN} AS span FROM o")
def classify_span(spark, sf_dir):
    start = F.to_date("o_orderdate")
    return table(spark, sf_dir, "orders").select("o_orderkey", scalars.classify_span(start, F.date_add(start, (F.col("o_orderkey") % 420).cast("int"))).alias("span"))


@query(f"""WITH o AS (SELECT o_orderkey, CASE WHEN o_orderkey % 4 <> 0 THEN CAST(o_orderdate AS DATE) END AS s, CAST(o_orderdate AS DATE) + 90 AS e, 90 AS n FROM orders)
SELECT o_orderkey, {_SPAN} AS span, CAST(coalesce(s, e) AS VARCHAR) AS interval_start FROM o""")
def span_null_start(spark, sf_dir):
    end = F.date_add(F.to_date("o_orderdate"), 90)
    start = F.when(F.col("o_orderkey") % 4 != 0, F.to_date("o_orderdate"))
    return table(spark, sf_dir, "orders").select("o_orderkey", scalars.classify_span(start, end).alias("span"), F.date_format(scalars.interval_start(start, end), "yyyy-MM-dd").alias("interval_start"))


_FLAGRANK = "CASE l_returnflag WHEN 'R' THEN 0 WHEN 'A' THEN 1 ELSE 2 END"
_FLAGS = ("R", "A", "N")  # return flags stand for the tags, in their order


def _line_facts(spark, sf_dir, tags: tuple[str, ...], tie, start=None, end=None) -> DataFrame:
    """Order lines as facts: a company per order, filed when shipped, one period unless told otherwise."""
    rank = F.when(F.col("l_returnflag") == "R", 0).when(F.col("l_returnflag") == "A", 1).otherwise(2)
    tag = F.element_at(F.array(*[F.lit(t) for t in tags]), rank + 1) if len(tags) > 1 else F.lit(tags[0])
    lines = table(spark, sf_dir, "lineitem")
    start, end = F.lit(start).cast("date"), F.to_date(F.lit("2000-03-31")) if end is None else end
    return lines.select(F.col("l_orderkey").alias("cik"), tag.alias("tag"), F.lit("USD/shares" if len(tags) > 1 else "USD").alias("unit"), tie.cast("bigint").alias("ord"), start.alias("start"), end.alias("end"), F.col("l_extendedprice").alias("val"), F.to_date("l_shipdate").alias("filed"), "l_linenumber")


def _no_splits(spark) -> DataFrame:
    return spark.createDataFrame([], "cik bigint, effective_date date, ratio double")


_CENTS = "round(l_extendedprice * 100)"


@query(f"""SELECT l_orderkey, l_returnflag, l_extendedprice FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY {_FLAGRANK}, l_shipdate DESC, l_extendedprice DESC) AS n FROM lineitem) WHERE n = 1""")
def tag_priority_dedupe(spark, sf_dir):
    best = facts.per_share_periods(_line_facts(spark, sf_dir, specs.DPS_TAGS, F.expr(_CENTS)), _no_splits(spark))
    flag = F.element_at(F.array(*[F.lit(f) for f in _FLAGS]), F.array_position(F.array(*[F.lit(t) for t in specs.DPS_TAGS]), F.col("source_tag")).cast("int"))
    return best.select(F.col("cik").alias("l_orderkey"), flag.alias("l_returnflag"), F.col("dps").alias("l_extendedprice"))


@query("SELECT l_orderkey, l_linenumber, max(l_extendedprice) > 0 AND (max(l_extendedprice) - min(l_extendedprice)) / max(l_extendedprice) > 0.015 AS disagree FROM lineitem GROUP BY ALL")
def restatement_flag(spark, sf_dir):
    """A line number of an order is a period, so that it can be filed more than once."""
    first = F.to_date(F.lit("2000-01-01"))
    periods = facts.per_share_periods(_line_facts(spark, sf_dir, specs.DPS_TAGS, F.expr(_CENTS), end=F.date_add(first, F.col("l_linenumber"))), _no_splits(spark))
    return periods.select(F.col("cik").alias("l_orderkey"), F.datediff("period_end", first).alias("l_linenumber"), F.array_contains("flags", "restatement_disagreement").alias("disagree"))


@query("SELECT l_orderkey, l_extendedprice FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC, l_linenumber, l_extendedprice) AS n FROM lineitem) WHERE n = 1")
def latest_filed_first_tie(spark, sf_dir):
    tie = F.expr(f"l_linenumber * 10000000000L + {_CENTS}")
    return facts.cash_quarters(_line_facts(spark, sf_dir, specs.CASH_TAGS[:1], tie, start="2000-01-01")).select(F.col("cik").alias("l_orderkey"), F.col("value").alias("l_extendedprice"))


_QUARTERS = """o AS (SELECT o_custkey AS cik, year(o_orderdate) AS y, quarter(o_orderdate) AS q, sum(round(o_totalprice * 100)) / 100 AS v FROM orders GROUP BY ALL),
a AS (SELECT cik, y, sum(round(v * 100)) / 100 AS v FROM o GROUP BY ALL), k AS (SELECT cik, y, count(*) AS n, sum(round(v * 100)) / 100 AS v FROM o WHERE q < 4 GROUP BY ALL)"""


def _records(spark, sf_dir) -> DataFrame:
    """Customers as companies: yearly totals as annual records, the first three quarters as quarterly ones."""
    o = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("cik"), F.year("o_orderdate").alias("y"), F.quarter("o_orderdate").alias("q"), F.round(F.col("o_totalprice") * 100).alias("c"))
    by_quarter = o.groupBy("cik", "y", "q").agg((F.sum("c") / 100).alias("v"))
    quarter = by_quarter.filter("q < 4").select(
        "cik", F.make_date("y", (F.col("q") - 1) * 3 + 1, F.lit(1)).alias("period_start"), F.last_day(F.make_date("y", F.col("q") * 3, F.lit(1))).alias("period_end"), F.lit("quarterly").alias("span_type"), F.col("v").alias("dps")
    )
    year = by_quarter.groupBy("cik", "y").agg((F.sum(F.round(F.col("v") * 100)) / 100).alias("v")).select(
        "cik", F.make_date("y", F.lit(1), F.lit(1)).alias("period_start"), F.make_date("y", F.lit(12), F.lit(31)).alias("period_end"), F.lit("annual").alias("span_type"), F.col("v").alias("dps")
    )
    return quarter.unionByName(year).withColumn("source_tag", F.lit("orders")).withColumn("filed", F.col("period_end"))


@query(f"""WITH {_QUARTERS} SELECT a.cik, a.y || '-10-01' AS period_start, a.y || '-12-31' AS period_end, round(a.v - k.v, 2) AS value FROM a JOIN k USING (cik, y) WHERE k.n = 3 AND a.v - k.v >= -0.005""")
def derive_q4(spark, sf_dir):
    return facts.missing_quarters(_records(spark, sf_dir)).select("cik", day("period_start"), day("period_end"), F.round("dps", 2).alias("value"))


@query(f"""WITH {_QUARTERS}, m AS (SELECT DISTINCT o_custkey AS cik, year(o_orderdate) AS y FROM orders WHERE month(o_orderdate) = 11 AND o_orderkey % 2 = 0)
SELECT a.cik, a.y || '-12-31' AS period_end, round(a.v - k.v, 2) AS value FROM a JOIN k USING (cik, y) WHERE k.n = 3 AND a.v - k.v >= -0.005 AND NOT EXISTS (SELECT 1 FROM m WHERE m.cik = a.cik AND m.y = a.y)""")
def derive_q4_blocked(spark, sf_dir):
    blocks = table(spark, sf_dir, "orders").filter((F.month("o_orderdate") == 11) & (F.col("o_orderkey") % 2 == 0)).select(F.col("o_custkey").alias("cik"), F.to_date("o_orderdate").alias("period_end"))
    instants = blocks.distinct().select("cik", F.lit(None).cast("date").alias("period_start"), "period_end", F.lit("instant").alias("span_type"), F.lit(0.0).alias("dps"), F.lit("orders").alias("source_tag"), F.col("period_end").alias("filed"))
    return facts.missing_quarters(_records(spark, sf_dir).unionByName(instants)).select("cik", day("period_end"), F.round("dps", 2).alias("value"))


_ODATES = "RECURSIVE d AS (SELECT DISTINCT o_custkey AS k, CAST(o_orderdate AS DATE) AS d FROM orders), n AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY d) AS i FROM d)"


def _order_days(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("custkey")).agg(F.array_sort(F.collect_set(F.to_date("o_orderdate"))).alias("days"))


@query(f"""WITH {_ODATES}, r AS (SELECT k, i, d, d AS last, TRUE AS ok FROM n WHERE i = 1 UNION ALL
SELECT n.k, n.i, n.d, CASE WHEN n.d - r.last > 10 THEN n.d ELSE r.last END, n.d - r.last > 10 FROM r JOIN n ON n.k = r.k AND n.i = r.i + 1)
SELECT k AS custkey, CAST(d AS VARCHAR) AS day FROM r WHERE ok""")
def greedy_suppress(spark, sf_dir):
    kept = _order_days(spark, sf_dir).select("custkey", F.explode(folds.accepted_days(F.col("days"), 10)).alias("day"))
    return kept.select("custkey", day("day"))


@query(f"""WITH {_ODATES}, r AS (SELECT k, i, d, d AS leader FROM n WHERE i = 1 UNION ALL
SELECT n.k, n.i, n.d, CASE WHEN n.d - r.leader > 30 THEN n.d ELSE r.leader END FROM r JOIN n ON n.k = r.k AND n.i = r.i + 1)
SELECT k AS custkey, CAST(d AS VARCHAR) AS day, CAST(leader AS VARCHAR) AS leader FROM r""")
def anchored_groups(spark, sf_dir):
    led = _order_days(spark, sf_dir).select("custkey", F.explode(folds.leader_days(F.col("days"), 30)).alias("l"))
    return led.select("custkey", day("l.day"), day("l.leader"))


@query("""WITH m AS (SELECT o_custkey AS cik, year(o_orderdate) AS y, CAST(o_orderdate AS DATE) AS d, sum(round(o_totalprice * 100)) AS c FROM orders GROUP BY ALL),
r AS (SELECT cik, y, d, sum(c) OVER (PARTITION BY cik, y ORDER BY d) AS ytd FROM m)
SELECT cik, CAST(y AS INT) AS y, CAST(d AS VARCHAR) AS d, round((ytd - coalesce(lag(ytd) OVER (PARTITION BY cik, y ORDER BY d), 0)) / 100, 2) AS value FROM r""")
def ytd_difference(spark, sf_dir):
    """Yearly running totals of a customer's orders, in cents, as cash facts since the first of January."""
    m = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("cik"), F.year("o_orderdate").alias("y"), F.to_date("o_orderdate").alias("end")).agg(F.sum(F.round(F.col("o_totalprice") * 100)).alias("c"))
    total = F.sum("c").over(Window.partitionBy("cik", "y").orderBy("end").rowsBetween(Window.unboundedPreceding, 0))
    paid = m.select("cik", F.lit(specs.CASH_TAGS[0]).alias("tag"), F.lit("USD").alias("unit"), F.lit(0).cast("bigint").alias("ord"), F.make_date("y", F.lit(1), F.lit(1)).alias("start"), "end", total.alias("val"), F.col("end").alias("filed"))
    return facts.cash_quarters(paid).select("cik", F.year("period_end").alias("y"), F.date_format("period_end", "yyyy-MM-dd").alias("d"), F.round(F.col("value") / 100, 2).alias("value"))


@query("""WITH r AS (SELECT *, CAST(ts AS DATE) AS d, CASE event_type WHEN 'purchase' THEN 0 WHEN 'signup' THEN 1 WHEN 'click' THEN 2 ELSE 3 END AS i FROM events)
SELECT user_id, event_id FROM r QUALIFY i = min(i) OVER (PARTITION BY user_id, d)""")
def first_tag_wins(spark, sf_dir):
    """Of a user's events of a day those of the best type; all events take part."""
    kind = F.col("event_type")
    i = F.when(kind == "purchase", 0).when(kind == "signup", 1).when(kind == "click", 2).otherwise(3)
    rows = table(spark, sf_dir, "events").select("user_id", "event_id", F.to_date("ts").alias("d"), i.alias("i"))
    return facts.first_tag(rows, ["user_id", "d"], "i").select("user_id", "event_id")


_FACT_SPANS = """f AS (SELECT l_suppkey AS cik, CAST(CASE l_returnflag WHEN 'R' THEN 0 WHEN 'A' THEN 1 ELSE 2 END AS INT) AS i, CASE WHEN l_linenumber % 3 = 0 THEN 'pure' WHEN l_linenumber % 7 = 1 THEN 'shares' ELSE 'USD/shares' END AS unit,
CAST(l_orderkey * 1000 + l_linenumber * 100 + l_quantity AS BIGINT) AS ord, CASE WHEN l_linenumber % 5 <> 4 THEN CAST(date_trunc('quarter', l_shipdate) AS DATE) END AS start, CAST(CAST(date_trunc('quarter', l_shipdate) AS DATE) + INTERVAL 3 MONTH AS DATE) - 1 AS e,
CASE WHEN l_quantity > 45 THEN -1 ELSE l_quantity END AS val, CASE WHEN l_orderkey % 11 <> 0 THEN CAST(l_shipdate AS DATE) + CAST(l_orderkey % 90 AS INT) END AS filed FROM lineitem),
ok AS (SELECT * FROM f WHERE unit <> 'shares' AND val >= 0 AND filed IS NOT NULL)"""


def _quarter_facts(spark, sf_dir) -> DataFrame:
    """Order lines as per-share facts of suppliers: quarters or instants, three units, some without a filing date or below zero."""
    rank = F.when(F.col("l_returnflag") == "R", 0).when(F.col("l_returnflag") == "A", 1).otherwise(2)
    quarter = F.to_date(F.date_trunc("quarter", "l_shipdate"))
    number = F.col("l_linenumber")
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("cik"), F.element_at(F.array(*[F.lit(t) for t in specs.DPS_TAGS]), rank + 1).alias("tag"),
        F.when(number % 3 == 0, "pure").when(number % 7 == 1, "shares").otherwise("USD/shares").alias("unit"), (F.col("l_orderkey") * 1000 + number * 100 + F.col("l_quantity")).cast("bigint").alias("ord"),
        F.when(number % 5 != 4, quarter).alias("start"), F.date_sub(F.add_months(quarter, 3), 1).alias("end"), F.when(F.col("l_quantity") > 45, -1.0).otherwise(F.col("l_quantity")).alias("val"),
        F.when(F.col("l_orderkey") % 11 != 0, F.date_add(F.to_date("l_shipdate"), (F.col("l_orderkey") % 90).cast("int"))).alias("filed"),
    )


@query(f"WITH {_FACT_SPANS} SELECT cik, i AS tag_no, unit, ord, val FROM ok")
def per_share_facts(spark, sf_dir):
    tag_no = F.array_position(F.array(*[F.lit(t) for t in specs.DPS_TAGS]), F.col("tag")) - 1
    return facts.per_share_facts(_quarter_facts(spark, sf_dir)).select("cik", tag_no.cast("int").alias("tag_no"), "unit", "ord", "val")


_RATIOS = "sp AS (SELECT o_custkey % 100 AS cik, CAST(o_orderdate AS DATE) AS d, CASE o_orderkey % 3 WHEN 0 THEN 0.5 WHEN 1 THEN 2.0 ELSE 4.0 END::DOUBLE AS ratio FROM orders WHERE o_orderpriority LIKE '1%' AND o_totalprice < 20000)"


def _later_splits(spark, sf_dir) -> DataFrame:
    ratio = F.when(F.col("o_orderkey") % 3 == 0, 0.5).when(F.col("o_orderkey") % 3 == 1, 2.0).otherwise(4.0)
    small = table(spark, sf_dir, "orders").filter("o_orderpriority LIKE '1%' AND o_totalprice < 20000")
    return small.select((F.col("o_custkey") % 100).alias("cik"), F.to_date("o_orderdate").alias("effective_date"), ratio.alias("ratio"))


_PER_SHARE = """fd AS (SELECT DISTINCT cik, filed FROM ok), fa AS (SELECT fd.cik, fd.filed, product(sp.ratio) AS factor FROM fd JOIN sp ON sp.cik = fd.cik AND sp.d > fd.filed GROUP BY ALL),
b AS (SELECT ok.*, val / coalesce(factor, 1.0) AS dps FROM ok LEFT JOIN fa USING (cik, filed)),
k AS (SELECT *, row_number() OVER (PARTITION BY cik, start, e ORDER BY i, filed DESC, ord DESC) AS n, max(dps) OVER (PARTITION BY cik, start, e) AS hi, min(dps) OVER (PARTITION BY cik, start, e) AS lo FROM b)"""


@query(f"""WITH {_FACT_SPANS}, {_RATIOS}, {_PER_SHARE}
SELECT cik, CAST(start AS VARCHAR) AS period_start, CAST(e AS VARCHAR) AS period_end, CASE WHEN start IS NULL THEN 'instant' WHEN e - start BETWEEN 70 AND 100 THEN 'quarterly' END AS span_type, dps, i AS tag_no, CAST(filed AS VARCHAR) AS filed,
CASE WHEN unit = 'pure' THEN 'suspect_unit,' ELSE '' END || CASE WHEN hi > 0 AND (hi - lo) / hi > 0.015 THEN 'restatement_disagreement' ELSE '' END AS flags FROM k WHERE n = 1""")
def per_share_periods(spark, sf_dir):
    """Per-share records on today's share basis, from facts of three tags and the splits after their filing."""
    found = facts.per_share_periods(_quarter_facts(spark, sf_dir), _later_splits(spark, sf_dir))
    tag_no = F.array_position(F.array(*[F.lit(t) for t in specs.DPS_TAGS]), F.col("source_tag")) - 1
    has = lambda f: F.array_contains("flags", f)
    flags_ = F.concat(F.when(has("suspect_unit"), "suspect_unit,").otherwise(""), F.when(has("restatement_disagreement"), "restatement_disagreement").otherwise(""))
    return found.select("cik", day("period_start"), day("period_end"), "span_type", "dps", tag_no.cast("int").alias("tag_no"), day("filed"), flags_.alias("flags"))


_SPLIT_FACTS = """f AS (SELECT o_custkey AS cik, CASE WHEN o_orderkey % 13 = 0 THEN 'other' ELSE 'split' END AS tag, CASE o_orderkey % 6 WHEN 0 THEN 2.0 WHEN 1 THEN 0.5 WHEN 2 THEN 150.0 WHEN 3 THEN 1.0 WHEN 4 THEN 0.0 ELSE 8.0 END::DOUBLE AS val,
CASE WHEN o_orderkey % 4 <> 0 THEN CAST(o_orderdate AS DATE) - CAST(o_orderkey % 90 AS INT) END AS start, CAST(o_orderdate AS DATE) AS e, CAST(o_orderdate AS DATE) + 30 AS filed FROM orders),
c AS (SELECT cik, val AS ratio, e, filed, (start IS NULL OR e - start <= 45) AND val BETWEEN 0.005 AND 100 AS high FROM f WHERE tag = 'split' AND val > 0 AND val <> 1),
g AS (SELECT *, CASE WHEN e - lag(e) OVER w <= 370 THEN 0 ELSE 1 END AS s FROM c WINDOW w AS (PARTITION BY cik, ratio ORDER BY e)),
n AS (SELECT *, sum(s) OVER (PARTITION BY cik, ratio ORDER BY e) AS k FROM g),
cl AS (SELECT cik, ratio, min(e) AS d, min(filed) AS filed, bool_or(high) AS high FROM n GROUP BY cik, ratio, k)"""


def _share_counts(spark, sf_dir) -> DataFrame:
    """Five yearly share counts of each customer."""
    counts = F.array(*[F.struct(F.to_date(F.lit(f"{y}-06-30")).alias("end"), F.lit(v).alias("v")) for y, v in zip(range(1996, 2001), (1.0, 2.0, 9.0, 8.0, 1.0), strict=True)])
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("cik"), F.explode(counts).alias("s")).select("cik", "s.end", (F.col("s.v") * (1 + F.col("cik") % 3)).alias("val"))


def _split_facts(spark, sf_dir) -> DataFrame:
    key, end = F.col("o_orderkey"), F.to_date("o_orderdate")
    val = F.when(key % 6 == 0, 2.0).when(key % 6 == 1, 0.5).when(key % 6 == 2, 150.0).when(key % 6 == 3, 1.0).when(key % 6 == 4, 0.0).otherwise(8.0)
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("cik"), F.when(key % 13 == 0, "other").otherwise(specs.SPLIT_TAG).alias("tag"), F.lit("pure").alias("unit"), val.alias("val"),
        F.when(key % 4 != 0, F.date_sub(end, (key % 90).cast("int"))).alias("start"), end.alias("end"), F.date_add(end, 30).alias("filed"),
    )


@query(f"WITH {_SPLIT_FACTS} SELECT cik, ratio, CAST(e AS VARCHAR) AS end, CAST(filed AS VARCHAR) AS filed, high FROM c")
def split_candidates(spark, sf_dir):
    return facts.split_candidates(_split_facts(spark, sf_dir)).select("cik", "ratio", day("end"), day("filed"), "high")


@query(f"""WITH {_SPLIT_FACTS}, sh AS (SELECT c_custkey AS cik, unnest([DATE '1996-06-30', DATE '1997-06-30', DATE '1998-06-30', DATE '1999-06-30', DATE '2000-06-30']) AS e, unnest([1.0, 2.0, 9.0, 8.0, 1.0]) * (1 + c_custkey % 3) AS val FROM customer),
b AS (SELECT cl.cik, cl.ratio, cl.d, cl.filed, cl.high, arg_max(sh.val, sh.e) AS before, max(sh.e) AS be FROM cl LEFT JOIN sh ON sh.cik = cl.cik AND sh.e <= cl.d - 10 GROUP BY ALL),
a AS (SELECT b.*, arg_min(sh.val, sh.e) AS after, min(sh.e) AS ae FROM b LEFT JOIN sh ON sh.cik = b.cik AND sh.e >= b.d + 10 GROUP BY ALL),
w AS (SELECT *, CASE WHEN d - be <= 270 THEN before END AS x, CASE WHEN ae - d <= 270 THEN after END AS y FROM a),
t AS (SELECT *, x > 0 AND y > 0 AND abs(ln(y / x * ratio)) < abs(ln(y / x / ratio)) - ln(2.0) AS turned FROM w)
SELECT cik, CAST(d AS VARCHAR) AS effective_date, CASE WHEN turned THEN 1 / ratio ELSE ratio END AS ratio, CASE WHEN high THEN 'high' ELSE 'low' END AS confidence, CAST(filed AS VARCHAR) AS filed,
CASE WHEN turned THEN 'direction_inverted_by_share_check' ELSE '' END AS flags FROM t""")
def split_events(spark, sf_dir):
    """Splits from facts: candidates, chains of equal ratios, direction checked against share counts."""
    found = facts.splits(_split_facts(spark, sf_dir), _share_counts(spark, sf_dir))
    return found.select("cik", day("effective_date"), "ratio", "confidence", day("filed"), F.array_join("flags", ",").alias("flags"))


_SHARE_DAYS = ("1996-06-30", "1997-06-30", "1998-06-30", "1999-06-30", "2000-06-30")


_CASH = f"""q AS (SELECT o_custkey AS cik, CASE WHEN o_orderpriority < '3' AND o_custkey % 3 <> 0 THEN 0 ELSE 1 END AS i, year(o_orderdate) AS y, quarter(o_orderdate) AS q, sum(round(o_totalprice * 100)) AS c FROM orders GROUP BY ALL),
t AS (SELECT cik, i, y, q, sum(c) OVER (PARTITION BY cik, i, y ORDER BY q) AS ytd, make_date(y, 1, 1) AS s, CAST(make_date(y, q * 3, 1) + INTERVAL 1 MONTH AS DATE) - 1 AS e FROM q),
d AS (SELECT cik, i, coalesce(lag(e) OVER w + 1, s) AS ps, e AS pe, ytd - coalesce(lag(ytd) OVER w, 0) AS v FROM t WINDOW w AS (PARTITION BY cik, i, y ORDER BY q)),
k AS (SELECT *, CASE WHEN pe - ps BETWEEN 25 AND 35 THEN 'monthly' WHEN pe - ps BETWEEN 70 AND 100 THEN 'quarterly' WHEN pe - ps BETWEEN 150 AND 200 THEN 'semiannual' END AS span FROM d),
sh AS (SELECT c_custkey AS cik, unnest([{", ".join(f"DATE '{d}'" for d in _SHARE_DAYS)}]) AS e, unnest([1.0, 2.0, 9.0, 8.0, 1.0]) * (1 + c_custkey % 3) AS val FROM customer),
m AS (SELECT k.*, sh.e AS at, sh.val, row_number() OVER (PARTITION BY k.cik, i, ps, pe ORDER BY abs(sh.e - pe), sh.e) AS n FROM k JOIN sh ON sh.cik = k.cik AND abs(sh.e - pe) <= 180 WHERE span IS NOT NULL),
f AS (SELECT m.*, (SELECT product(sp.ratio) FROM sp WHERE sp.cik = m.cik AND sp.d > m.at) AS factor FROM m WHERE n = 1),
cash AS (SELECT cik, ps, pe, span, greatest(v, 0) / val / coalesce(factor, 1.0) AS dps, CAST(i AS INT) AS tag_no FROM f QUALIFY i = min(i) OVER (PARTITION BY cik))"""


@query(f"WITH {_RATIOS}, {_CASH} SELECT cik, CAST(ps AS VARCHAR) AS period_start, CAST(pe AS VARCHAR) AS period_end, span AS span_type, dps, tag_no FROM cash")
def cash_per_share(spark, sf_dir):
    """Approximate per-share records: yearly running totals of two tags over the nearest share count, on today's basis; one tag per company."""
    found = facts.cash_fallback(_cash_facts(spark, sf_dir), _share_counts(spark, sf_dir), _later_splits(spark, sf_dir))
    index = F.array_position(F.array(*[F.lit(t) for t in specs.CASH_TAGS]), F.col("source_tag")) - 1
    return found.select("cik", day("period_start"), day("period_end"), "span_type", "dps", index.cast("int").alias("tag_no"))


_CASH_FACTS = _CASH.replace("f AS (SELECT m.*", "cf AS (SELECT m.*").replace("FROM f QUALIFY", "FROM cf QUALIFY")  # the name f is taken


@query(f"""WITH {_FACT_SPANS}, {_RATIOS}, {_PER_SHARE.replace("k AS (", "ks AS (")}, {_CASH_FACTS},
p AS (SELECT cik, start AS ps, e AS pe, CASE WHEN start IS NULL THEN 'instant' ELSE 'quarterly' END AS span, dps FROM ks WHERE n = 1)
SELECT cik, CAST(ps AS VARCHAR) AS period_start, CAST(pe AS VARCHAR) AS period_end, span AS span_type, dps, FALSE AS approximate FROM p
UNION ALL SELECT cik, CAST(ps AS VARCHAR), CAST(pe AS VARCHAR), span, dps, TRUE FROM cash c
WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.cik = c.cik AND date_diff('day', greatest(c.ps, coalesce(p.ps, p.pe)), least(c.pe, p.pe)) + 1 >= 20)""")
def dividend_records(spark, sf_dir):
    """Per-share records, and cash records for the stretches that they do not cover."""
    both = _quarter_facts(spark, sf_dir).unionByName(_cash_facts(spark, sf_dir))
    found = facts.dividends(both, _share_counts(spark, sf_dir), _later_splits(spark, sf_dir))
    return found.select("cik", day("period_start"), day("period_end"), "span_type", "dps", "approximate")


def _cash_facts(spark, sf_dir) -> DataFrame:
    """A customer's orders as cash paid since the first of January, per quarter and tag."""
    tag_no = F.when((F.col("o_orderpriority") < "3") & (F.col("o_custkey") % 3 != 0), 0).otherwise(1)
    orders = table(spark, sf_dir, "orders")
    q = orders.groupBy(F.col("o_custkey").alias("cik"), tag_no.alias("i"), F.year("o_orderdate").alias("y"), F.quarter("o_orderdate").alias("q")).agg(F.sum(F.round(F.col("o_totalprice") * 100)).alias("c"))
    total = F.sum("c").over(Window.partitionBy("cik", "i", "y").orderBy("q").rowsBetween(Window.unboundedPreceding, 0))
    end = F.last_day(F.make_date("y", F.col("q") * 3, F.lit(1)))
    return q.select("cik", F.element_at(F.array(*[F.lit(t) for t in specs.CASH_TAGS]), F.col("i") + 1).alias("tag"), F.lit("USD").alias("unit"), F.lit(0).cast("bigint").alias("ord"), F.make_date("y", F.lit(1), F.lit(1)).alias("start"), end.alias("end"), total.alias("val"), end.alias("filed"))


@query("""WITH k AS (SELECT c_custkey AS cik, upper(replace(c_name, '#', '.')) AS ticker FROM customer), d AS (SELECT DISTINCT o_custkey AS cik FROM orders WHERE o_orderstatus = 'F'), b AS (SELECT s_suppkey * 7 AS cik FROM supplier)
SELECT ticker, CASE WHEN cik IN (SELECT cik FROM b) THEN 'failed' WHEN cik IN (SELECT cik FROM d) THEN 'ok' ELSE 'not_found' END AS status FROM k""")
def fetch_outcomes(spark, sf_dir):
    """Customers as resolved symbols, those with finished orders as landed documents, some numbers as failed downloads."""
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("cik"), F.upper(F.regexp_replace("c_name", "#", ".")).alias("ticker"))
    landed = table(spark, sf_dir, "orders").filter("o_orderstatus = 'F'").select(F.col("o_custkey").alias("cik"))
    failed = table(spark, sf_dir, "supplier").select((F.col("s_suppkey") * 7).alias("cik"))
    return jobs.fetch_outcomes(c, landed, failed)


@query("""SELECT c_custkey AS custkey, CASE WHEN c_custkey % 3 = 0 THEN 'old' ELSE 'customer' END || chr(31) || '{"custkey":' || c_custkey || CASE WHEN c_custkey % 3 = 0 THEN ',"segment":"' || c_mktsegment || '"' ELSE '' END || '}' AS entity FROM customer""")
def event_entities(spark, sf_dir):
    """What an event is about: the key of a known source, the whole record of a retired one."""
    c = table(spark, sf_dir, "customer").select(F.when(F.col("c_custkey") % 3 == 0, "old").otherwise("customer").alias("source"), F.struct(F.col("c_custkey").alias("custkey"), F.col("c_mktsegment").alias("segment")).alias("record"))
    return c.select("record.custkey", diff.entity_key(F.col("source"), F.col("record"), {"customer": ["custkey"]}).alias("entity"))


# --- scans, flags and policy ---------------------------------------------------------------------------------------


@query("""WITH l AS (SELECT user_id, CAST(ts AS DATE) AS d, list_distinct(list(event_type)) AS k FROM events GROUP BY ALL),
m AS (SELECT user_id, d, list_sort(list_distinct(list_filter(list_transform(k, lambda x: CASE x WHEN 'purchase' THEN 'bought' WHEN 'signup' THEN 'joined' WHEN 'error' THEN 'failed' END), lambda x: x IS NOT NULL))) AS n FROM l)
SELECT user_id, CAST(d AS VARCHAR) AS d, array_to_string(n, ',') AS event FROM m WHERE len(n) > 0""")
def flag_items(spark, sf_dir):
    e = table(spark, sf_dir, "events").groupBy("user_id", F.to_date("ts").alias("d")).agg(F.array_join(F.collect_list("event_type"), " , ").alias("items"))
    named = scalars.item_events(F.col("items"), {"purchase": "bought", "signup": "joined", "error": "failed"})
    return e.select("user_id", day("d"), named.alias("event")).filter("event IS NOT NULL")


@query("""WITH e AS (SELECT user_id, list(event_type ORDER BY event_id) AS form, list(event_id ORDER BY event_id) AS acc FROM events GROUP BY user_id)
SELECT user_id, i - 1 AS pos, form[i] AS form, CASE WHEN i <= len(acc) - user_id % 4 THEN acc[i] ELSE -1 END AS accession FROM (SELECT *, unnest(range(1, len(form) + 1)) AS i FROM e)""")
def zip_explode(spark, sf_dir):
    pairs = F.array_sort(F.collect_list(F.struct("event_id", "event_type")))
    e = table(spark, sf_dir, "events").groupBy("user_id").agg(pairs.alias("p"))
    ragged = e.select("user_id", F.col("p.event_type").alias("form"), F.slice(F.col("p.event_id"), F.lit(1), F.greatest(F.size("p") - (F.col("user_id") % 4).cast("int"), F.lit(0))).alias("accession"))
    return scans.zip_arrays(ragged, ["form", "accession"], ["user_id"]).select("user_id", F.col("pos").cast("long").alias("pos"), "form", F.coalesce("accession", F.lit(-1).cast("long")).alias("accession"))


@query("SELECT CAST(p_partkey AS VARCHAR) AS cik, p_name AS title, p_brand AS ticker FROM part")
def columnar_header(spark, sf_dir):
    packed = table(spark, sf_dir, "part").groupBy(F.floor(F.col("p_partkey") / 500).alias("b")).agg(F.collect_list(F.array(F.col("p_partkey").cast("string"), "p_name", "p_brand")).alias("data"))
    rows = packed.select(F.array(F.lit("cik"), F.lit("name"), F.lit("ticker")).alias("fields"), "data")
    return scans.columnar_rows(rows, {"cik": "cik", "title": "name", "ticker": "ticker"})


@query("SELECT p_partkey::VARCHAR AS ticker, p_name AS name, CASE WHEN p_partkey % 5 = 0 THEN '' ELSE p_brand END AS category FROM part WHERE p_partkey % 7 <> 0")
def delimited_scan(spark, sf_dir):
    """Part rows written as a pipe-delimited directory with short rows, test issues, blank lines and a trailer, and read back."""
    p = table(spark, sf_dir, "part")
    brand = F.when(F.col("p_partkey") % 5 != 0, F.concat(F.lit("|"), "p_brand")).otherwise(F.lit(""))
    lines = p.select(F.concat(F.col("p_partkey").cast("string"), F.lit("|"), "p_name", F.lit("|"), F.when(F.col("p_partkey") % 7 == 0, "Y").otherwise("N"), brand).alias("value"))
    noise = spark.createDataFrame([("",), ("File Creation Time: 0130202421:30|||",)], "value string")
    return scans.delimited_rows(lines.unionByName(noise), ["Symbol", "Security Name", "Test Issue", "Market Category"], {"ticker": "Symbol", "name": "Security Name", "category": "Market Category"})


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def json_map_scan(spark, sf_dir):
    parsed = scans.parsed(table(spark, sf_dir, "events").select("event_id", F.col("props").alias("value")), "struct<k:bigint>")
    return parsed.select("event_id", "value.k")


@query("SELECT CAST(p_partkey AS BIGINT) AS cik, p_brand AS ticker, p_name AS title FROM part")
def ticker_map_scan(spark, sf_dir):
    """Part rows written as objects of objects, whose outer keys mean nothing, and read back."""
    inner = F.struct(F.col("p_partkey").alias("cik_str"), F.col("p_brand").alias("ticker"), F.col("p_name").alias("title"))
    packed = table(spark, sf_dir, "part").groupBy(F.floor(F.col("p_partkey") / 500).alias("b")).agg(F.to_json(F.map_from_entries(F.collect_list(F.struct(F.concat(F.lit("n"), F.col("p_partkey").cast("string")), inner)))).alias("value"))
    return scans.ticker_map_rows(packed)


@query("""SELECT o_custkey AS cik, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS BIGINT) AS ord, CASE WHEN o_orderkey % 3 <> 0 THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS start,
CAST(CAST(o_orderdate AS DATE) + 90 AS VARCHAR) AS end, o_totalprice AS val FROM orders""")
def company_fact_scan(spark, sf_dir):
    """A customer's orders written as a nested fact document, and flattened again."""
    text = lambda c: F.date_format(c, "yyyy-MM-dd")
    placed = F.to_date("o_orderdate")
    item = F.struct("o_orderkey", F.when(F.col("o_orderkey") % 3 != 0, text(placed)).otherwise(F.when(F.col("o_orderkey") % 2 == 0, "")).alias("start"), text(F.date_add(placed, 90)).alias("end"), F.col("o_totalprice").alias("val"), text(F.date_add(placed, 120)).alias("filed"))
    docs = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("cik")).agg(F.array_sort(F.collect_list(item)).alias("items"))
    fact = F.create_map(F.lit("us-gaap"), F.create_map(F.lit(specs.DPS_TAGS[0]), F.struct(F.create_map(F.lit("USD/shares"), F.col("items")).alias("units"))))
    written = docs.select(F.to_json(F.struct("cik", fact.alias("facts"))).alias("value"))
    read = scans.parsed(written, schemas.COMPANY_FACTS).select("value.*")
    flat = scans.tag_facts(scans.company_facts(read), specs.DPS_TAGS[0], ("USD/shares",))
    return flat.select("cik", "ord", day("start"), day("end"), "val")


@query("""WITH e AS (SELECT user_id AS cik, event_id, event_type, CASE event_type WHEN 'view' THEN '8-K' WHEN 'click' THEN '8-K/A' WHEN 'purchase' THEN '25' WHEN 'signup' THEN '25/A' ELSE '10-Q' END AS form,
CASE event_id % 4 WHEN 0 THEN '5.02, 3.01,9.01' WHEN 1 THEN ' 4.02 ' WHEN 2 THEN '9.01' ELSE '' END AS items FROM events)
SELECT cik, form, 'a' || event_id AS accession, items, CASE WHEN form = '25' THEN 'delisting_form' WHEN event_id % 4 = 0 THEN 'delisting_notice,officer_departure' ELSE 'non_reliance_on_financials' END AS event
FROM e WHERE form = '25' OR (form LIKE '8-K%' AND event_id % 4 < 2)""")
def flagged_filings(spark, sf_dir):
    """A user's events as the parallel arrays of a filer, flagged by form and item."""
    kind, key = F.col("event_type"), F.col("event_id")
    form = F.when(kind == "view", "8-K").when(kind == "click", "8-K/A").when(kind == "purchase", "25").when(kind == "signup", "25/A").otherwise("10-Q")
    items = F.when(key % 4 == 0, "5.02, 3.01,9.01").when(key % 4 == 1, " 4.02 ").when(key % 4 == 2, "9.01").otherwise("")
    one = F.struct("event_id", form.alias("form"), items.alias("items"), F.date_format("ts", "yyyy-MM-dd").alias("day"))
    filers = table(spark, sf_dir, "events").groupBy("user_id").agg(F.array_sort(F.collect_list(one)).alias("f"))
    recent = F.struct(F.col("f.form").alias("form"), F.col("f.day").alias("filingDate"), F.transform("f.event_id", lambda i: F.concat(F.lit("a"), i.cast("string"))).alias("accessionNumber"), F.col("f.items").alias("items"))
    payload = filers.select(F.lpad(F.col("user_id").cast("string"), 10, "0").alias("cik"), F.struct(recent.alias("recent")).alias("filings"))
    return flags.flagged_filings(scans.submissions(payload)).select("cik", "form", "accession", "items", "event")


@query("""WITH e AS (SELECT user_id AS cik, event_id, event_id % 5 = 0 AS old, CASE WHEN event_type <> 'error' THEN event_type || event_id % 7 END AS accession FROM events)
SELECT cik, accession, min(event_id) AS event_id FROM e WHERE NOT old AND NOT EXISTS (SELECT 1 FROM e o WHERE o.old AND o.cik = e.cik AND o.accession IS NOT DISTINCT FROM e.accession) GROUP BY ALL""")
def new_by_company_and_accession(spark, sf_dir):
    """Events not in the log yet, which holds every fifth; a null accession equals a null one."""
    accession = F.when(F.col("event_type") != "error", F.concat("event_type", (F.col("event_id") % 7).cast("string")))
    e = table(spark, sf_dir, "events").select(F.col("user_id").alias("cik"), accession.alias("accession"), "event_id")
    return flags.add_new(e.filter("event_id % 5 = 0"), e.filter("event_id % 5 <> 0"), ["event_id"])


@query("""WITH t AS (SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN strftime(o_orderdate, '%Y/%m/%d') WHEN 2 THEN strftime(o_orderdate, '%Y-%m-31') WHEN 3 THEN NULL ELSE strftime(o_orderdate, '%Y-%m') END AS s FROM orders)
SELECT o_orderkey, CASE WHEN regexp_full_match(s, '[0-9]{4}-[0-9]{2}-[0-9]{2}') THEN CAST(TRY_CAST(s AS DATE) AS VARCHAR) END AS d FROM t""")
def strict_dates(spark, sf_dir):
    key = F.col("o_orderkey") % 5
    text = F.when(key == 0, F.date_format("o_orderdate", "yyyy-MM-dd")).when(key == 1, F.date_format("o_orderdate", "yyyy/MM/dd")).when(key == 2, F.date_format("o_orderdate", "yyyy-MM-'31'")).when(key == 4, F.date_format("o_orderdate", "yyyy-MM"))
    return table(spark, sf_dir, "orders").select("o_orderkey", scalars.iso_date(text).alias("d")).select("o_orderkey", day("d"))


@query("""SELECT '{"custkey":' || c_custkey || ',"name":"' || c_name || '","segment":' || CASE WHEN c_custkey % 4 = 0 THEN 'null' ELSE '"' || c_mktsegment || '"' END || '}' AS value FROM customer""")
def canonical_json(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(F.when(F.col("c_custkey") % 4 != 0, F.col("c_mktsegment")).alias("segment"), F.col("c_name").alias("name"), F.col("c_custkey").alias("custkey"))
    return publish.canonical_json(c)


@query("SELECT c_mktsegment AS exchange, c_name AS ticker FROM (SELECT *, row_number() OVER (PARTITION BY upper(c_name) ORDER BY c_custkey) AS n FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY') AND c_name <> '') WHERE n = 1")
def listed_filter(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("exchange"), F.col("c_name").alias("ticker"), F.col("c_custkey").alias("ord"))
    return scans.listed(c, ("BUILDING", "MACHINERY")).select("exchange", "ticker")


@query("SELECT event_type AS ticker, value AS mentions FROM events")
def allowlist_projection(spark, sf_dir):
    rows = table(spark, sf_dir, "events").withColumnsRenamed({"event_type": "ticker", "value": "mentions", "props": "text"})
    return quality.allowed_only(rows, "ticker_trends")


@query("SELECT user_id, CAST(count(*) AS BIGINT) AS total, CAST(count(*) FILTER (event_type = 'error') AS BIGINT) AS failed FROM events GROUP BY user_id HAVING count(*) FILTER (event_type = 'error') / count(*) > 0.2")
def failure_fraction(spark, sf_dir):
    outcome = F.when(F.col("event_type") == "error", "failed").otherwise("ok")
    shares = quality.failure_share(table(spark, sf_dir, "events").select("user_id", outcome.alias("status")), "user_id")
    return shares.filter("share > 0.2").select("user_id", "total", "failed")


@query("SELECT event_type, CAST(CAST(ts AS DATE) AS VARCHAR) AS d, CAST(count(*) AS BIGINT) AS n FROM events GROUP BY ALL")
def event_counts(spark, sf_dir):
    return diff.event_counts(table(spark, sf_dir, "events").select("event_type", F.to_date("ts").alias("d")), "event_type", "d").select("event_type", day("d"), "n")


@query("SELECT c_custkey, sha256(printf('CIK%010d', c_custkey) || '|' || c_name || '|' || c_mktsegment) AS fingerprint FROM customer")
def row_fingerprint(spark, sf_dir):
    text = F.concat_ws("|", scalars.padded_cik(F.col("c_custkey")), "c_name", "c_mktsegment")
    return table(spark, sf_dir, "customer").select("c_custkey", F.sha2(text, 256).alias("fingerprint"))


@query("SELECT event_type, strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS bucket_start, CAST(count(*) AS BIGINT) AS mentions, round(sum(round(value * 100)) / 100, 2) AS engagement FROM events GROUP BY ALL")
def hour_buckets(spark, sf_dir):
    cents = table(spark, sf_dir, "events").select("event_type", "ts", F.round(F.col("value") * 100).alias("value"))
    out = listings.hourly_metrics(cents)
    return out.select("event_type", F.date_format("window.start", "yyyy-MM-dd HH:mm:ss").alias("bucket_start"), "mentions", F.round(F.col("engagement") / 100, 2).alias("engagement"))


@query("SELECT c_custkey, CAST(row_number() OVER (PARTITION BY c_nationkey ORDER BY c_mktsegment, CAST(c_custkey AS VARCHAR)) AS BIGINT) AS rank FROM customer")
def canonical_sort(spark, sf_dir):
    w = Window.partitionBy("c_nationkey").orderBy("c_mktsegment", F.col("c_custkey").cast("string"))
    return table(spark, sf_dir, "customer").select("c_custkey", F.row_number().over(w).cast("long").alias("rank"))
