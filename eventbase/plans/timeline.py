"""Queries over time and order, each over whole tables, and the same results as plain SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventbase.operators.coverage import offset_gaps as gaps_of
from eventbase.operators.intervals import interval_join as join_intervals
from eventbase.operators.ordered import enrich_asof as asof
from eventbase.operators.ordered import ranked, written
from eventbase.operators.quantiles import exact_quantiles, heavy_hitters, merged, sketched
from eventbase.plans.inputs import no_zone, table
from eventbase.session import shared_folder
from eventbase.sources.envelope import ENVELOPE, stream_envelope_folder
from eventbase.streaming.joins import join_streams as join_two
from eventbase.streaming.joins import without_repeats
from eventbase.streaming.windows import read_appended, write_results

_MONEY = "cast(value AS DECIMAL(18,2))"


def _hot(share: int, of: int, hot: int, otherwise: str) -> Column:
    """A key that so many rows of so many share."""
    return F.when(F.col("event_id") % of < share, F.lit(hot).cast("long")).otherwise(F.col(otherwise))


def enrich_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with the newest order of their customer at that time; a third of both tables is of one customer."""
    at = F.when(F.col("event_id") % 5 == 0, F.date_trunc("minute", "ts")).otherwise(F.col("ts").cast("timestamp"))
    events = table(spark, sf_dir, "events").select(
        "event_id", _hot(1, 3, 1, "user_id").alias("asked"), F.when(F.col("event_id") % 40 != 0, at).alias("at")
    )
    minutes = F.col("o_orderkey") * 7919 % 43200
    since = F.timestamp_seconds(F.unix_seconds(F.lit("2024-01-01 00:00:00").cast("timestamp")) + minutes * 60)
    versions = table(spark, sf_dir, "orders").select(
        F.when(F.col("o_orderkey") % 3 == 0, 1).otherwise(F.col("o_custkey") % 200).alias("customer"),
        F.when(F.col("o_orderkey") % 50 != 0, since).alias("since"), "o_orderpriority", "o_totalprice",
    )
    rows = asof(events, versions, {"asked": "customer"}, "at", "since", ["o_orderpriority", "o_totalprice"])
    return rows.select("event_id", "asked", no_zone("at").alias("at"), "o_orderpriority", "o_totalprice")


def _spans(events: DataFrame, event_type: str, lengths: dict[int, int]) -> DataFrame:
    """Events of a type as intervals whose lengths in seconds follow from their number."""
    n = F.col("event_id") % len(lengths)
    seconds = F.lit(None).cast("long")
    for i, length in lengths.items():
        seconds = F.when(n == i, F.lit(length).cast("long")).otherwise(seconds)
    start = F.col("ts").cast("timestamp")
    return events.filter(F.col("event_type") == event_type).select(
        "event_id", _hot(1, 10, 0, "user_id").alias("who"), start.alias("start"),
        F.timestamp_micros(F.unix_micros(start) + seconds * 1_000_000).alias("end"),
    )


_LEFT = {0: 30, 1: 3600, 2: 86400, 3: 86400 * 60, 4: 0}
_RIGHT = {0: 5, 1: 600, 2: 43200, 3: 86400 * 7}


def interval_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For every signup interval, the error intervals of the same user that overlap it: from seconds to months."""
    events = table(spark, sf_dir, "events")
    signups, errors = _spans(events, "signup", _LEFT), _spans(events, "error", _RIGHT)
    pairs = join_intervals(signups, errors, {"who": "who"}, ("start", "end"), ("start", "end"))
    return pairs.groupBy(F.col("left.event_id").alias("signup_id")).agg(
        F.count("*").alias("errors"), F.min("right.event_id").alias("first_error"), F.max("right.event_id").alias("last_error")
    )


def _fed(spark: SparkSession, rows: DataFrame, folder: str) -> None:
    rows.repartition(2).write.mode("append").parquet(folder)


def join_streams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clicks with the purchases of the same user within the hour, as a stream that is stopped half way and started again."""
    events = table(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type")
    half = events.agg(F.max("event_id")).first()[0] or 0
    folder, out, checkpoint = (shared_folder(spark) for _ in range(3))
    for part in (events.filter(F.col("event_id") <= half // 2), events.filter(F.col("event_id") > half // 2)):
        _fed(spark, part, folder)
        stream = spark.readStream.schema(events.schema).parquet(folder)
        clicks = stream.filter("event_type = 'click'").selectExpr("event_id AS click_id", "user_id AS clicked_by", "ts AS clicked_at")
        bought = stream.filter("event_type = 'purchase'").selectExpr("event_id AS purchase_id", "user_id AS bought_by", "ts AS bought_at")
        met = join_two(clicks, bought, {"clicked_by": "bought_by"}, "clicked_at", "bought_at", "1 HOUR", watermark="10 minutes")
        met = met.select("click_id", "clicked_by", "purchase_id")
        write_results(met, out, checkpoint=checkpoint, available_now=True).awaitTermination()
    return read_appended(spark, out, met.schema)


def dedup_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every message once, though the first half comes again after a restart and the second half twice in one batch."""
    events = table(spark, sf_dir, "events")
    messages = events.select(
        F.col("event_type").alias("key"), F.to_json(F.struct("event_id", "value")).alias("value"), F.lit("events").alias("topic"),
        (F.col("user_id") % 4).cast("int").alias("partition"), F.col("event_id").alias("offset"), F.col("ts").cast("timestamp").alias("timestamp"),
    ).select(*ENVELOPE.names)
    one, two = messages.filter("offset % 2 = 0"), messages.filter("offset % 2 = 1")
    folder, out, checkpoint = (shared_folder(spark) for _ in range(3))
    for parts in ([one], [one, two, two]):
        for part in parts:
            _fed(spark, part, folder)
        once = without_repeats(stream_envelope_folder(spark, folder), ["topic", "partition", "offset"], "timestamp", "31 days")
        once = once.select("topic", "partition", "offset", "key", F.get_json_object("value", "$.event_id").cast("long").alias("event_id"))
        write_results(once, out, checkpoint=checkpoint, available_now=True).awaitTermination()
    return read_appended(spark, out, once.schema)


def rank_hot_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers, changes and running totals of each user's events, nine tenths of which are one user's."""
    events = table(spark, sf_dir, "events").select(
        "event_id", _hot(9, 10, 0, "user_id").alias("who"), "ts", "value", F.col("value").cast("decimal(18,2)").alias("amount")
    )
    rows = ranked(events, ["who"], ["ts", "event_id"], number="visit", sums={"total": "amount"}, lags={"before": "value"})
    return rows.select("event_id", "who", "visit", (F.col("value") - F.col("before")).alias("change"), F.col("total").cast("double").alias("total"))


def agg_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Median and 99th percentile per type, exact, with ties and nulls."""
    value = F.when(F.col("event_id") % 3 == 0, F.floor("value").cast("double")).otherwise(F.col("value"))
    events = table(spark, sf_dir, "events").select("event_type", F.when(F.col("event_id") % 13 != 0, value).alias("value"))
    rows = exact_quantiles(events, ["event_type"], "value", [0.5, 0.99])
    return rows.select("event_type", "n", F.col("quantiles")[0].alias("median"), F.col("quantiles")[1].alias("p99"))


def agg_heavy_hitters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users of more than a fiftieth of the events of a type."""
    who = F.when(F.col("event_id") % 3 == 0, 7).when(F.col("event_id") % 11 == 0, None).otherwise(F.col("user_id"))
    return heavy_hitters(table(spark, sf_dir, "events").select("event_type", who.alias("who")), "event_type", "who", 50)


def agg_sketch_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Medians per type and day, and per type, from stored sketches of six hours: how often they are off by over a fiftieth in rank."""
    events = table(spark, sf_dir, "events").select("event_type", F.col("ts").cast("timestamp").alias("ts"), "value")
    stored = written(sketched(events, [F.window("ts", "6 hours").alias("w"), "event_type"], "value"))
    stored = stored.withColumn("day", F.to_date("w.start"))
    days, types = merged(stored, ["event_type", "day"], [0.5]), merged(stored, ["event_type"], [0.5])
    found = days.unionByName(types.withColumn("day", F.lit(None).cast("date")))
    found = found.select("event_type", "day", "n", F.col("quantiles")[0].alias("median"))
    asked = F.inline(F.array(F.struct(F.to_date("ts").alias("of_day")), F.struct(F.lit(None).cast("date").alias("of_day"))))
    each = events.select(F.col("event_type").alias("of_type"), "value", asked)
    near = each.join(found, (each["of_type"] == found["event_type"]) & each["of_day"].eqNullSafe(found["day"]))
    below, upto = F.sum((F.col("value") < F.col("median")).cast("long")), F.sum((F.col("value") <= F.col("median")).cast("long"))
    n = F.max("n")
    return near.groupBy("event_type", "day").agg(n.alias("n"), ((below <= 0.52 * n + 1) & (upto >= 0.48 * n - 1)).alias("within_bound"))


def offset_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Missing and doubly covered offsets of batches with planted holes and overlaps."""
    events = table(spark, sf_dir, "events").withColumn("batch", F.floor(F.col("event_id") / 100))
    ranges = events.groupBy((F.col("user_id") % 4).cast("int").alias("partition"), "batch").agg(
        F.min("event_id").alias("min_offset"), F.max("event_id").alias("max_offset")
    )
    longer = F.col("max_offset") + F.when(F.col("batch") % 5 == 1, 250).otherwise(0)
    return gaps_of(ranges.filter("batch % 7 <> 3").select(F.lit("events").alias("topic"), "partition", "min_offset", longer.alias("max_offset")))


QUERIES = [
    enrich_asof, interval_join, join_streams, dedup_stream, rank_hot_key, agg_quantiles, agg_heavy_hitters, agg_sketch_windows, offset_gaps,
]


def _span_sql(event_type: str, lengths: dict[int, int]) -> str:
    seconds = " ".join(f"WHEN {i} THEN {n}" for i, n in lengths.items())
    return f"""SELECT event_id, CASE WHEN event_id % 10 < 1 THEN 0 ELSE user_id END AS who, ts AS s,
       ts + INTERVAL 1 SECOND * (CASE event_id % {len(lengths)} {seconds} END) AS e FROM events WHERE event_type = '{event_type}'"""


SQL = {
    "enrich_asof": """
WITH e AS (
  SELECT event_id, CASE WHEN event_id % 3 < 1 THEN 1 ELSE user_id END AS asked,
         CASE WHEN event_id % 40 <> 0 THEN CASE WHEN event_id % 5 = 0 THEN date_trunc('minute', ts) ELSE ts END END AS "at" FROM events
), stated AS (
  SELECT CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE o_custkey % 200 END AS customer,
         TIMESTAMP '2024-01-01' + INTERVAL 1 MINUTE * (o_orderkey * 7919 % 43200) AS since, o_orderpriority, o_totalprice
  FROM orders WHERE o_orderkey % 50 <> 0
), v AS (
  SELECT * FROM stated QUALIFY row_number() OVER (PARTITION BY customer, since ORDER BY o_orderpriority DESC, o_totalprice DESC) = 1
)
SELECT event_id, asked, "at", o_orderpriority, o_totalprice FROM e ASOF LEFT JOIN v ON e.asked = v.customer AND e."at" >= v.since""",
    "interval_join": f"""
SELECT l.event_id AS signup_id, count(*) AS errors, min(r.event_id) AS first_error, max(r.event_id) AS last_error
FROM ({_span_sql('signup', _LEFT)}) l JOIN ({_span_sql('error', _RIGHT)}) r
  ON l.who = r.who AND l.s < r.e AND r.s < l.e AND l.s < l.e AND r.s < r.e GROUP BY 1""",
    "join_streams": """
WITH c AS (SELECT * FROM events WHERE event_type = 'click'), p AS (SELECT * FROM events WHERE event_type = 'purchase'
), final AS (
  SELECT least((SELECT max(ts) FROM c), (SELECT max(ts) FROM p)) - INTERVAL 70 MINUTES AS t
)
SELECT c.event_id AS click_id, c.user_id AS clicked_by, p.event_id AS purchase_id
FROM c LEFT JOIN p ON c.user_id = p.user_id AND p.ts >= c.ts AND p.ts <= c.ts + INTERVAL 1 HOUR
WHERE p.event_id IS NOT NULL OR c.ts < (SELECT t FROM final)""",
    "dedup_stream": """
SELECT 'events' AS topic, cast(user_id % 4 AS INTEGER) AS partition, event_id AS "offset", event_type AS key, event_id FROM events""",
    "rank_hot_key": f"""
SELECT event_id, who, row_number() OVER w AS visit, value - lag(value) OVER w AS change, cast(sum({_MONEY}) OVER w AS DOUBLE) AS total
FROM (SELECT *, CASE WHEN event_id % 10 < 9 THEN 0 ELSE user_id END AS who FROM events)
WINDOW w AS (PARTITION BY who ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)""",
    "agg_quantiles": """
WITH v AS (
  SELECT event_type, CASE WHEN event_id % 3 = 0 THEN floor(value) ELSE value END AS value FROM events WHERE event_id % 13 <> 0
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY value) AS nth, count(*) OVER (PARTITION BY event_type) AS n
  FROM v WHERE value IS NOT NULL
)
SELECT event_type, n, max(value) FILTER (WHERE nth = greatest(1, ceil(0.5 * n))) AS median,
       max(value) FILTER (WHERE nth = greatest(1, ceil(0.99::DOUBLE * n))) AS p99
FROM placed GROUP BY event_type, n""",
    "agg_heavy_hitters": """
WITH v AS (
  SELECT event_type, CASE WHEN event_id % 3 = 0 THEN 7 WHEN event_id % 11 = 0 THEN NULL ELSE user_id END AS who FROM events
)
SELECT event_type, who, count(*) AS n FROM v GROUP BY event_type, who
HAVING count(*) * 50 > (SELECT count(*) FROM v a WHERE a.event_type = v.event_type)""",
    "agg_sketch_windows": """
SELECT event_type, CASE WHEN grouping(day) = 0 THEN day END AS day, count(value) AS n, true AS within_bound
FROM (SELECT event_type, cast(ts AS DATE) AS day, value FROM events) GROUP BY GROUPING SETS ((event_type, day), (event_type))""",
    "offset_gaps": """
WITH ranges AS (
  SELECT cast(user_id % 4 AS INTEGER) AS partition, event_id // 100 AS batch, min(event_id) AS lo,
         max(event_id) + CASE WHEN event_id // 100 % 5 = 1 THEN 250 ELSE 0 END AS hi
  FROM events WHERE event_id // 100 % 7 <> 3 GROUP BY 1, 2
), seen AS (
  SELECT *, (SELECT max(a.hi) FROM ranges a WHERE a.partition = r.partition AND (a.lo < r.lo OR a.lo = r.lo AND a.hi < r.hi)) AS upto FROM ranges r
)
SELECT 'events' AS topic, partition, CASE WHEN lo > upto + 1 THEN 'missing' ELSE 'repeated' END AS kind,
       CASE WHEN lo > upto + 1 THEN upto + 1 ELSE lo END AS first_offset, CASE WHEN lo > upto + 1 THEN lo - 1 ELSE least(hi, upto) END AS last_offset
FROM seen WHERE upto IS NOT NULL AND lo <> upto + 1""",
}
