"""Streaming jobs run over the driver tables until their input is used up."""

from __future__ import annotations

from pyspark.sql import functions as F

from bindings.common import table
from bindings.ordered import DAY, LINE_ID, SUBMITTED, THROTTLED, references, submissions
from shelfmark.operators.throttle import microseconds
from shelfmark.session import fresh_dir, prepare
from shelfmark.streaming.batches import BatchTables, parquet_stream
from shelfmark.streaming.capture import carry_forward_stream, labelled_so_far, throttle_stream, throttled_so_far
from shelfmark.streaming.distinct import write_distinct
from shelfmark.streaming.ingest import ingest_reviews

QUERIES = {}


def query(name, sql=None):
    def register(run):
        QUERIES[name] = (run, sql)
        return run

    return register


# Stretches of time that a table arrives in, or deals of rows without order; three of them make a micro-batch.
STRETCHES = 8
# Rows that a file of a stretch or deal holds, about; larger tables come in more files, not in more micro-batches.
FILE_ROWS = 250_000


def files_each(n_rows):
    """Files of one stretch or deal."""
    return max(1, -(-n_rows // (STRETCHES * FILE_ROWS)))


def scattered(spark, sf_dir, name, *columns):
    """Stream over a driver table dealt to files in no order by the hash of columns, three eighths to a micro-batch."""
    prepare(spark)
    rows, folder = table(spark, sf_dir, name), fresh_dir(spark, f"{name}-files")
    each = files_each(rows.count())
    rows.repartition(STRETCHES * each, *columns).write.parquet(folder)
    return parquet_stream(spark, folder, "part-*", files_per_batch=3 * each)


def arriving(spark, sf_dir, name, ts, *key):
    """Stream over a driver table in rough order of time, and a delay in seconds that no row exceeds.

    Rows arrive up to a sixteenth of the table's span late, by a hash of their key. Each stretch of arrivals is
    written after the one before; inside it, files and rows are in no order. Three stretches make a micro-batch.
    """
    prepare(spark)
    rows, at = table(spark, sf_dir, name), microseconds(ts)
    first, last, n_rows = rows.agg(F.min(at), F.max(at), F.count(F.lit(1))).first()
    first, last = first or 0, last or 0
    jitter = (last - first) // 16 + 1
    width = (last - first + jitter) // STRETCHES + 1
    late = F.pmod(F.xxhash64(*key), F.lit(jitter))
    stretch = F.coalesce(F.floor((at + late - first) / F.lit(width)).cast("int"), F.lit(0))
    dealt, folder = fresh_dir(spark, f"{name}-dealt"), fresh_dir(spark, f"{name}-files")
    rows.withColumn("_stretch", stretch).write.partitionBy("_stretch").parquet(dealt)
    dealt = spark.read.schema(rows.withColumn("_stretch", stretch).schema).parquet(dealt)
    each = files_each(n_rows)
    for k in range(STRETCHES):  # streams read files in the order of their writing
        arrived = dealt.where(F.col("_stretch") == k).drop("_stretch")
        arrived.repartition(each).write.mode("append").parquet(folder)
    return parquet_stream(spark, folder, "part-*", files_per_batch=3 * each), (width + jitter) / 1_000_000


def finish(running) -> None:
    running.awaitTermination()
    if running.exception() is not None:
        raise running.exception()


@query("stream_distinct", "SELECT DISTINCT user_id, event_type FROM events")
def stream_distinct(spark, sf_dir):
    prepare(spark)
    path = fresh_dir(spark, "distinct")
    events = scattered(spark, sf_dir, "events", "event_id")
    finish(write_distinct(events, ["user_id", "event_type"], path))
    return BatchTables(path).read_all(spark, "links").drop("bucket")


@query("throttle_stream", THROTTLED)
def throttled(spark, sf_dir):
    prepare(spark)
    path = fresh_dir(spark, "throttle")
    events, delay = arriving(spark, sf_dir, "events", "ts", "event_id")
    events = events.select("user_id", "event_id", "event_type", "ts")
    how = ["user_id"], "ts", ["event_id"], DAY
    finish(throttle_stream(events, *how, path, delay_seconds=delay))
    emitted = throttled_so_far(spark, path, *how)
    return emitted.select("user_id", "event_id", "event_type")


@query(
    "stream_reviews",
    SUBMITTED + """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, username, CAST(moby_id AS VARCHAR) AS moby_id,
  platform FROM final WHERE reason IS NULL""",
)
def stream_reviews(spark, sf_dir):
    prepare(spark)
    path = fresh_dir(spark, "reviews")
    # A review of an earlier file counts before one of a later file: keep a user's lines in one file.
    lines = scattered(spark, sf_dir, "lineitem", "l_suppkey")
    finish(ingest_reviews(submissions(lines), references(spark, sf_dir), LINE_ID, path))
    return BatchTables(path).read_all(spark, "accepted").drop("score", "bucket")


@query(
    "carry_forward_stream",
    """
WITH RECURSIVE emitted AS (
  SELECT user_id, min(ts) AS at_ts, 0 AS n FROM events GROUP BY user_id
  UNION ALL
  SELECT e.user_id, min(e.ts), any_value(n) + 1
  FROM emitted m JOIN events e ON e.user_id = m.user_id AND e.ts >= m.at_ts + INTERVAL 1 DAY
  GROUP BY e.user_id
), captures AS (SELECT user_id, at_ts FROM emitted WHERE n > 0),
boxes AS (
  SELECT event_id, user_id, ts, event_type, CAST(floor(value) AS INTEGER) AS x,
    CAST(regexp_extract(props, '[0-9]+') AS INTEGER) AS y
  FROM events
), placed AS (
  SELECT b.*, at_ts FROM boxes b ASOF LEFT JOIN captures c ON b.user_id = c.user_id AND b.ts >= at_ts
)
SELECT p.event_id, CASE WHEN p.ts = p.at_ts OR abs(p.x - s.x) < 20 AND abs(p.y - s.y) < 20
  THEN s.event_type || ' ' || s.event_id ELSE 'Processing...' END AS shown
FROM placed p LEFT JOIN boxes s ON s.user_id = p.user_id AND s.ts = p.at_ts""",
)
def carried(spark, sf_dir):
    prepare(spark)
    path = fresh_dir(spark, "carry")
    events, delay = arriving(spark, sf_dir, "events", "ts", "event_id")
    detections = events.select(
        F.col("user_id").cast("string").alias("stream_id"),
        "ts",
        F.col("event_id").alias("det_id"),
        F.floor("value").cast("int").alias("x"),
        F.regexp_extract("props", "[0-9]+", 0).cast("int").alias("y"),
        F.lit(False).alias("manual"),
        F.concat_ws(" ", "event_type", F.col("event_id").cast("string")).alias("label"),
    )
    finish(carry_forward_stream(detections, {"x": 20, "y": 20}, DAY, path, delay_seconds=delay))
    labelled = labelled_so_far(spark, path, {"x": 20, "y": 20}, DAY)
    return labelled.select(F.col("det_id").alias("event_id"), "shown")
