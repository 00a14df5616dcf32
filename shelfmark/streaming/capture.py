"""Throttled capture and carry-forward labels over a stream of rows.

Rows wait until the stream's watermark has passed them: the newest instant seen so far less `delay_seconds`.
What has passed is complete, so where micro-batches end, and which files they hold, does not change any result;
only rows that arrive at or behind the watermark are late and are written apart. The waiting rows,
the clock of each key and, for carry-forward, the boxes of each stream's open epoch are the state kept between
micro-batches. Waiting rows lie in spans of time: a micro-batch appends those it has to hold and
reads only the spans that its watermark reaches; nothing that waits is written again, and spans that have
passed are dropped. Within a batch the work is the batch operator itself, so a key with much of the batch is
spread like any other. `*_so_far` adds what the rows still waiting would give if the stream ended now.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from shelfmark.operators.ordered import time_block
from shelfmark.operators.skew import null_safe_join
from shelfmark.operators.throttle import (
    capture,
    carry_forward,
    clock_starts,
    microseconds,
    throttle,
)
from shelfmark.streaming.batches import BatchTables, last_batch, run_available

# Spans of waiting rows that a stream's delay is cut into.
SPANS = 8


def _admit(
    tables: BatchTables, rows: DataFrame, batch: int, ts: str, delay_seconds: float
) -> tuple[DataFrame, DataFrame | None]:
    """Rows that the watermark passes with this batch, and clocks so far.

    Writes the late rows, those that have to wait and the new watermark. A row waits in the span of its
    instant until the watermark has passed it: it is released by the one batch whose watermark is the first at or
    behind which it lies. The width of the spans is set by the first batch.
    """
    spark = rows.sparkSession
    at, no = microseconds(ts), F.lit(False)
    marks = tables.read_one(spark, "marks", batch - 1)
    before, width = (None, None) if marks is None else marks.select("mark", "width").first()
    width = width or max(1_000_000, int(delay_seconds * 1_000_000) // SPANS)
    late = no if before is None else F.coalesce(at <= F.lit(before), no)
    newest, n_late = rows.agg(F.max(at), F.count_if(late)).first()
    if n_late or batch == 0:  # the first batch writes the table, if without rows
        tables.write(rows.where(late), "late", batch)
    reached = None if newest is None else newest - int(delay_seconds * 1_000_000)
    mark = max((m for m in (before, reached) if m is not None), default=None)
    passed = no if mark is None else F.coalesce(at <= F.lit(mark), no)
    fresh = rows.where(~late)
    span = F.floor(at / F.lit(width)) * F.lit(width)
    tables.hold(fresh.where(~passed).withColumn("span", span), "waiting", "span", batch)
    tables.write(spark.createDataFrame([(mark, width)], "mark long, width long"), "marks", batch)
    ready = fresh.where(passed)
    held = None
    if mark is not None:
        held = tables.held(spark, "waiting", "span", None if before is None else before - width, mark, batch)
    if held is not None:
        since = F.lit(True) if before is None else at > F.lit(before)
        ready = ready.unionByName(held.select(*rows.columns).where(since & passed))
    earlier = tables.read_one(spark, "marks", batch - 2)
    if earlier is not None and (gone := earlier.first()["mark"]) is not None:
        tables.release(spark, "waiting", "span", gone - width)
    return ready, tables.read_one(spark, "clocks", batch - 1)


def _waiting(tables: BatchTables, spark: SparkSession, batch: int, ts: str) -> DataFrame | None:
    """Rows that the watermark of a batch has not passed."""
    mark, width = tables.read_one(spark, "marks", batch).select("mark", "width").first()
    held = tables.held(spark, "waiting", "span", None if mark is None else mark - width, None, batch + 1)
    if held is None or mark is None:
        return held
    return held.where(F.coalesce(microseconds(ts) > F.lit(mark), F.lit(True)))


def _due(
    rows: DataFrame, clocks: DataFrame | None, keys: Sequence[str], ts: str, gap: float
) -> DataFrame:
    starts = clock_starts(rows, keys, ts, gap)
    if clocks is None:
        return starts
    known = clocks.select(*keys, F.col("_due").alias("_known"))
    merged = null_safe_join(starts, known, keys, "left")
    return merged.select(*keys, F.coalesce("_known", "_due").alias("_due"))


def _next_clocks(
    emitted: DataFrame,
    due: DataFrame,
    clocks: DataFrame | None,
    keys: Sequence[str],
    ts: str,
    gap: float,
) -> DataFrame:
    after = F.max(microseconds(ts)) + F.lit(int(gap * 1_000_000))
    last = emitted.groupBy(*keys).agg(after.alias("_after"))
    fresh = null_safe_join(due, last, keys, "left")
    fresh = fresh.select(*keys, F.coalesce("_after", "_due").alias("_due"))
    if clocks is None:
        return fresh
    return fresh.unionByName(clocks.join(fresh, list(keys), "left_anti"))


def throttle_stream(
    stream: DataFrame,
    keys: Sequence[str],
    ts: str,
    tie: Sequence[str],
    gap_seconds: float,
    path: str,
    delay_seconds: float = 0,
) -> StreamingQuery:
    """Emit throttled rows to `<path>/emitted`, late rows to `<path>/late`."""
    tables = BatchTables(path)

    def each(rows: DataFrame, batch: int) -> None:
        spark = rows.sparkSession
        rows = rows.persist()
        ready, clocks = _admit(tables, rows, batch, ts, delay_seconds)
        ready = ready.persist()
        due = _due(ready, clocks, keys, ts, gap_seconds)
        tables.write(throttle(ready, keys, ts, tie, gap_seconds, due), "emitted", batch)
        emitted = tables.read_one(spark, "emitted", batch)
        tables.write(_next_clocks(emitted, due, clocks, keys, ts, gap_seconds), "clocks", batch)
        ready.unpersist()
        rows.unpersist()
        for name in ("clocks", "marks"):
            tables.forget(spark, name, batch - 3)

    return run_available(stream, each, path)


def throttled_so_far(
    spark: SparkSession, path: str, keys: Sequence[str], ts: str, tie: Sequence[str], gap_seconds: float
) -> DataFrame:
    """All emitted rows, and those the waiting rows would emit if no more came."""
    tables = BatchTables(path)
    batch = last_batch(spark, path, "marks")
    emitted = tables.read_all(spark, "emitted")
    waiting = _waiting(tables, spark, batch, ts)
    if waiting is None:
        return emitted
    waiting = waiting.select(*emitted.columns)
    due = _due(waiting, tables.read_one(spark, "clocks", batch), keys, ts, gap_seconds)
    return emitted.unionByName(throttle(waiting, keys, ts, tie, gap_seconds, due))


def _label(
    ready: DataFrame,
    boxes: DataFrame | None,
    captured: DataFrame,
    dims: dict[str, float],
    block_seconds: int,
) -> tuple[DataFrame, DataFrame]:
    """Labelled detections, and all boxes that they may have met."""
    keys = ["stream_id", "ts", "det_id"]
    # Boxes stored before come first, as if they were part of these rows.
    known = captured if boxes is None else boxes.unionByName(captured)
    seen = ready if boxes is None else boxes.drop("trigger").unionByName(ready)
    block = time_block("ts", block_seconds)
    labelled = carry_forward(seen, known, "stream_id", "ts", "det_id", "label", dims, block)
    if boxes is not None:
        labelled = labelled.join(boxes.select(*keys), keys, "left_anti")
    return labelled, known


def carry_forward_stream(
    detections: DataFrame,
    dims: dict[str, float],
    gap_seconds: float,
    path: str,
    block_seconds: int = 300,
    delay_seconds: float = 0,
) -> StreamingQuery:
    """Label every detection the watermark has passed, in `<path>/labelled`.

    Input columns: stream_id, ts, det_id, the `dims`, manual and label, the
    label being the prediction for the box where its frame is captured.
    """
    tables = BatchTables(path)
    keys, ts = ["stream_id"], "ts"

    def each(rows: DataFrame, batch: int) -> None:
        spark = rows.sparkSession
        rows = rows.persist()
        ready, clocks = _admit(tables, rows, batch, ts, delay_seconds)
        ready = ready.persist()
        boxes = tables.read_one(spark, "boxes", batch - 1)
        due = _due(ready, clocks, keys, ts, gap_seconds)
        tables.write(capture(ready, "stream_id", ts, gap_seconds, due, "manual"), "captured", batch)
        captured = tables.read_one(spark, "captured", batch)
        labelled, known = _label(ready, boxes, captured, dims, block_seconds)
        tables.write(labelled, "labelled", batch)

        auto = known.where(F.col("trigger") == "auto")
        latest = auto.groupBy("stream_id").agg(F.max(ts).alias("_latest"))
        kept = known.join(latest, "stream_id", "left").where(
            F.col("_latest").isNull() | (F.col(ts) >= F.col("_latest"))
        )
        tables.write(kept.drop("_latest"), "boxes", batch)
        emitted = captured.where(F.col("trigger") == "auto")
        tables.write(_next_clocks(emitted, due, clocks, keys, ts, gap_seconds), "clocks", batch)
        ready.unpersist()
        rows.unpersist()
        for name in ("clocks", "boxes", "marks"):
            tables.forget(spark, name, batch - 3)

    return run_available(detections, each, path)


def labelled_so_far(
    spark: SparkSession, path: str, dims: dict[str, float], gap_seconds: float, block_seconds: int = 300
) -> DataFrame:
    """All labelled detections, and the labels of those still waiting if no more came."""
    tables = BatchTables(path)
    batch = last_batch(spark, path, "marks")
    labelled = tables.read_all(spark, "labelled")
    waiting, boxes = _waiting(tables, spark, batch, "ts"), tables.read_one(spark, "boxes", batch)
    if waiting is None:
        return labelled
    waiting = waiting.drop("span", "batch")
    due = _due(waiting, tables.read_one(spark, "clocks", batch), ["stream_id"], "ts", gap_seconds)
    captured = capture(waiting, "stream_id", "ts", gap_seconds, due, "manual")
    rest, _ = _label(waiting, boxes, captured, dims, block_seconds)
    return labelled.unionByName(rest)
