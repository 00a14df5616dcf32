"""Throttled capture and carry-forward of captured labels.

Throttling is sequential: the next emission depends on the last one. Here every
instant gets a link to the instant that would be emitted after it, and the
chain from each key's first emission is followed by pointer doubling: links of
1, 2, 4, ... steps, then back down to list every instant on the chain. Each
round joins on (key, instant) and keeps only instants that earlier links lead
to, so tables shrink as steps grow. No key's rows meet in one task, and the
number of rounds is the logarithm of the longest chain.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from shelfmark.operators.match import first_band_match
from shelfmark.operators.ordered import carry_last
from shelfmark.operators.topk import keep_first
from shelfmark.session import cut_lineage

BLOCK_SECONDS = 300
# Fixed value: label of a box that no capture has shown yet.
UNSEEN = "Processing..."


def microseconds(ts: str) -> Column:
    return F.unix_micros(F.col(ts).cast("timestamp"))


def _null_key(kind, name: str) -> Column:
    return F.raise_error(F.lit(f"{name}: a throttled row needs its key")).cast(kind)


def clock_starts(df: DataFrame, keys: Sequence[str], ts: str, gap_seconds: float) -> DataFrame:
    """(keys, `_due`) of keys seen for the first time: their clock starts at their first row."""
    gap = int(gap_seconds * 1_000_000)
    return df.groupBy(*keys).agg((F.min(microseconds(ts)) + F.lit(gap)).alias("_due"))


def _first_links(
    instants: DataFrame, due: DataFrame, keys: list[str], gap: int, width: int
) -> DataFrame:
    """(keys, _src, _dst): first instant at least a gap after each; null _src for `due`."""
    asked = instants.select(*keys, (F.col("_at") + gap).alias("_t"), F.col("_at").alias("_src"))
    started = due.select(*keys, F.col("_due").alias("_t"), F.lit(None).cast("long").alias("_src"))
    given = instants.select(*keys, F.col("_at").alias("_t"), F.lit(None).cast("long").alias("_src"))
    points = (
        asked.unionByName(started)
        .withColumn("_asks", F.lit(1))
        .unionByName(given.withColumn("_asks", F.lit(0)))
        .withColumn("_back", -F.col("_t"))
    )
    # Backwards in time, the last instant met is the first one at or after a point.
    seen = {"_dst": F.when(F.col("_asks") == 0, F.col("_t"))}
    block = F.floor(F.col("_back") / F.lit(width))
    found = carry_last(points, keys, ["_back", "_asks", "_src"], block, seen)
    return found.where((F.col("_asks") == 1) & F.col("_dst").isNotNull()).select(
        *keys, "_src", "_dst"
    )


def _chains(links: DataFrame, roots: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, _at) of every instant that the links reach from the roots, roots included."""
    levels = []
    step = links
    while not step.isEmpty():
        levels.append(step)
        useful = step.select(*keys, F.col("_dst").alias("_src")).distinct()
        useful = useful.unionByName(roots.withColumnRenamed("_at", "_src")).distinct()
        onward = step.select(*keys, F.col("_src").alias("_dst"), F.col("_dst").alias("_far"))
        doubled = step.join(useful, [*keys, "_src"], "left_semi").join(onward, [*keys, "_dst"])
        step = cut_lineage(doubled.select(*keys, "_src", F.col("_far").alias("_dst")))
    reached = roots
    for k in reversed(range(len(levels))):
        ahead = levels[k].join(reached.withColumnRenamed("_at", "_src"), [*keys, "_src"])
        ahead = ahead.select(*keys, F.col("_dst").alias("_at"))
        reached = reached.unionByName(ahead)
        # Every level reads the instants so far twice; do not let that multiply.
        if k % 2 == 0:
            reached = cut_lineage(reached)
    return reached


def throttle(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    tie: Sequence[str],
    gap_seconds: float,
    due: DataFrame | None = None,
    block_seconds: float = BLOCK_SECONDS,
) -> DataFrame:
    """Rows emitted at least `gap_seconds` after the key's last emission.

    The clock starts at a key's first row, which never emits, or at `due`
    (keys, `_due` = microsecond from which the next row emits). Of rows at the
    same instant the first by `tie` stands for all. A null key fails the query.
    """
    keys = list(keys)
    gap, width = int(gap_seconds * 1_000_000), int(block_seconds * 1_000_000)
    if due is None:
        due = clock_starts(df, keys, ts, gap_seconds)
    for k in keys:
        df = df.withColumn(k, F.when(F.col(k).isNotNull(), F.col(k)).otherwise(_null_key(df.schema[k].dataType, k)))
    instants = df.select(*keys, microseconds(ts).alias("_at")).distinct()
    found = cut_lineage(_first_links(instants, due, keys, gap, width))
    roots = found.where(F.col("_src").isNull()).select(*keys, F.col("_dst").alias("_at"))
    links = found.where(F.col("_src").isNotNull())
    reached = _chains(links, roots, keys)
    rows = df.withColumn("_at", microseconds(ts)).join(reached, [*keys, "_at"], "left_semi")
    return keep_first(rows, [*keys, "_at"], list(tie)).select(*df.columns)


def capture(
    detections: DataFrame,
    stream: str,
    ts: str,
    gap_seconds: float = 15,
    due: DataFrame | None = None,
    manual: str | None = None,
) -> DataFrame:
    """All rows of captured frames, with `trigger` "auto" or "manual".

    A frame is the rows of one stream and instant. Frames with a `manual` row
    are captured too, without reading or setting the clock.
    """
    frames = detections.select(stream, ts).distinct()
    auto = throttle(frames, [stream], ts, [ts], gap_seconds, due)
    captured = auto.withColumn("trigger", F.lit("auto"))
    if manual is not None:
        pressed = detections.where(manual).select(stream, ts).distinct()
        pressed = pressed.join(auto, [stream, ts], "left_anti")
        captured = captured.unionByName(pressed.withColumn("trigger", F.lit("manual")))
    return detections.join(captured, [stream, ts])


def carry_forward(
    detections: DataFrame,
    captured: DataFrame,
    stream: str,
    ts: str,
    det_id: str,
    label: str,
    dims: dict[str, float],
    block: Column,
) -> DataFrame:
    """Each detection with the label of the box it matches in the stored captures.

    An automatic capture replaces the stored boxes and a manual one adds to them.
    Detections of an automatically captured frame keep their own label; others
    take the newest label of the first stored box they match, else "Processing...".
    """
    auto = captured.where(F.col("trigger") == "auto").select(stream, ts).distinct()
    auto = auto.withColumn("_auto", F.lit(True))
    marked = detections.join(auto, [stream, ts], "left")
    epoch = {"_epoch": F.when(F.col("_auto"), F.col(ts))}
    # Before the first automatic capture there is an epoch too, of manual ones only.
    outset = F.lit(0).cast("timestamp").cast(detections.schema[ts].dataType)
    placed = carry_last(marked, [stream], [ts], block, epoch)
    # Read several times below, as probes and as stored boxes.
    placed = cut_lineage(placed.withColumn("_epoch", F.coalesce("_epoch", outset)))
    stored = placed.join(
        captured.select(stream, ts, det_id, "trigger"), [stream, ts, det_id], "inner"
    )
    matched = first_band_match(
        placed.where(F.col("_auto").isNull()),
        stored.select(stream, "_epoch", ts, det_id, *dims),
        [stream, "_epoch"],
        dims,
        [ts, det_id],
        [F.col(d).alias(f"_box_{d}") for d in dims],
        [stream, ts, det_id],
        earlier_than=[ts],
    )
    own = placed.where("_auto").select(*detections.columns, F.col(label).alias("shown"))
    # A box stored again keeps its place and takes its newest label.
    box = [f"_box_{d}" for d in dims]
    asking = matched.select(
        *detections.columns,
        "_epoch",
        *[F.col("match").getField(b).alias(b) for b in box],
        F.lit(0).alias("_stored"),
    )
    telling = stored.dropna(subset=list(dims)).select(
        *detections.columns,
        "_epoch",
        *[F.col(d).alias(f"_box_{d}") for d in dims],
        F.lit(1).alias("_stored"),
    )
    newest = carry_last(
        asking.unionByName(telling),
        [stream, "_epoch", *box],
        [ts, "_stored", det_id],
        block,
        {"shown": F.when(F.col("_stored") == 1, F.col(label))},
    )
    taken = newest.where("_stored = 0").select(
        *detections.columns, F.coalesce("shown", F.lit(UNSEEN)).alias("shown")
    )
    return own.unionByName(taken)


def asof_carry(
    rows: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    is_source: Column,
    value: str,
    tolerance: float,
    block: Column,
    label: Column,
    name: str = "label",
) -> DataFrame:
    """Label of the latest source row at or before each row, if its value is near.

    Before and after go by the first column of `order`, the instant; of the sources of one instant the
    last by the others counts.

    Rows without a source before them, or with one whose value differs by the
    tolerance or more, get "Processing...".
    """
    source = F.when(is_source, F.struct(F.col(value).alias("value"), label.alias("label")))
    # Within an instant, the first column of the order, sources come first.
    first, *rest = order
    ranked = rows.withColumn("_later", F.when(is_source, F.lit(0)).otherwise(F.lit(1)))
    latest = carry_last(ranked, keys, [first, "_later", *rest], block, {"_latest": source})
    near = F.abs(F.col("_latest.value") - F.col(value)) < F.lit(tolerance)
    shown = F.when(near, F.col("_latest.label")).otherwise(F.lit(UNSEEN))
    return latest.select(*rows.columns, shown.alias(name))
