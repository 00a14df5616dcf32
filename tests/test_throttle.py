import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from shelfmark.operators.ordered import time_block
from shelfmark.operators.throttle import asof_carry, capture, carry_forward, throttle
from tests.conftest import tuples

START = datetime(2024, 1, 1)


def at(seconds):
    return START + timedelta(seconds=seconds)


def emitted_by_scan(times, gap):
    last, out = min(times), []
    for t in sorted(set(times)):
        if t - last >= gap:
            out.append(t)
            last = t
    return out


def test_throttle_literal(spark):
    rows = [("s", at(t), t) for t in (0, 14, 15, 20, 29, 31)]
    df = spark.createDataFrame(rows, "k string, ts timestamp, n int")
    assert tuples(throttle(df, ["k"], "ts", ["n"], 15), "n") == [(15,), (31,)]
    one = df.where("n = 0")
    assert throttle(one, ["k"], "ts", ["n"], 15).count() == 0


@pytest.mark.parametrize("block", [0.5, 4, 1000])
def test_throttle_equals_scan_with_a_hot_key(spark, block):
    rng = random.Random(2)
    rows = []
    for n in range(900):
        k = "hot" if rng.random() < 0.5 else rng.choice("abcdefgh")
        # Half-second grid, so that several rows share an instant; a long silence too.
        t = rng.randint(0, 400) / 2 + (1000 if rng.random() < 0.3 else 0)
        rows.append((k, at(t), t, n))
    df = spark.createDataFrame(rows, "k string, ts timestamp, t double, n int").repartition(6)
    got = throttle(df, ["k"], "ts", ["n"], 3.5, block_seconds=block)
    expected = set()
    for k in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == k]
        for t in emitted_by_scan([r[2] for r in mine], 3.5):
            expected.add((k, min(r[3] for r in mine if r[2] == t)))
    assert {(r["k"], r["n"]) for r in got.collect()} == expected
    assert got.columns == df.columns


SCHEMA = "stream_id string, ts timestamp, det_id int, x int, y int, manual boolean, label string"
DIMS = {"x": 50, "y": 50}


def detection(t, det, x, y, manual=False, stream="s"):
    return (stream, at(t), det, x, y, manual, f"L{t}-{det}")


def shown_by_scan(rows, gap):
    """The capture loop, frame by frame."""
    out = {}
    for stream in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == stream), key=lambda r: (r[1], r[2]))
        last, stored = mine[0][1], {}
        for ts in sorted({r[1] for r in mine}):
            frame = [r for r in mine if r[1] == ts]
            auto = (ts - last).total_seconds() >= gap
            for r in frame:
                hit = next((b for b in stored if abs(b[0] - r[3]) < 50 and abs(b[1] - r[4]) < 50), None)
                out[(stream, ts, r[2])] = r[6] if auto else stored.get(hit, "Processing...")
            # A box stored again keeps its place and takes the newer label.
            if auto:
                stored, last = {(r[3], r[4]): r[6] for r in frame}, ts
            elif any(r[5] for r in frame):
                stored.update({(r[3], r[4]): r[6] for r in frame})
    return out


def random_detections(seed, n=150):
    rng = random.Random(seed)
    rows = []
    for t in sorted(rng.sample(range(0, 400), n)):
        stream = "hot" if rng.random() < 0.7 else "cold"
        manual = rng.random() < 0.25
        for det in range(rng.randint(1, 3)):
            rows.append(detection(t, det, rng.randint(0, 20) * 10, rng.randint(0, 4) * 25, manual, stream))
    return rows


def test_capture_and_carry_forward(spark):
    rows = [
        detection(0, 0, 10, 10),
        detection(15, 0, 100, 10),
        detection(15, 1, 10, 10),
        detection(16, 0, 149, 10),
        detection(16, 1, 150, 10),
        detection(17, 0, 300, 10, manual=True),
        detection(18, 0, 310, 10),
        detection(30, 0, 400, 10),
        detection(31, 0, 310, 10),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    captured = capture(df, "stream_id", "ts", 15, manual="manual")
    assert tuples(captured, "label", "trigger") == [
        ("L15-0", "auto"), ("L15-1", "auto"), ("L17-0", "manual"), ("L30-0", "auto")
    ]
    got = carry_forward(df, captured, "stream_id", "ts", "det_id", "label", DIMS, time_block("ts", 5))
    assert tuples(got, "label", "shown") == [
        ("L0-0", "Processing..."),
        ("L15-0", "L15-0"),
        ("L15-1", "L15-1"),
        ("L16-0", "L15-0"),
        ("L16-1", "Processing..."),
        ("L17-0", "Processing..."),
        ("L18-0", "L17-0"),
        ("L30-0", "L30-0"),
        ("L31-0", "Processing..."),
    ]


@pytest.mark.parametrize("seed", [1, 2])
def test_carry_forward_equals_loop(spark, seed):
    rows = random_detections(seed)
    df = spark.createDataFrame(rows, SCHEMA)
    captured = capture(df, "stream_id", "ts", 15, manual="manual")
    got = carry_forward(df, captured, "stream_id", "ts", "det_id", "label", DIMS, time_block("ts", 40))
    found = {(r["stream_id"], r["ts"], r["det_id"]): r["shown"] for r in got.collect()}
    assert found == shown_by_scan(rows, 15)


def test_asof_carry(spark):
    rows = [(1, 1, "buy", 10.0), (1, 2, "view", 14.0), (1, 3, "view", 15.0), (2, 1, "view", 1.0)]
    df = spark.createDataFrame(rows, "k int, n int, kind string, v double")
    got = asof_carry(df, ["k"], ["n"], F.col("kind") == "buy", "v", 5.0, F.col("n"),
                     F.concat(F.lit("buy "), F.col("n").cast("string")))
    assert tuples(got, "k", "n", "label") == [
        (1, 1, "buy 1"), (1, 2, "buy 1"), (1, 3, "Processing..."), (2, 1, "Processing...")
    ]


def test_source_of_the_same_instant_counts(spark):
    rows = [("u", at(0), 1, "view", 5.0), ("u", at(0), 2, "buy", 5.0), ("u", at(0), 3, "buy", 6.0), ("u", at(9), 4, "view", 6.5)]
    df = spark.createDataFrame(rows, "k string, ts timestamp, n int, kind string, v double")
    got = asof_carry(df, ["k"], ["ts", "n"], F.col("kind") == "buy", "v", 2.0, time_block("ts", 5), F.col("n").cast("string"))
    assert tuples(got, "n", "label") == [(1, "3"), (2, "2"), (3, "3"), (4, "3")]


def test_null_keys_are_refused(spark):
    df = spark.createDataFrame([(None, at(0), 1)], "k string, ts timestamp, n int")
    with pytest.raises(Exception, match="a throttled row needs its key"):
        throttle(df, ["k"], "ts", ["n"], 15).collect()
