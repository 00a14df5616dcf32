"""Streams over several micro-batches against their batch twins."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from shelfmark.operators.ordered import time_block
from shelfmark.operators.quality import ReviewReferences, review_reasons, split_by_reason
from shelfmark.operators.throttle import capture, carry_forward, microseconds, throttle
from shelfmark.streaming.batches import BatchTables, parquet_stream
from shelfmark.streaming.capture import carry_forward_stream, labelled_so_far, throttle_stream, throttled_so_far
from shelfmark.streaming.distinct import write_distinct
from shelfmark.streaming.ingest import ingest_reviews
from tests.conftest import tuples
from tests.test_quality import digest
from tests.test_throttle import DIMS, SCHEMA, at, random_detections, shown_by_scan


def files(folder, *parts):
    """One Parquet file per part, in order."""
    import os

    folder.mkdir(exist_ok=True)
    for df in parts:
        n = len(list(folder.glob("*.parquet")))
        df.toPandas().to_parquet(folder / f"{n}.parquet", coerce_timestamps="us", allow_truncated_timestamps=True)
        os.utime(folder / f"{n}.parquet", (1_700_000_000 + n * 10, 1_700_000_000 + n * 10))
    return str(folder)


def finish(query):
    query.awaitTermination()
    assert query.exception() is None


def test_throttle_stream_equals_batch(spark, tmp_path):
    rows = [("hot" if i % 3 else "cold", at(i * 2.5), i) for i in range(90)]
    rows.append(("new", at(100), 1000))
    rows.append(("new", at(200), 1001))
    df = spark.createDataFrame(sorted(rows, key=lambda r: r[1]), "k string, ts timestamp, n int")
    cuts = [at(0), at(60), at(61), at(150), at(1000)]
    parts = [df.where((F.col("ts") >= a) & (F.col("ts") < b)) for a, b in zip(cuts, cuts[1:])]
    folder = files(tmp_path / "in", *parts)
    path = str(tmp_path / "out")

    def run():
        stream = parquet_stream(spark, folder, "*.parquet", files_per_batch=1)
        finish(throttle_stream(stream, ["k"], "ts", ["n"], 15, path))

    run()
    tables = BatchTables(path)
    expected = tuples(throttle(df, ["k"], "ts", ["n"], 15), "k", "n")
    assert tuples(tables.read_all(spark, "emitted"), "k", "n") == expected
    assert tables.read_all(spark, "late").count() == 0
    assert tuples(throttled_so_far(spark, path, ["k"], "ts", ["n"], 15), "k", "n") == expected

    # A row before the watermark is late; a later one goes on from the stored clock.
    more = spark.createDataFrame([("hot", at(10), 500), ("hot", at(400), 501)], df.schema)
    files(tmp_path / "in", more)
    run()
    assert tuples(tables.read_all(spark, "late"), "n") == [(500,)]
    assert tuples(tables.read_all(spark, "emitted"), "k", "n") == sorted(
        [*expected, ("hot", 501)], key=lambda r: [(x is None, str(x)) for x in r]
    )
    run()
    assert tables.read_all(spark, "emitted").count() == len(expected) + 1


@pytest.mark.parametrize("files_per_batch", [1, 3])
@pytest.mark.parametrize("delay", [60, 10_000])
def test_batch_borders_change_nothing(spark, tmp_path, files_per_batch, delay):
    """Rows out of order by up to a minute, cut into files anywhere, one instant over two files."""
    rng = random.Random(7)
    rows = [(rng.choice("ab"), at(rng.randrange(600) / 2), n) for n in range(300)]
    rows.sort(key=lambda r: r[1] + timedelta(seconds=rng.randrange(60)))
    df = spark.createDataFrame(rows, "k string, ts timestamp, n int")
    parts = [spark.createDataFrame(rows[k : k + 40], df.schema) for k in range(0, 300, 40)]
    stream = parquet_stream(spark, files(tmp_path / "in", *parts), "*.parquet", files_per_batch)
    path = str(tmp_path / "out")
    finish(throttle_stream(stream, ["k"], "ts", ["n"], 15, path, delay_seconds=delay))
    assert BatchTables(path).read_all(spark, "late").count() == 0
    got = throttled_so_far(spark, path, ["k"], "ts", ["n"], 15)
    assert tuples(got, "k", "n") == tuples(throttle(df, ["k"], "ts", ["n"], 15), "k", "n")


@pytest.mark.parametrize("seed", [4])
def test_carry_forward_stream_equals_loop(spark, tmp_path, seed):
    rows = random_detections(seed, 80)
    df = spark.createDataFrame(rows, SCHEMA)
    cuts = [at(0), at(90), at(95), at(250), at(1000)]
    parts = [df.where((F.col("ts") >= a) & (F.col("ts") < b)) for a, b in zip(cuts, cuts[1:])]
    stream = parquet_stream(spark, files(tmp_path / "in", *parts), "*.parquet", files_per_batch=1)
    path = str(tmp_path / "out")
    finish(carry_forward_stream(stream, DIMS, 15, path, block_seconds=20, delay_seconds=30))
    got = labelled_so_far(spark, path, DIMS, 15, block_seconds=20).collect()
    found = {(r["stream_id"], r["ts"], r["det_id"]): r["shown"] for r in got}
    assert len(got) == len(rows)
    assert found == shown_by_scan(rows, 15)
    captured = capture(df, "stream_id", "ts", 15, manual="manual")
    batch = carry_forward(df, captured, "stream_id", "ts", "det_id", "label", DIMS, time_block("ts", 20))
    assert {(r["stream_id"], r["ts"], r["det_id"]): r["shown"] for r in batch.collect()} == found


def test_distinct_stream(spark, tmp_path):
    day = datetime(2024, 1, 1)
    parts = [
        spark.createDataFrame([(u, day) for u in urls], "url string, ts timestamp")
        for urls in (["a", "b", "a"], ["b", "c"], ["a", "d", "d"])
    ]
    folder = files(tmp_path / "in", *parts)
    path = str(tmp_path / "out")
    for _ in range(2):
        stream = parquet_stream(spark, folder, "*.parquet", files_per_batch=1)
        finish(write_distinct(stream, ["url"], path))
        links = BatchTables(path).read_all(spark, "links")
        assert tuples(links, "url") == [("a",), ("b",), ("c",), ("d",)]


def test_distinct_reads_a_share_of_history(spark, tmp_path, monkeypatch):
    """The fewer keys a batch has, the fewer folders of stored keys it reads; nulls are keys too."""
    from shelfmark.sources import store

    monkeypatch.setattr(store, "ROWS_PER_CUT", 50)
    folder, path, reads = tmp_path / "in", str(tmp_path / "out"), []
    unknown = store.Cuts.unknown

    def counted(cuts, first, before):
        read = store.Cuts.read
        names = []
        monkeypatch.setattr(store.Cuts, "read", lambda c, s, n: names.extend(n) or read(c, s, n))
        found = unknown(cuts, first, before)
        monkeypatch.setattr(store.Cuts, "read", read)
        reads.append((len(names), len(before.folders())))
        return found

    monkeypatch.setattr(store.Cuts, "unknown", counted)
    batches = [[f"u{k}" for k in range(1000)] + [None], ["u7", None], ["new"], [f"v{k}" for k in range(300)]]
    for urls in batches:
        files(folder, spark.createDataFrame([(u,) for u in urls], "url string"))
        finish(write_distinct(parquet_stream(spark, str(folder), "*.parquet"), ["url"], path))
    links = BatchTables(path).read_all(spark, "links")
    assert tuples(links, "url") == sorted({(u,) for b in batches for u in b}, key=lambda r: [(x is None, str(x)) for x in r])
    (none, _), (two, all_two), (one, all_one), (many, all_many) = reads
    assert none == 0 and all_two >= 8 and 1 <= two <= 2 and one <= 2 and many > all_many // 2


def test_review_stream_equals_batch(spark, tmp_path):
    refs = ReviewReferences(
        spark.createDataFrame([("ann", digest("pw"))], "username string, password_hash string"),
        spark.createDataFrame([("1",), ("2",)], "moby_id string"),
        spark.createDataFrame([("1", "PC"), ("2", "PC")], "moby_id string, platform string"),
        spark.createDataFrame([("ann", "2", "PC")], "username string, moby_id string, platform string"),
    )
    schema = "n int, username string, password string, moby_id string, platform string, score string"
    rows = [(0, "ann", "pw", "1", "PC", "9"), (1, "ann", "pw", "1", "PC", "4"), (2, "ann", "pw", "1", "PC", "5"),
            (3, "ann", "pw", "2", "PC", "5"), (4, "ann", "pw", "1", "PC", "3"), (5, "bo", "pw", "1", "PC", "3")]
    df = spark.createDataFrame(rows, schema)
    folder = files(tmp_path / "in", df.where("n < 2"), df.where("n IN (2, 3)"), df.where("n > 3"))
    stream = parquet_stream(spark, folder, "*.parquet", files_per_batch=1)
    finish(ingest_reviews(stream, refs, ["n"], str(tmp_path / "out")))
    accepted, rejected = split_by_reason(review_reasons(df, refs, ["n"]))
    tables = BatchTables(str(tmp_path / "out"))
    assert tuples(tables.read_all(spark, "accepted"), "n") == tuples(accepted, "n") == [(1,)]
    assert tuples(tables.read_all(spark, "rejected"), "n", "reason") == tuples(rejected, "n", "reason")


@pytest.mark.parametrize("name, table", [("throttled", "emitted"), ("carried", "labelled")])
def test_registered_streams_emit_in_every_micro_batch(spark, monkeypatch, name, table):
    from bindings import streams

    folders, fresh = {}, streams.fresh_dir
    monkeypatch.setattr(streams, "fresh_dir", lambda s, purpose: folders.setdefault(purpose, fresh(s, purpose)))
    getattr(streams, name)(spark, "/root/testdata/sf0.001")
    path = folders["throttle" if name == "throttled" else "carry"]
    read = lambda x: spark.read.parquet(f"{path}/{x}")
    batches = {r["batch"]: r["count"] for r in read(table).groupBy("batch").count().collect()}
    last = read("marks").agg(F.max("batch")).first()[0]
    assert last >= 2 and set(batches) == set(range(last + 1)) and min(batches.values()) > 0
    assert read("late").count() == 0
    mark = read("marks").where(F.col("batch") == last).first()["mark"]
    waiting = read("waiting").where(microseconds("ts") > mark)
    assert 0 < waiting.count() < spark.read.parquet("/root/testdata/sf0.001/events.parquet").count() / 2


def written(folder):
    """Files below a folder with the times they were written."""
    return {str(f.relative_to(folder)): f.stat().st_mtime_ns for f in folder.rglob("*.parquet")}


def test_waiting_rows_are_written_once(spark, tmp_path):
    """Each batch adds files of its own rows; files of earlier batches stay as they are until their span has passed."""
    rows = [(k % 3, at(10 * k), k) for k in range(120)]
    parts = [spark.createDataFrame(rows[a : a + 20], "k int, ts timestamp, n int") for a in range(0, 120, 20)]
    folder, path = tmp_path / "in", str(tmp_path / "out")
    waiting, before, steps = tmp_path / "out" / "waiting", {}, []
    for k, part in enumerate(parts):
        files(folder, part)
        stream = parquet_stream(spark, str(folder), "*.parquet")
        finish(throttle_stream(stream, ["k"], "ts", ["n"], 30, path, delay_seconds=300))
        now = written(waiting)
        assert all(now[f] == before[f] for f in now if f in before)
        assert all(f"batch={k}" in f for f in now if f not in before)
        steps.append(len(before.keys() - now.keys()))
        before = now
    assert sum(steps) > 0  # spans that have passed are gone
    df = spark.createDataFrame(rows, parts[0].schema)
    got = throttled_so_far(spark, path, ["k"], "ts", ["n"], 30)
    assert tuples(got, "k", "n") == tuples(throttle(df, ["k"], "ts", ["n"], 30), "k", "n")


def test_batch_repeated_after_a_crash(spark, tmp_path, monkeypatch):
    """A batch that breaks off after it wrote its results is run again, with the same results."""
    rows = [(k % 2, at(7 * k), k) for k in range(60)]
    parts = [spark.createDataFrame(rows[a : a + 15], "k int, ts timestamp, n int") for a in range(0, 60, 15)]
    folder, path = tmp_path / "in", str(tmp_path / "out")
    run = lambda: finish(throttle_stream(parquet_stream(spark, str(folder), "*.parquet"), ["k"], "ts", ["n"], 15, path, delay_seconds=60))
    forget = BatchTables.forget
    for part in parts:
        files(folder, part)

        def broken(self, *args):
            raise OSError("lost")

        monkeypatch.setattr(BatchTables, "forget", broken)
        with pytest.raises(Exception, match="lost"):
            run()
        monkeypatch.setattr(BatchTables, "forget", forget)
        run()
    df = spark.createDataFrame(rows, parts[0].schema)
    got = throttled_so_far(spark, path, ["k"], "ts", ["n"], 15)
    assert tuples(got, "k", "n") == tuples(throttle(df, ["k"], "ts", ["n"], 15), "k", "n")


def test_boxes_of_closed_epochs_are_not_kept(spark, tmp_path):
    rows = random_detections(9, 80)
    df = spark.createDataFrame(rows, SCHEMA)
    cuts = [at(0), at(60), at(120), at(180), at(1000)]
    parts = [df.where((F.col("ts") >= a) & (F.col("ts") < b)) for a, b in zip(cuts, cuts[1:])]
    stream = parquet_stream(spark, files(tmp_path / "in", *parts), "*.parquet", files_per_batch=1)
    path = str(tmp_path / "out")
    finish(carry_forward_stream(stream, DIMS, 15, path, block_seconds=20, delay_seconds=10))
    boxes, captured = spark.read.parquet(f"{path}/boxes"), spark.read.parquet(f"{path}/captured")
    for batch in [r["batch"] for r in boxes.select("batch").distinct().collect()]:
        auto = captured.where((F.col("batch") <= batch) & (F.col("trigger") == "auto")).groupBy("stream_id").agg(F.max("ts").alias("t"))
        kept = boxes.where(F.col("batch") == batch).join(auto, "stream_id")
        assert kept.where(F.col("ts") < F.col("t")).count() == 0


def test_larger_tables_come_in_no_more_micro_batches(spark, monkeypatch):
    """A stretch of a larger table is more files, of one micro-batch with its neighbours, and holds every row."""
    from bindings import streams

    asked, opened = [], streams.parquet_stream
    monkeypatch.setattr(
        streams, "parquet_stream",
        lambda s, folder, pattern, files_per_batch: asked.append((folder, files_per_batch)) or opened(s, folder, pattern, files_per_batch),
    )
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet").count()
    monkeypatch.setattr(streams, "FILE_ROWS", -(-events // (streams.STRETCHES * 4)))
    streams.arriving(spark, "/root/testdata/sf0.001", "events", "ts", "event_id")
    streams.scattered(spark, "/root/testdata/sf0.001", "events", "event_id")
    for folder, files_per_batch in asked:
        rows = spark.read.parquet(folder)
        assert files_per_batch == 3 * 4 and len(rows.inputFiles()) == streams.STRETCHES * 4
        assert rows.count() == rows.select("event_id").distinct().count() == events
