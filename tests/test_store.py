"""Keyed tables by cuts: merges against a plain dictionary, files written, crashes."""

import random

import pytest

from shelfmark.sources import store as S
from tests.conftest import tuples

SCHEMA = "moby_id string, name string, overview string, n int"


def people(spark, rows):
    return spark.createDataFrame([(i, n, o, k) for k, (i, n, o) in enumerate(rows)], SCHEMA)


def files(folder):
    return {str(f.relative_to(folder)): f.stat().st_mtime_ns for f in (folder / "data").rglob("part-*")}


def stored(spark, path):
    return tuples(S.read_store(spark, str(path), "contributors"), "moby_id", "name", "overview")


def test_merges_equal_dictionary(spark, tmp_path, monkeypatch):
    """Cuts multiply and folders are put together on the way; the first row of a key stays."""
    monkeypatch.setattr(S, "ROWS_PER_CUT", 20)
    monkeypatch.setattr(S, "FOLDERS_PER_CUT", 3)
    r, expected, bits = random.Random(1), {}, []
    for turn in range(5):
        rows = [(str(r.randrange(60 * (turn + 1))), f"n{turn}.{k}", 'a "b",\nc' if k % 3 else "") for k in range(40)]
        bits.append(S.merge_store(people(spark, rows), str(tmp_path), "contributors", ["n"]).bits)
        for i, n, o in rows:
            expected.setdefault(i, (i, n, o))
    assert stored(spark, tmp_path) == sorted(expected.values(), key=lambda t: [(False, str(x)) for x in t])
    manifest = S.current(spark, str(tmp_path))
    assert manifest.rows == len(expected) and manifest.version == 5 and bits[0] == 0 and bits[-1] >= 1
    assert max(map(len, manifest.cuts.values())) < 3
    before = stored(spark, tmp_path)
    assert S.vacuum(spark, str(tmp_path)) and stored(spark, tmp_path) == before


def test_only_new_rows_are_written(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(S, "ROWS_PER_CUT", 20)
    S.merge_store(people(spark, [(str(k), f"n{k}", "x") for k in range(200)]), str(tmp_path), "contributors", ["n"])
    first, manifest = files(tmp_path), S.current(spark, str(tmp_path))
    assert len(manifest.cuts) == 8
    S.merge_store(people(spark, [("7", "again", "x"), ("new", "New", "y")]), str(tmp_path), "contributors", ["n"])
    second = files(tmp_path)
    assert all(second[f] == first[f] for f in first) and len(second) == len(first) + 1
    after = S.current(spark, str(tmp_path))
    assert sum(after.cuts[c] != manifest.cuts[c] for c in manifest.cuts) == 1
    S.merge_store(people(spark, [("7", "again", "x")]), str(tmp_path), "contributors", ["n"])
    assert files(tmp_path) == second and S.current(spark, str(tmp_path)) == after
    assert ("7", "n7", "x") in stored(spark, tmp_path) and ("new", "New", "y") in stored(spark, tmp_path)


def test_crash_before_the_switch_leaves_the_old_table(spark, tmp_path, monkeypatch):
    S.merge_store(people(spark, [("1", "Ann", "")]), str(tmp_path), "contributors", ["n"])
    publish = S.publish

    def lost(*_):
        raise OSError("lost")

    monkeypatch.setattr(S, "publish", lost)
    with pytest.raises(OSError, match="lost"):
        S.merge_store(people(spark, [("2", "Bo", "")]), str(tmp_path), "contributors", ["n"])
    monkeypatch.setattr(S, "publish", publish)
    assert stored(spark, tmp_path) == [("1", "Ann", "")]
    assert len(S.vacuum(spark, str(tmp_path))) == 1
    S.merge_store(people(spark, [("2", "Bo", "")]), str(tmp_path), "contributors", ["n"])
    assert stored(spark, tmp_path) == [("1", "Ann", ""), ("2", "Bo", "")]


def test_of_two_merges_at_once_one_fails(spark, tmp_path):
    S.merge_store(people(spark, [("1", "Ann", "")]), str(tmp_path), "contributors", ["n"])
    with pytest.raises(OSError, match="came first"):
        S.publish(spark, str(tmp_path), S.Manifest(1))


def test_empty_and_null_keys(spark, tmp_path):
    S.merge_store(people(spark, []), str(tmp_path), "contributors", ["n"])
    assert stored(spark, tmp_path) == [] and S.current(spark, str(tmp_path)).version == 1
    for _ in range(2):
        S.merge_store(people(spark, [(None, "x", None), ("", "y", ""), ("1", None, None)]), str(tmp_path), "contributors", ["n"])
    assert stored(spark, tmp_path) == [("", "x", ""), ("1", "", "")]
