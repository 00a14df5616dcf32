"""Keyed text tables that grow by merges: cuts of the key's hash, and manifests that say what they hold.

A table is a folder with `data`, the CSV files of all merges, and `manifests`, one per version. Rows lie in cuts
by the hash of their key; a manifest names for every cut the folders that hold its rows. A merge reads the cuts
that its new keys fall into, writes the rows whose key isn't there yet, and puts the next manifest in place by one
rename. Stored rows win, so a merge only adds: no file of an earlier merge is written again but where a cut has
got FOLDERS_PER_CUT folders, which become one, or the table has outgrown its cuts, whose number is then raised for
all rows at once. A merge that breaks off leaves folders that no manifest names; `vacuum` drops them.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from shelfmark.operators.skew import null_safe_join
from shelfmark.schemas import COLUMNS, SINK_KEYS, text_schema
from shelfmark.sources.readers import read_text_csv
from shelfmark.sources.sinks import _filesystem, folders, merge_keep_first, remove, write_csv

ROWS_PER_CUT = 200_000
FOLDERS_PER_CUT = 8
CUT = "_cut"


@dataclass
class Manifest:
    """Number of the version, leading bits of the hash that name a cut, rows, folders below `data` by cut."""

    version: int = 0
    bits: int = 0
    rows: int = 0
    cuts: dict[int, list[str]] = field(default_factory=dict)

    def folders(self, cuts: Sequence[int] | None = None) -> list[str]:
        return [f for c in (self.cuts if cuts is None else cuts) for f in self.cuts.get(c, [])]


def _path(spark: SparkSession, text: str):
    fs, jvm = _filesystem(spark, text)
    return fs, jvm.org.apache.hadoop.fs.Path(text)


def _files(spark: SparkSession, path: str) -> list[str]:
    fs, at = _path(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(at)] if fs.exists(at) else []


def current(spark: SparkSession, path: str, until: int | None = None) -> Manifest:
    """The newest manifest, or the newest up to version `until`; an empty one if there is none."""
    versions = sorted(f for f in _files(spark, f"{path}/manifests") if f.startswith("v") and f.endswith(".json"))
    if until is not None:
        versions = [f for f in versions if int(f[1:-5]) <= until]
    if not versions:
        return Manifest()
    text = "\n".join(r[0] for r in spark.read.text(f"{path}/manifests/{versions[-1]}").collect())
    told = json.loads(text)
    return Manifest(told["version"], told["bits"], told["rows"], {int(k): v for k, v in told["cuts"].items()})


def publish(spark: SparkSession, path: str, manifest: Manifest) -> None:
    """Put a manifest in place by one rename; another merge that got there first makes this one fail."""
    name = f"{path}/manifests/v{manifest.version:012d}.json"
    fs, target = _path(spark, name)
    _, draft = _path(spark, f"{path}/manifests/draft-{uuid.uuid4().hex}")
    out = fs.create(draft)
    out.write(bytearray(json.dumps(vars(manifest)).encode()))
    out.close()
    if fs.exists(target) or not fs.rename(draft, target):
        fs.delete(draft, False)
        raise OSError(f"{name}: another merge came first")


def cut_of(keys: Sequence[str], bits: int) -> Column:
    return F.shiftrightunsigned(F.xxhash64(*[f"`{k}`" for k in keys]), 64 - bits).cast("int") if bits else F.lit(0)


@dataclass
class Cuts:
    """How the rows of a table with these columns and keys are read and written below its path."""

    path: str
    columns: Sequence[str]
    keys: Sequence[str]
    schema: T.StructType | None = None  # of Parquet files; CSV files of texts without it

    def read(self, spark: SparkSession, names: Sequence[str]) -> DataFrame:
        schema = self.schema or text_schema(list(self.columns))
        if not names:
            return spark.createDataFrame([], schema)
        paths = [f"{self.path}/data/{n}" for n in names]
        return spark.read.schema(schema).parquet(*paths) if self.schema else read_text_csv(spark, paths, self.columns)

    def write(self, rows: DataFrame, bits: int) -> dict[int, list[str]]:
        """Rows in one new folder by cut; the folder of each cut that has any."""
        spark, name = rows.sparkSession, uuid.uuid4().hex
        placed = rows.withColumn(CUT, cut_of(self.keys, bits)).repartition(F.col(CUT))
        target = f"{self.path}/data/{name}"
        if self.schema:
            placed.write.partitionBy(CUT).parquet(target)
        else:
            write_csv(placed, target, by=[CUT])
        made = [f for f in folders(spark, target) if f.startswith(f"{CUT}=")]
        return {int(f.partition("=")[2]): [f"{name}/{f}"] for f in made}

    def unknown(self, first: DataFrame, before: Manifest) -> DataFrame:
        """Of rows with distinct keys those whose key isn't stored. Only the cuts that they fall into are read."""
        spark = first.sparkSession
        met = [r[0] for r in first.select(cut_of(self.keys, before.bits)).distinct().collect()]  # at most all cuts
        names = before.folders(met)
        if not names:
            return first
        known = self.read(spark, names).select(*[F.col(f"`{k}`") for k in self.keys]).withColumn("_known", F.lit(True))
        found = null_safe_join(first, known, self.keys, "left").where("_known IS NULL")
        return found.select(*[f"`{c}`" for c in self.columns])

    def add(self, before: Manifest, fresh: DataFrame, count: int) -> Manifest:
        """The manifest with rows whose keys aren't stored yet, their files written."""
        spark = fresh.sparkSession
        after = Manifest(before.version + 1, before.bits, before.rows + count, {k: list(v) for k, v in before.cuts.items()})
        while after.rows > 2 * ROWS_PER_CUT << after.bits:
            after.bits += 1
        if after.bits > before.bits:
            after.cuts = self.write(self.read(spark, before.folders()).unionByName(fresh), after.bits)
        elif count:
            for cut, made in self.write(fresh, after.bits).items():
                after.cuts[cut] = after.cuts.get(cut, []) + made
            full = [cut for cut, names in after.cuts.items() if len(names) >= FOLDERS_PER_CUT]
            if full:
                after.cuts |= self.write(self.read(spark, after.folders(full)), after.bits)
        return after


def _cuts(path: str, table: str) -> Cuts:
    return Cuts(path.rstrip("/"), COLUMNS[table], SINK_KEYS[table] or COLUMNS[table])


def read_store(spark: SparkSession, path: str, table: str) -> DataFrame:
    """All rows of the newest version."""
    return _cuts(path, table).read(spark, current(spark, path).folders())


def merge_store(new: DataFrame, path: str, table: str, order: Sequence[str] = ()) -> Manifest:
    """Merge rows into a stored table; the stored row of a key wins, and of new rows the first by `order`.

    Rows of a table without keys count as copies if they are equal. An empty `new` leaves the table as it is, or
    makes an empty first version.
    """
    spark, cuts = new.sparkSession, _cuts(path, table)
    before = current(spark, cuts.path)
    first = merge_keep_first(None, new, cuts.columns, SINK_KEYS[table], order).persist()
    fresh = cuts.unknown(first, before).persist()
    count = fresh.count()
    if not count and before.version:
        after = before
    else:
        after = cuts.add(before, fresh, count)
        publish(spark, cuts.path, after)
    fresh.unpersist()
    first.unpersist()
    return after


def vacuum(spark: SparkSession, path: str) -> list[str]:
    """Drop what the newest version doesn't name: older manifests, drafts and folders of rows. No merge or reader
    of an older version may be at work."""
    manifest = current(spark, path)
    kept, gone = set(manifest.folders()), []
    for name in folders(spark, f"{path}/data"):
        parts = [f"{name}/{f}" for f in folders(spark, f"{path}/data/{name}")]
        gone += [p for p in parts if p not in kept] if any(p in kept for p in parts) else [name]
    for name in gone:
        remove(spark, f"{path}/data/{name}")
    for name in _files(spark, f"{path}/manifests"):
        if not name.startswith(".") and name != f"v{manifest.version:012d}.json":
            remove(spark, f"{path}/manifests/{name}")
    return gone
