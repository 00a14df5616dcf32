"""Session settings and the shared folder for checkpoints and staged tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even where that costs one more exchange later.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def prepare(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach: `spark.checkpoint.dir`.

    Where the session names none, a local master gets a temporary folder and
    any other master is refused, since its executors could not read it.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(named)
        return named
    if sc.getCheckpointDir():
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="shelfmark-"))
    return sc.getCheckpointDir()


def fresh_dir(spark: SparkSession, purpose: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: survives the loss of executors."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def staged(df: DataFrame, purpose: str) -> DataFrame:
    """The rows written once to the shared folder, for plans that read them several times. Unlike a checkpoint, the
    table is compressed, and a reader takes the columns it needs."""
    folder = fresh_dir(df.sparkSession, purpose)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def parallelism(spark: SparkSession) -> int:
    """Reduce-side width of the session; hot groups are split this many ways."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


# Operators whose output may be larger than Catalyst's estimate, and how far files are compressed.
GROWING = ("Generate", "Expand", "Join", "Map", "Python", "Range", "LogicalRDD")
INFLATION = 8


def fits_broadcast(df: DataFrame) -> bool:
    """Whether all files the rows come from, unpacked, are within `spark.sql.autoBroadcastJoinThreshold`.

    Catalyst's estimate of the result itself is no bound: it ignores how many rows an explode or
    a join makes and shrinks with every column left out. So it is taken at the leaves, where it is the size of
    the files, and only for plans that cannot make rows.
    """
    plan = df._jdf.queryExecution().optimizedPlan()
    names = [line.lstrip(" :+-").split(" ")[0].split("(")[0] for line in plan.treeString().splitlines()]
    if any(word in name for name in names for word in GROWING):
        return False
    conf = df.sparkSession._jsparkSession.sessionState().conf()
    return unpacked_bytes(plan) <= int(conf.autoBroadcastJoinThreshold())


def unpacked_bytes(plan) -> int:
    """Size of the leaves of a logical plan, files as if unpacked."""
    leaves, total = plan.collectLeaves(), 0
    for k in range(leaves.size()):
        size = int(str(leaves.apply(k).stats().sizeInBytes()))
        total += size if leaves.apply(k).nodeName() == "LocalRelation" else size * INFLATION
    return total
