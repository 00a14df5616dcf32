"""Validated ingest of reviews as they arrive."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from shelfmark.functions.text import strip
from shelfmark.operators.quality import (
    REVIEW_KEY,
    ReviewReferences,
    review_reasons,
    split_by_reason,
)
from shelfmark.streaming.batches import BatchTables, run_available


BUCKETS = 64


def ingest_reviews(
    stream: DataFrame, refs: ReviewReferences, order: Sequence[str], path: str
) -> StreamingQuery:
    """Accepted reviews to `<path>/accepted`, others to `<path>/rejected` with reasons.

    Reviews accepted by earlier batches count as already given, besides those in `refs.reviewed`. They are
    stored by `bucket`, of the user's hash, and a batch reads the buckets of its own users only.
    """
    tables = BatchTables(path)
    bucket = F.pmod(F.xxhash64(strip("username")), F.lit(BUCKETS)).cast("int")

    def each(rows: DataFrame, batch: int) -> None:
        spark = rows.sparkSession
        rows = rows.persist()
        before = tables.read_before(spark, "accepted", batch)
        given = refs.reviewed
        if before is not None:
            met = [r["b"] for r in rows.select(bucket.alias("b")).distinct().collect()]  # BUCKETS at most
            before = before.where(F.col("bucket").isin(met)).select(*REVIEW_KEY)
            given = before if given is None else given.select(*REVIEW_KEY).unionByName(before)
        judged = review_reasons(rows, replace(refs, reviewed=given), order).persist()
        accepted, rejected = split_by_reason(judged)
        tables.write(accepted.withColumn("bucket", bucket), "accepted", batch, ["bucket"])
        tables.write(rejected, "rejected", batch)
        judged.unpersist()
        rows.unpersist()

    return run_available(stream, each, path)
