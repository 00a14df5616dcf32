"""Incremental distinct of discovered links."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from shelfmark.sources.store import Cuts, current, publish
from shelfmark.streaming.batches import BatchTables, run_available


def write_distinct(stream: DataFrame, keys: Sequence[str], path: str) -> StreamingQuery:
    """Append new keys to `<path>/links` until the available input is used up.

    Repeats inside a micro-batch go before the exchange, so a hot key does not flood one task; then the
    keys of earlier batches go by a join with the stored ones. These lie in `<path>/known`, in cuts of the key's
    hash whose number grows with the keys, and only cuts that the new keys fall into are read: the fewer keys a
    batch has, the smaller is the share of history that it meets. Micro-batch n makes version n + 1 of the stored
    keys from version n, so a repeated batch starts where it started first.
    """
    tables, keys = BatchTables(path), list(keys)

    def each(rows: DataFrame, batch: int) -> None:
        spark = rows.sparkSession
        new = rows.select(*keys).dropDuplicates().persist()
        cuts = Cuts(f"{tables.path}/known", keys, keys, new.schema)
        before = current(spark, cuts.path, batch)
        tables.write(cuts.unknown(new, before), "links", batch)
        new.unpersist()
        if current(spark, cuts.path).version <= batch:
            fresh = tables.read_one(spark, "links", batch)
            after = cuts.add(before, fresh, fresh.count())
            after.version = batch + 1
            publish(spark, cuts.path, after)

    return run_available(stream, each, path)
