"""Ranked lexical search: item bundles travel through stages of term owners.

Documents are cut into shards of at most a thousand rows. For a shard, the places of all terms that any
item holds are written once, as posting lists. Terms belong to owners by how rare they are: the first
stage owns the rarest terms, the last one the most frequent. A bundle is a group of items on its way
through one shard; it carries, for every item, a sparse accumulator of the documents met so far. In each
stage the bundle meets the posting lists of that owner (cogroup by shard and group), adds their integer
contributions and goes on. After the last stage each bundle gives its best documents, and the best of
all shards are chosen.

What is dropped on the way can't be in the result: a bundle knows how much each item can still gain in the
stages to come, from the largest contribution of every term in the shard. A document that stays below
the k-th best accumulator of its item even with all of that leaves the bundle.

Items are taken in runs of at most RUN_TERMS (item, term) pairs, so that the dictionary that all tasks get has
a bound; the runs are as many as the items need.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from shelfmark.llm import words as W
from shelfmark.llm.blocks import pack, ready, staged, unpack

STAGES = 4
# A term that fewer than one in so many documents holds belongs to the owner of that place.
RARITY = (1024, 64, 8)
GROUP_ITEMS = 256
RUN_TERMS = 1 << 20

# Everything but digits, letters A-Z and a-z, and what lies beyond ASCII.
GAPS = np.ones(256, dtype=bool)
GAPS[0x30:0x3A] = GAPS[0x41:0x5B] = GAPS[0x61:0x7B] = GAPS[0x80:] = False

SHARD = "shard long, n_docs long, n_with long, n_terms long, terms array<long>, found array<long>, postings binary"
BUNDLE = "shard long, grp int, bundle binary"
FOUND = "item_id long, doc_id long, score long"


def terms_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every term of the texts in order, and where each text's terms start."""
    buf, offsets = W.buffers(column)
    buf = W.LOWER[buf]
    starts, ends, firsts = W.spans(buf, offsets, GAPS)
    return W.word_hashes(buf, starts, ends).view(np.int64), firsts


@dataclass
class Items:
    """The items of a run in groups: the terms of all, and for each item which of them it holds."""

    ids: np.ndarray
    firsts: np.ndarray
    held: np.ndarray
    terms: np.ndarray
    weights: np.ndarray | None = None
    owners: np.ndarray | None = None

    @classmethod
    def of(cls, pairs: list[tuple[int, int]]) -> Items:
        """From distinct (item, term) pairs."""
        flat = np.array(sorted(pairs), dtype=np.int64).reshape(-1, 2)
        ids, firsts = np.unique(flat[:, 0], return_index=True)
        terms, held = np.unique(flat[:, 1], return_inverse=True)
        return cls(ids, np.append(firsts, len(flat)), held, terms)

    @property
    def groups(self) -> int:
        return -(-len(self.ids) // GROUP_ITEMS)

    def group(self, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of a group's items, and its (place of the item in the group, term) pairs."""
        a, b = k * GROUP_ITEMS, min((k + 1) * GROUP_ITEMS, len(self.ids))
        edges = self.firsts[a : b + 1]
        return self.ids[a:b], np.repeat(np.arange(b - a), np.diff(edges)), self.held[edges[0] : edges[-1]]


def item_terms(items: DataFrame, id: str, text: str) -> DataFrame:
    """Distinct (item_id, term) pairs; rows with the same id are one item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h, firsts = terms_of(batch.column("text"))
            ids = np.repeat(batch.column("id").to_numpy(), np.diff(firsts))
            yield pa.RecordBatch.from_pydict({"item_id": pa.array(ids, pa.int64()), "term": pa.array(h, pa.int64())})

    rows = items.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text")).where("id IS NOT NULL AND text IS NOT NULL")
    return rows.mapInArrow(run, "item_id long, term long").distinct()


def _shards(docs: DataFrame, terms: np.ndarray) -> DataFrame:
    """Posting lists of the given terms, staged. Each list says which rows of the shard hold the term, and how often."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = TaskContext.get().partitionId() << 32
        for batch in batches:
            if batch.num_rows:
                yield shard(at, batch)
                at += 1

    def shard(at: int, batch: pa.RecordBatch) -> pa.RecordBatch:
        h, firsts = terms_of(batch.column("text"))
        n = np.diff(firsts)
        place = np.minimum(np.searchsorted(terms, h), max(0, len(terms) - 1))
        known = np.flatnonzero(terms[place] == h) if len(terms) else np.zeros(0, dtype=np.int64)
        row = np.repeat(np.arange(len(n)), n)[known]
        key, tf = np.unique(place[known] * len(n) + row, return_counts=True)
        term, row = np.divmod(key, len(n))
        # n travels with the postings, for the contributions
        lists = pa.table({"term": term, "row": row.astype(np.int32), "tf": tf})
        docs = pa.table({"id": batch.column("id"), "n": n})
        met, found = np.unique(term, return_counts=True)
        blob = pack(lists), pack(docs)
        return pa.RecordBatch.from_pydict(
            {
                "shard": pa.array([at], pa.int64()),
                "n_docs": pa.array([len(n)], pa.int64()),
                "n_with": pa.array([int((n > 0).sum())], pa.int64()),
                "n_terms": pa.array([int(n.sum())], pa.int64()),
                "terms": pa.array([met], pa.list_(pa.int64())),
                "found": pa.array([found], pa.list_(pa.int64())),
                "postings": pa.array([len(blob[0]).to_bytes(8, "little") + blob[0] + blob[1]], pa.binary()),
            }
        )

    return staged(docs.mapInArrow(run, SHARD), "postings")


def _opened(blob: pa.Scalar) -> tuple[pa.Table, pa.Table]:
    data = blob.as_buffer()
    cut = 8 + int.from_bytes(data[:8].to_pybytes(), "little")
    return unpack(data[8:cut]), unpack(data[cut:])


def _gains(lists: pa.Table, docs: pa.Table, items: Items, n_with: int, n_all: int) -> np.ndarray:
    """What each posting adds to a document's score."""
    term, row, tf = (lists.column(c).to_numpy() for c in ("term", "row", "tf"))
    m = 100 - 90 + (90 * docs.column("n").to_numpy() * n_with) // max(1, n_all)
    return items.weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[row]))


def _best(scores: np.ndarray, k: int) -> np.ndarray:
    """The k-th highest number of each row; 0 where there are fewer."""
    if scores.shape[1] < k:
        return np.zeros(len(scores), dtype=np.int64)
    return np.partition(scores, scores.shape[1] - k, axis=1)[:, -k]


def _sparse(scores: np.ndarray, rest: np.ndarray) -> bytes:
    item, row = np.nonzero(scores)
    table = pa.table({"item": item.astype(np.int16), "row": row.astype(np.int32), "score": scores[item, row]})
    blob = pack(table)
    return np.array([len(scores), scores.shape[1], len(blob)], dtype="<i8").tobytes() + blob + rest.astype("<i8").tobytes()


def _dense(bundle: pa.Scalar) -> tuple[np.ndarray, np.ndarray]:
    data = bundle.as_buffer()
    n_items, n_rows, size = np.frombuffer(data[:24], dtype="<i8")
    table = unpack(data[24 : 24 + int(size)])
    scores = np.zeros((n_items, n_rows), dtype=np.int64)
    scores[table.column("item").to_numpy(), table.column("row").to_numpy()] = table.column("score").to_numpy()
    return scores, np.frombuffer(data[24 + int(size) :], dtype="<i8").reshape(n_items, STAGES)


def ranked_search(
    docs: DataFrame, items: DataFrame, k: int = 10, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text"
) -> DataFrame:
    """The k documents of highest score above 0 for each item: item_id, rank, doc_id, score.

    Terms are maximal runs of digits, letters A-Z (lower-cased) and characters beyond ASCII, in whole texts; null
    and empty texts have none. Rows with a null id, of documents or items, take no part and are not counted.
    Documents that share an id are ranked each on their own; items that share one are one item with the terms of
    all. Equal scores rank by the smaller doc_id. An empty table of either kind gives no rows, and so does an item
    without a term that any document holds. Other columns of both tables are left out, whatever their names.
    Terms are compared by 64-bit hashes; scores are 64-bit integers.
    """
    spark = ready(docs.sparkSession)
    read = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text")).where("id IS NOT NULL")
    pairs = staged(item_terms(items, item_id, text), "item-terms")
    runs = 1
    while True:  # more runs until each is small enough, or holds one item
        run_of = F.pmod(F.xxhash64("item_id"), F.lit(runs))
        sizes = pairs.groupBy("item_id").count().groupBy(run_of.alias("run"))
        sizes = sizes.agg(F.sum("count").alias("n"), F.count("*").alias("items")).where(F.col("items") > 1)
        if (sizes.agg(F.max("n")).first()[0] or 0) <= RUN_TERMS:
            break
        runs *= 2
    found = None
    for run in range(runs):
        some = Items.of([(r[0], r[1]) for r in pairs.where(run_of == run).toLocalIterator()])
        if len(some.ids):
            part = _run(read, some, k)
            found = part if found is None else found.unionByName(part)
    if found is None:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), "doc_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("item_id", "rank", "doc_id", "score")


def _run(docs: DataFrame, items: Items, k: int) -> DataFrame:
    """Candidates of the items of one run: the k best of each shard."""
    shards = _shards(docs, items.terms)
    total = shards.agg(F.sum("n_with"), F.sum("n_terms")).first()
    n_with, n_all = total[0] or 0, total[1] or 0
    counts = shards.select(F.explode(F.arrays_zip("terms", "found")).alias("t")).groupBy("t.terms").agg(F.sum("t.found").alias("df"))
    weight = F.floor(1000 * F.log(F.lit(2.0 * n_with + 2) / (2 * F.col("df") + 1).cast("double")))
    items.weights, items.owners = np.zeros(len(items.terms), dtype=np.int64), np.zeros(len(items.terms), dtype=np.int8)
    for row in counts.select("terms", weight.alias("w"), "df").collect():  # at most the terms of a run
        items.weights[row["terms"]] = row["w"]
        items.owners[row["terms"]] = sum(row["df"] * share >= n_with for share in RARITY)

    def depart(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Bundles without documents, and what each item can gain in the shard by stage."""
        for batch in batches:
            for at, blob in zip(batch.column("shard").to_pylist(), batch.column("postings"), strict=True):
                lists, docs = _opened(blob)
                most = np.zeros(len(items.terms), dtype=np.int64)
                np.maximum.at(most, lists.column("term").to_numpy(), _gains(lists, docs, items, n_with, n_all))
                bundles = []
                for g in range(items.groups):
                    ids, item, term = items.group(g)
                    rest = np.zeros((len(ids), STAGES), dtype=np.int64)
                    np.add.at(rest, (item, items.owners[term]), most[term])
                    bundles.append(_sparse(np.zeros((len(ids), docs.num_rows), dtype=np.int64), rest))
                yield pa.RecordBatch.from_pydict(
                    {"shard": pa.array([at] * len(bundles), pa.int64()), "grp": pa.array(range(len(bundles)), pa.int32()), "bundle": bundles}
                )

    def owned(stage: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            """The posting lists of one owner, with contributions, for every group of items."""
            for batch in batches:
                for at, blob in zip(batch.column("shard").to_pylist(), batch.column("postings"), strict=True):
                    lists, docs = _opened(blob)
                    mine = items.owners[lists.column("term").to_numpy()] == stage
                    gains = _gains(lists, docs, items, n_with, n_all)
                    kept = pack(lists.drop_columns("tf").append_column("gain", pa.array(gains)).filter(pa.array(mine)))
                    ids = pack(docs.select(["id"])) if stage == STAGES - 1 else b""
                    body = len(kept).to_bytes(8, "little") + kept + ids
                    yield pa.RecordBatch.from_pydict(
                        {
                            "shard": pa.array([at] * items.groups, pa.int64()),
                            "grp": pa.array(range(items.groups), pa.int32()),
                            "bundle": pa.array([body] * items.groups, pa.binary()),
                        }
                    )

        return run

    def meet(stage: int):
        last = stage == STAGES - 1

        def run(left: pa.Table, right: pa.Table) -> pa.Table:
            at, g = left.column("shard")[0].as_py(), left.column("grp")[0].as_py()
            scores, rest = _dense(left.column("bundle")[0])
            data = right.column("bundle")[0].as_buffer()
            cut = 8 + int.from_bytes(data[:8].to_pybytes(), "little")
            lists = unpack(data[8:cut])
            item_ids, item, term = items.group(g)
            mine = items.owners[term] == stage
            add(scores, item[mine], term[mine], lists)
            more = rest[:, stage + 1 :].sum(axis=1)
            scores[scores + more[:, None] < _best(scores, k)[:, None]] = 0
            if not last:
                return pa.table({"shard": pa.array([at]), "grp": pa.array([g], pa.int32()), "bundle": pa.array([_sparse(scores, rest)], pa.binary())})
            doc_ids = unpack(data[cut:]).column("id").to_numpy()
            item, row = np.nonzero(scores)
            order = np.lexsort((doc_ids[row], -scores[item, row], item))
            item, row = item[order], row[order]
            place = np.arange(len(item)) - np.searchsorted(item, item)
            item, row = item[place < k], row[place < k]
            return pa.table({"item_id": item_ids[item], "doc_id": pa.array(doc_ids[row], pa.int64()), "score": scores[item, row]})

        return run

    def add(scores: np.ndarray, item: np.ndarray, term: np.ndarray, lists: pa.Table) -> None:
        """Add the posting list of each (item, term) pair to the item's accumulator."""
        of, row, gain = (lists.column(c).to_numpy() for c in ("term", "row", "gain"))
        firsts = np.searchsorted(of, term)
        counts = np.searchsorted(of, term, "right") - firsts
        places = W.rows_of(firsts, counts)
        np.add.at(scores.reshape(-1), np.repeat(item, counts) * scores.shape[1] + row[places], gain[places])

    postings = shards.select("shard", "postings")
    bundles = postings.mapInArrow(depart, BUNDLE)
    for stage in range(STAGES):
        owner = postings.mapInArrow(owned(stage), BUNDLE)
        result = FOUND if stage == STAGES - 1 else BUNDLE
        bundles = bundles.groupBy("shard", "grp").cogroup(owner.groupBy("shard", "grp")).applyInArrow(meet(stage), result)
    return bundles
