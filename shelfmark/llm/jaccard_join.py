"""N-gram Jaccard join: exact groups of documents whose word shingle sets are similar.

Jaccard distance is a metric, but unrelated texts are all at distance 1, where the triangle
inequality says nothing. So regions are made in two ways.

First level, pivots are the first documents of shared shingles. Shingles are ordered by the number of
documents that hold them, then by hash. Two sets with similarity s share one of the first
n - ceil(s n) + 1 shingles of either in any fixed order. Every such shingle that two sets have
names as pivot the first set that holds it, and the region of a pivot is all sets it is named
for; a set at a border belongs to several regions. Rare shingles come first, so unrelated documents
with a common passage meet nowhere. A census of all shingles gives the counts, and a
document that has too few shared shingles to be similar to any other is alone at once.

Inside a region the distance d(x, p) to its pivot p is known for all x. Those within r = 1 - s are
linked to it. Any other link x, y has |d(x, p) - d(y, p)| <= r, the triangle window. While a region
holds several components, sets outside its largest one become pivots in turn, within their windows;
a pair both of whose sets are in the largest component needs no look, since the result is components. A
region that fits a task is joined there. A larger one is cut into slices, its new pivots go
to every slice, and it is taken up again after the components are known anew.

Sets are 64-bit hashes of shingles. Equal sets are one class, by 128 bits of their digest, and a class
takes part once, however many copies it has. No pair of copies and no candidate pair is ever
written; links are at most one per set and pivot.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from shelfmark.llm import blocks as B, words as W
from shelfmark.session import cut_lineage, parallelism

WORDS = 5
PERCENT = 80
# Shingles of a region joined in one task, sets of a region, new pivots of a larger region that go to a task together.
REGION_SHINGLES = 1 << 20
REGION_SETS = 5000
PIVOTS = 256
# Pivots of a round in groups of PIVOTS: four times as many as in the round before, up to these.
MOST_GROUPS = 16
# Links contracted at once in a task.
LINKS_AT_ONCE = 1 << 20

FOUND = "block long, place int, id long, n long, set binary, shared array<long>, body string"


class Sets:
    """Sorted distinct shingles of several texts, one after the other."""

    def __init__(self, texts: pa.Array | pa.ChunkedArray, width: int):
        buf, offsets = W.buffers(texts)
        buf = W.LOWER[buf]
        starts, ends, firsts = W.spans(buf, offsets)
        h = W.word_hashes(buf, starts, ends)
        n = np.diff(firsts)
        long, counts = W.windows(h, firsts, width)
        edges = np.append(0, np.cumsum(counts))
        parts = []
        for k in range(len(n)):
            if n[k] >= width:
                parts.append(np.unique(long[edges[k] : edges[k + 1]]))
            elif n[k]:  # too short: all its words are its one shingle
                parts.append(W.windows(h[firsts[k] : firsts[k + 1]], np.array([0, n[k]]), int(n[k]), 100 + int(n[k]))[0])
            else:
                parts.append(np.zeros(0, dtype=np.uint64))
        self.n = np.array([len(p) for p in parts], dtype=np.int64)
        self.edges = np.append(0, np.cumsum(self.n))
        self.flat = np.concatenate(parts) if parts else np.zeros(0, dtype=np.uint64)

    def one(self, k: int) -> np.ndarray:
        return self.flat[self.edges[k] : self.edges[k + 1]]


class Region:
    """Sets of a region with an index from shingles to sets."""

    def __init__(self, sets: Sets):
        self.sets = sets
        self.codes, inverse = np.unique(sets.flat, return_inverse=True)
        owner = np.repeat(np.arange(len(sets.n)), sets.n)
        order = np.argsort(inverse, kind="stable")
        self.owner = owner[order]
        self.heads = np.searchsorted(inverse[order], np.arange(len(self.codes) + 1))

    def overlap(self, shingles: np.ndarray) -> np.ndarray:
        """Size of the intersection with every set of the region."""
        at = np.minimum(np.searchsorted(self.codes, shingles), len(self.codes) - 1)
        at = at[self.codes[at] == shingles]
        counts = self.heads[at + 1] - self.heads[at]
        return np.bincount(self.owner[W.rows_of(self.heads[at], counts)], minlength=len(self.sets.n))


def linked(common: np.ndarray, n: np.ndarray, m: int, percent: int) -> np.ndarray:
    return 100 * common >= percent * (n + m - common)


def distance(common: np.ndarray, n: np.ndarray, m: int) -> np.ndarray:
    return 1 - common / (n + m - common)


def _root(parent: list[int], k: int) -> int:
    while parent[k] != k:
        parent[k] = parent[parent[k]]
        k = parent[k]
    return k


def join_region(sets: Sets, pivot: int, percent: int) -> list[tuple[int, int]]:
    """Links that connect all similar sets of a region; the pivot comes first, then sets that are
    outside the largest component and have another component in their triangle window."""
    region, count = Region(sets), len(sets.n)
    parent, links = list(range(count)), []
    window = 1 - percent / 100 + 1e-9
    done = np.zeros(count, dtype=bool)

    def visit(k: int) -> np.ndarray:
        common = region.overlap(sets.one(k))
        done[k] = True
        for other in np.flatnonzero(linked(common, sets.n, int(sets.n[k]), percent)).tolist():
            a, b = _root(parent, k), _root(parent, other)
            if a != b:
                parent[b] = a
                links.append((k, other))
        return common

    d = distance(visit(pivot), sets.n, int(sets.n[pivot]))
    roots = np.array([_root(parent, k) for k in range(count)])
    names, inverse, sizes = np.unique(roots, return_inverse=True, return_counts=True)
    for k in np.flatnonzero((inverse != np.argmax(sizes)) & ~done).tolist():
        mine = _root(parent, k)
        fits = 100 * np.minimum(sets.n, sets.n[k]) >= percent * np.maximum(sets.n, sets.n[k])
        if any(_root(parent, x) != mine for x in np.flatnonzero(fits & (np.abs(d - d[k]) <= window)).tolist()):
            visit(k)
    return links


def contracted(links: DataFrame) -> DataFrame:
    """Links that connect the same sets: among up to LINKS_AT_ONCE links of a partition, every set is tied to the
    least of its component."""
    limit = LINKS_AT_ONCE

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0
        for batch in batches:
            held.append(batch)
            count += batch.num_rows
            if count >= limit:
                yield contract(held)
                held, count = [], 0
        if count:
            yield contract(held)

    def contract(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        ends = [x.cast(pa.binary()) for c in ("a", "b") for x in pa.Table.from_batches(held).column(c).chunks]
        names = pa.chunked_array(ends, pa.binary()).combine_chunks().dictionary_encode()
        order = pc.array_sort_indices(names.dictionary).to_numpy()
        place = np.empty(len(order), dtype=np.int64)
        place[order] = np.arange(len(order))
        codes = place[names.indices.to_numpy()].reshape(2, -1)
        parent = list(range(len(order)))
        for a, b in zip(codes[0].tolist(), codes[1].tolist(), strict=True):
            a, b = _root(parent, a), _root(parent, b)
            if a != b:
                parent[max(a, b)] = min(a, b)
        roots = np.array([_root(parent, k) for k in range(len(order))], dtype=np.int64)
        below = np.flatnonzero(roots != np.arange(len(roots)))
        both = [names.dictionary.take(pa.array(order[x])) for x in (below, roots[below])]
        return pa.RecordBatch.from_arrays(both, names=["a", "b"])

    return links.select("a", "b").mapInArrow(run, LINKS)


def components(links: DataFrame) -> DataFrame:
    """(set, label) of every linked set, label the least set of its component.

    The links of a partition are contracted in its task. If what is left fits a task it is contracted there. More goes
    through star contraction first: every set is tied to the least of its neighbours, first among larger ones,
    then among smaller ones, until it fits or nothing changes. Only links are shuffled, and aggregates before joins.
    """
    edges, before = cut_lineage(contracted(links.where("a != b"))), None
    while True:
        state = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if state[0] <= LINKS_AT_ONCE:
            edges = cut_lineage(contracted(edges.coalesce(1)))
            break
        if state == before:
            break
        before = state
        both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        large = (
            both.join(least, "a")
            .where(F.col("b") > F.col("a"))
            .select(F.col("b").alias("a"), F.least("a", "m").alias("b"))
            .distinct()
        )
        large = cut_lineage(large)
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        edges = cut_lineage(
            small.where(F.col("b") != F.col("m"))
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionByName(least.select("a", F.col("m").alias("b")))
            .distinct()
        )
    roots = edges.select(F.col("b").alias("set"), F.col("b").alias("label")).distinct()
    return edges.select(F.col("a").alias("set"), F.col("b").alias("label")).unionByName(roots)


def _shingled(docs: DataFrame, id: str, text: str, width: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Blocks, and per document its set size and, where it may have a partner, its set's digest; once
    per block and set also the shared shingles among its first ones and the text."""
    blocks = B.to_blocks(docs, text)
    bits = B.bucket_bits(blocks)

    def report(block: int, rows: pa.Table) -> pa.Table:
        cut, _, counts = B.distinct_keys(Sets(rows.column(text), width).flat, bits)
        return B.key_rows(block, cut, counts, bits)

    def survive(block: int, rows: pa.Table, answers: pa.Table) -> pa.Table:
        sets = Sets(rows.column(text), width)
        _, inverse, _ = B.distinct_keys(sets.flat, bits)
        seen = B.seen_of(answers)[inverse]
        shared = np.diff(np.append(0, np.cumsum(seen > 1))[sets.edges])
        alive = (sets.n > 0) & (100 * shared >= percent * sets.n)
        digests, firsts, bodies, met = [None] * len(sets.n), [None] * len(sets.n), [None] * len(sets.n), set()
        texts = rows.column(text)
        for k in np.flatnonzero(alive).tolist():
            own = sets.one(k)
            digests[k] = hashlib.blake2b(own.tobytes(), digest_size=16).digest()
            if digests[k] not in met:
                met.add(digests[k])
                n = len(own)
                first = np.lexsort((own, seen[sets.edges[k] : sets.edges[k + 1]]))[: n - (percent * n + 99) // 100 + 1]
                first = first[seen[sets.edges[k] + first] > 1]
                firsts[k] = own[first].view(np.int64).tolist()
                bodies[k] = texts[k].as_py()
        return pa.table(
            {
                "block": pa.array(np.full(len(sets.n), block)),
                "place": pa.array(np.arange(len(sets.n), dtype=np.int32)),
                "id": rows.column(id).cast(pa.int64()),
                "n": pa.array(sets.n),
                "set": pa.array(digests, pa.binary()),
                "shared": pa.array(firsts, pa.list_(pa.int64())),
                "body": pa.array(bodies, pa.string()),
            }
        )

    seen = B.census(B.per_block(blocks, report, B.KEY_SCHEMA))
    return blocks, B.staged(B.with_answers(blocks, seen, survive, FOUND), "sets")


def _regions(found: DataFrame) -> DataFrame:
    """(pivot, set, n, body, region_n, region_sets) for all sets of all regions of two or more."""
    held = found.where(F.col("body").isNotNull())
    one = held.groupBy("set").agg(F.min("block").alias("block"))
    nodes = held.join(one, ["set", "block"]).select("set", "n", "shared", "body")
    keys = nodes.select("set", "n", F.explode("shared").alias("s"))
    pivots = keys.groupBy("s").agg(F.min("set").alias("pivot"), F.count("*").alias("c")).where("c > 1").drop("c")
    members = B.staged(keys.join(pivots, "s").select("pivot", "set", "n").distinct(), "members")
    sizes = members.groupBy("pivot").agg(F.sum("n").alias("region_n"), F.count("*").alias("region_sets"))
    sized = members.join(sizes, "pivot")
    return B.staged(sized.join(nodes.select("set", "body"), "set"), "regions")


LINKS = "a binary, b binary"


def _link_table(pairs: list[tuple[bytes, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(
        {"a": pa.array([a for a, _ in pairs], pa.binary()), "b": pa.array([b for _, b in pairs], pa.binary())}
    )


def _small_links(regions: DataFrame, width: int, percent: int) -> DataFrame:
    """Links of the regions that fit a task; rows come sorted by pivot."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        name = None
        for batch in batches:
            pivots = batch.column("pivot").to_pylist()
            first = 0
            while first < len(pivots):
                to = first
                while to < len(pivots) and pivots[to] == pivots[first]:
                    to += 1
                if held and pivots[first] != name:
                    yield solve(name, held)
                    held = []
                name = pivots[first]
                held.append(batch.slice(first, to - first))
                first = to
        if held:
            yield solve(name, held)
        held = None
        B.give_back()

    def solve(pivot: bytes, held: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(held)
        names = rows.column("set").to_pylist()
        links = join_region(Sets(rows.column("body"), width), names.index(pivot), percent)
        return _link_table([(names[a], names[b]) for a, b in links])

    rows = regions.select("pivot", "set", "body").repartition("pivot").sortWithinPartitions("pivot")
    return rows.mapInArrow(run, LINKS)


def _slice_links(rows: DataFrame, pivots: DataFrame, width: int, percent: int) -> DataFrame:
    """Distances of all sets of large regions to the given pivots of their region and group: (pivot, a, b, d, near)."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = {"pivot": [], "a": [], "b": [], "d": [], "near": []}
        if left.num_rows and right.num_rows:
            region, names = Region(Sets(left.column("body"), width)), left.column("set").to_pylist()
            others, theirs = Sets(right.column("text"), width), right.column("name").to_pylist()
            n = region.sets.n
            for k, name in enumerate(theirs):
                common = region.overlap(others.one(k))
                near = linked(common, n, int(others.n[k]), percent)
                d = distance(common, n, int(others.n[k]))
                first = right.column("first")[k].as_py()
                for x in range(len(names)) if first else np.flatnonzero(near).tolist():
                    out["pivot"].append(left.column("pivot")[0].as_py())
                    out["a"].append(names[x])
                    out["b"].append(name)
                    out["d"].append(float(d[x]))
                    out["near"].append(bool(near[x]))
        kinds = {"pivot": pa.binary(), "a": pa.binary(), "b": pa.binary(), "d": pa.float64(), "near": pa.bool_()}
        return pa.table({c: pa.array(v, kinds[c]) for c, v in out.items()})

    copies = pivots.select(
        F.col("pivot").alias("of_pivot"),
        F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("of_slice"),
        F.col("set").alias("name"),
        F.col("body").alias("text"),
        F.col("group").alias("of_group"),
        "first",
    )
    return (
        rows.select("pivot", "slice", "group", "set", "body")
        .groupBy("pivot", "slice", "group")
        .cogroup(copies.groupBy("of_pivot", "of_slice", "of_group"))
        .applyInArrow(run, "pivot binary, a binary, b binary, d double, near boolean")
    )


def _large_links(regions: DataFrame, known: DataFrame, width: int, percent: int) -> DataFrame:
    """Links of the regions that do not fit a task."""
    window = 1 - percent / 100 + 1e-9
    slices = F.ceil(F.greatest(F.col("region_n") / REGION_SHINGLES, F.col("region_sets") / REGION_SETS)).cast("int")
    rows = B.staged(
        regions.withColumn("slices", slices).withColumn("slice", F.pmod(F.xxhash64("set"), F.col("slices")).cast("int")),
        "large",
    )
    first = rows.where("set = pivot").withColumns({"first": F.lit(True), "group": F.lit(0)})
    measured = B.staged(_slice_links(rows.withColumn("group", F.lit(0)), first, width, percent), "distances")
    links = known.unionByName(measured.where("near").select("a", "b"))
    places = measured.select("pivot", F.col("a").alias("set"), "d")
    done = cut_lineage(first.select("pivot", "set"))
    rows = rows.join(places, ["pivot", "set"])
    groups = 1
    while True:
        links = cut_lineage(contracted(links))
        labels = components(links)
        labelled = cut_lineage(
            places.join(labels, "set", "left").select("pivot", "set", "d", F.coalesce("label", "set").alias("label"))
        )
        counts = labelled.groupBy("pivot", "label").agg(F.count("*").alias("c"))
        main = counts.groupBy("pivot").agg(F.max(F.struct("c", "label")).alias("m"))
        strays = (
            labelled.join(main.select("pivot", F.col("m.label").alias("main")), "pivot")
            .where("label != main")
            .join(done, ["pivot", "set"], "left_anti")
        )
        # Pivots of a group have like distances, so that their windows together are narrow.
        turn, place = Window.partitionBy("pivot").orderBy("set"), Window.partitionBy("pivot").orderBy("d", "set")
        some = strays.withColumn("turn", F.row_number().over(turn)).where(F.col("turn") <= PIVOTS * groups)
        chosen = cut_lineage(some.select("pivot", "set", F.floor((F.row_number().over(place) - 1) / PIVOTS).cast("int").alias("group")))
        if chosen.isEmpty():
            return links
        done = cut_lineage(done.coalesce(parallelism(done.sparkSession)).unionByName(chosen.select("pivot", "set")))
        new = rows.join(chosen, ["pivot", "set"]).withColumn("first", F.lit(False))
        reach = new.groupBy("pivot", "group").agg((F.min("d") - window).alias("lo"), (F.max("d") + window).alias("hi"))
        inside = rows.join(reach, "pivot").where("d BETWEEN lo AND hi")
        found = _slice_links(inside, new, width, percent).where("near").select("a", "b")
        links = links.coalesce(parallelism(links.sparkSession)).unionByName(found)
        groups = min(4 * groups, MOST_GROUPS)


def _grouped(found: DataFrame, width: int, percent: int) -> DataFrame:
    """Per document: block, place, id, n, and the label its group goes by (null: alone)."""
    regions = _regions(found)
    fits = (F.col("region_n") <= REGION_SHINGLES) & (F.col("region_sets") <= REGION_SETS)
    links = B.staged(_small_links(regions.where(fits), width, percent), "links")
    large = regions.where(~fits)
    if not large.isEmpty():
        links = _large_links(large, links, width, percent)
    labels = components(links)
    light = found.select("block", "place", "id", "n", "set")
    classes = light.where("set IS NOT NULL").groupBy("set").agg(
        F.min("id").alias("least"),
        F.min(F.struct(F.col("id").isNull().alias("none"), "id", "block", "place")).alias("first"),
    )
    named = classes.join(labels, "set", "left").withColumn("label", F.coalesce("label", "set"))
    groups = named.groupBy("label").agg(F.min("least").alias("least"), F.min("first").alias("first"))
    of_set = named.select("set", "label").join(groups, "label").drop("label")
    grouped = light.where("set IS NOT NULL").join(of_set, "set").select(
        "block",
        "place",
        "id",
        "n",
        F.coalesce("least", "id").alias("component"),
        ((F.col("first.block") == F.col("block")) & (F.col("first.place") == F.col("place"))).alias("first"),
    )
    alone = light.where("set IS NULL").select("block", "place", "id", "n", F.col("id").alias("component"), F.lit(True).alias("first"))
    return grouped.unionByName(alone)


def jaccard_groups(
    docs: DataFrame, id: str = "doc_id", text: str = "text", width: int = WORDS, percent: int = PERCENT
) -> DataFrame:
    """One row per document: the id, `n_shingles` and `component_id`, the smallest id of its group.

    Null and empty texts have no shingles and link with nothing, not even each other. Equal sets
    link. A null id counts as larger than any other when a group is named, so a group of null ids
    only, or a document alone with a null id, is named null. Rows with equal ids are separate rows.
    """
    _, found = _shingled(docs.select(id, text), id, text, width, percent)
    return _grouped(found, width, percent).select(
        F.col("id").alias(id), F.col("n").alias("n_shingles"), F.col("component").alias("component_id")
    )


def near_dedup(docs: DataFrame, id: str = "doc_id", text: str = "text", width: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """All columns of docs for one row of each group: the smallest id, of equal ids the first row."""
    blocks, found = _shingled(docs, id, text, width, percent)

    def keep(block: int, rows: pa.Table, answers: pa.Table) -> pa.Table:
        return rows.take(pa.array(np.sort(answers.column("place").to_numpy())))

    kept = _grouped(found, width, percent).where("first").select("block", "place")
    return B.with_answers(blocks, kept, keep, docs.schema)
