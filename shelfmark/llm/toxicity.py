"""Toxicity by nearest labelled examples: exact TF-IDF cosine over a block-max inverted index.

Terms are words, lower-cased in A-Z. Every term of the examples is in the index. A term's weight in a text is
(1 + ln tf) x idf x relevance: idf comes from the document frequencies over all documents, relevance says how sure the
examples are that the term goes with a label, either one: RELEVANCE_BASE plus as much of the absolute log odds ratio as is
left after twice its standard error. Terms that tell little keep the base, so texts still meet by what they are about.

Examples are a bounded sample: at most MAX_EXAMPLES rows of each label and MAX_BYTES of their texts, the first in the
order of a hash. The index of them is thus bounded too and goes to every task.

The index holds examples in blocks of similar ones. The list of a term that one in DENSE examples holds is a dense row;
the share of these terms in all cosines is one matrix product for a batch of texts. Lists of fewer than SHORT postings are
added to these shares whole. Any other list is cut by blocks, and
each cut knows its largest weight. For a text the best share in a block and the largest weights of its cuts bound the cosine
that any example of the block can reach; blocks are visited by falling bound until the bound is below the k-th best
cosine, so the nearest examples are exact. Texts with equal vectors are looked up once in a slice.

The score is the weighted share of toxic ones among the nearest examples: each votes with its squared cosine over its
distance, times how many labelled rows of its label it stands for, beside a prior of the labelled rows' toxic share. Texts
without a term of the index get that share.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from shelfmark.llm import blocks as B, words as W

#: Bounds of the labelled sample, for each label: rows, and bytes of their texts (the first row always counts).
MAX_EXAMPLES = 4096
MAX_BYTES = 1 << 24
NEIGHBOURS = 15
EVIDENCE = 3
BLOCK = 256
# Blocks looked at first; a second step looks at all others whose bound is not below the k-th best cosine then.
FIRST_BLOCKS = 3
# Lists of at least one in so many examples are dense: at most so many numbers for each posting of the index.
DENSE = 16
# Lists of fewer postings are added whole: cut by blocks they would be hardly shorter, and their weights would blur the bounds.
SHORT = 256
# Texts whose shares of dense lists are taken in one product.
BATCH = 64
# Examples whose postings are weighed at once while the index is built.
PART = 256
RELEVANCE_BASE = 0.3
# Votes of the prior, and the distance added to every distance.
PRIOR_VOTES = 0.05
LEAST_DISTANCE = 0.001
SLICE_BYTES = 1 << 19
SIEVE = 1 << 22

#: Bytes between words: all of ASCII but letters and digits. Other bytes belong to letters.
GAPS = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])


def terms(texts: pa.Array | pa.ChunkedArray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For slices of the texts: number of the first text, text of each word, and its hash."""
    buf, offsets = W.buffers(texts)
    first = 0
    while first < len(offsets) - 1:
        to = max(first + 1, int(np.searchsorted(offsets, offsets[first] + SLICE_BYTES, "right")) - 1)
        part = W.LOWER[buf[offsets[first] : offsets[to]]]
        starts, ends, firsts = W.spans(part, offsets[first : to + 1] - offsets[first], GAPS)
        yield first, np.repeat(np.arange(to - first), np.diff(firsts)), W.word_hashes(part, starts, ends)
        first = to


@dataclass
class Terms:
    """Sorted hashes of the terms in use."""

    names: np.ndarray

    def __post_init__(self) -> None:
        self.sieve = np.zeros(SIEVE, dtype=bool)
        self.sieve[(self.names & np.uint64(SIEVE - 1)).astype(np.int64)] = True

    def counts(self, owner: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text, place of the term and how often it occurs there, by text and place; other words are left out."""
        met = np.flatnonzero(self.sieve[hashes & np.uint64(SIEVE - 1)])
        if len(met) == 0:
            none = np.zeros(0, dtype=np.int64)
            return none, none, none
        at = np.minimum(np.searchsorted(self.names, hashes[met]), len(self.names) - 1)
        right = self.names[at] == hashes[met]
        keys, counts = np.unique(owner[met[right]] * len(self.names) + at[right], return_counts=True)
        return keys // len(self.names), keys % len(self.names), counts


def unit(owner: np.ndarray, counts: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Entries of unit vectors; an owner's entries lie together, and `weights` are those of their terms."""
    values = (1 + np.log(counts)) * weights
    first = np.flatnonzero(np.diff(owner, prepend=-1))
    norms = np.sqrt(np.add.reduceat(values * values, first)) if len(first) else np.zeros(0)
    return values / np.repeat(norms, np.diff(np.append(first, len(owner))))


def relevance(toxic: np.ndarray, other: np.ndarray, n_toxic: int, n_other: int) -> np.ndarray:
    """Weight of terms by the number of toxic and of other examples that hold them."""
    cells = [toxic + 0.5, n_toxic - toxic + 0.5, other + 0.5, n_other - other + 0.5]
    ratio = np.abs(np.log(cells[0] * cells[3] / (cells[1] * cells[2])))
    return RELEVANCE_BASE + np.maximum(0, ratio - 2 * np.sqrt(sum(1 / c for c in cells)))


@dataclass
class Index:
    """Terms and their weights; examples in blocks; posting lists by term, block and example."""

    terms: Terms
    weights: np.ndarray
    ids: np.ndarray
    toxic: np.ndarray
    votes: np.ndarray  # how many labelled rows an example of label 0, of label 1 stands for
    prior: float
    cuts: np.ndarray  # first cut of each term's list, one more at the end
    block: np.ndarray  # of each cut: its block (a list of one cut: that of its first example),
    largest: np.ndarray  # its largest entry,
    first: np.ndarray  # and its first posting, one more at the end
    example: np.ndarray  # of each posting
    entry: np.ndarray

    def __post_init__(self) -> None:
        self._rows = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_rows": None}  # each worker lays its dense rows down itself

    def rows(self) -> tuple[np.ndarray, np.ndarray]:
        """The number of each term's dense row, or -1, and the rows."""
        if self._rows is None:
            spans = self.first[self.cuts]
            often = np.flatnonzero(np.diff(spans) * DENSE >= max(1, len(self.ids)))
            row = np.full(len(self.weights), -1, dtype=np.int64)
            row[often] = np.arange(len(often))
            dense = np.zeros((len(often), len(self.ids)))
            for values, start, end in zip(dense, spans[often].tolist(), spans[often + 1].tolist(), strict=True):
                values[self.example[start:end]] = self.entry[start:end]
            self._rows = row, dense
        return self._rows

    def forget(self) -> None:
        """Give up the dense rows, which idle workers would hold on to."""
        self._rows = None

    def shares(self, owner: np.ndarray, at: np.ndarray, q: np.ndarray, n: int) -> np.ndarray:
        """What dense lists add to the cosines of n texts with all examples; owners are numbered from 0."""
        row, dense = self.rows()
        often = np.flatnonzero(row[at] >= 0)
        texts = np.zeros((n, len(dense)))
        texts[owner[often], row[at[often]]] = q[often]
        return texts @ dense

    def nearest(self, at: np.ndarray, q: np.ndarray, share: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and cosines of the k nearest examples, ties to the smaller place; cosine 0 is none.

        `share` is the text's row of `shares`.
        """
        places, cosines = np.zeros(0, dtype=np.int64), np.zeros(0)
        if len(share) == 0:
            return places, cosines
        rare = self.rows()[0][at] < 0
        at, q = at[rare], q[rare]
        spans = self.first[self.cuts[at]]
        size = self.first[self.cuts[at + 1]] - spans
        short = size < SHORT
        postings = W.rows_of(spans[short], size[short])
        weight = np.repeat(q[short], size[short])
        share = share + np.bincount(self.example[postings], self.entry[postings] * weight, len(share))
        at, q = at[~short], q[~short]
        n = self.cuts[at + 1] - self.cuts[at]
        cuts, weight = W.rows_of(self.cuts[at], n), np.repeat(q, n)
        block = self.block[cuts]
        bounds = np.maximum.reduceat(share, np.arange(0, len(share), BLOCK))
        bounds = bounds + np.bincount(block, weight * self.largest[cuts], minlength=len(bounds))
        order = np.argsort(-bounds, kind="stable")
        for now in (order[:FIRST_BLOCKS], order[FIRST_BLOCKS:]):
            least = cosines[-1] - 1e-9 if len(cosines) == k else 0.0
            now = now[(bounds[now] > 0) & (bounds[now] >= least)]
            if len(now) == 0:
                break
            wanted = np.zeros(len(bounds), dtype=bool)
            wanted[now] = True
            mine = np.flatnonzero(wanted[block])
            size = self.first[cuts[mine] + 1] - self.first[cuts[mine]]
            postings = W.rows_of(self.first[cuts[mine]], size)
            sums = np.bincount(self.example[postings], self.entry[postings] * np.repeat(weight[mine], size), len(share))
            here = (now[:, None] * BLOCK + np.arange(BLOCK)).ravel()
            here = here[here < len(share)]
            sums = sums[here] + share[here]
            better = sums > least
            places = np.append(places, here[better])
            cosines = np.append(cosines, np.minimum(1, np.round(sums[better], 12)))
            best = np.lexsort((places, -cosines))[:k]
            best = best[cosines[best] > 0]
            places, cosines = places[best], cosines[best]
        return places, cosines

    def score(self, places: np.ndarray, cosines: np.ndarray) -> float:
        votes = cosines * cosines / (1 - cosines + LEAST_DISTANCE) * self.votes[self.toxic[places]]
        weight = PRIOR_VOTES * self.votes.mean()
        return float((weight * self.prior + votes[self.toxic[places] == 1].sum()) / (weight + votes.sum()))


def _joined(lists: list[np.ndarray]) -> np.ndarray:
    return np.concatenate([np.zeros(0, dtype=np.int32), *lists], dtype=np.int32, casting="same_kind")


def _parts(rows: list) -> Iterator[tuple[int, int, list]]:
    """First place, end and rows of parts, so that what is reckoned for all postings is held for a part at a time."""
    for start in range(0, len(rows), PART):
        part = rows[start : start + PART]
        yield start, start + len(part), part


def build_index(
    found: Terms, df: np.ndarray, n_docs: int, rows: list[tuple[int, int, np.ndarray, np.ndarray]], labelled: tuple[int, int]
) -> Index:
    """`rows`: (id, label, rising places of terms, their counts) of all examples; `df`: documents of `n_docs` that hold
    each term; `labelled`: rows of label 0 and 1 that the examples stand for."""
    label = np.array([r[1] for r in rows], dtype=np.int64)
    sampled = np.bincount(label, minlength=2)
    size = np.array([len(r[2]) for r in rows], dtype=np.int64)
    held = np.zeros((2, len(df)), dtype=np.int64)
    for _, _, part in _parts(rows):
        for y in (0, 1):
            held[y] += np.bincount(_joined([r[2] for r in part if r[1] == y]), minlength=len(df))
    weights = (np.log((1 + n_docs) / (1 + df)) + 1) * relevance(held[1], held[0], int(sampled[1]), int(sampled[0]))

    def entries(part: list[tuple[int, int, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        owner, term = np.repeat(np.arange(len(part)), [len(r[2]) for r in part]), _joined([r[2] for r in part])
        return owner, term, unit(owner, _joined([r[3] for r in part]), weights[term])

    # Similar examples lie together: those of a label with the same heaviest term.
    heaviest = np.zeros(len(rows), dtype=np.int64)
    for start, _, part in _parts(rows):
        owner, term, entry = entries(part)
        by = np.lexsort((entry, owner))
        heaviest[start + owner[by]] = term[by]
    ids = np.array([r[0] for r in rows], dtype=np.int64)
    order = np.lexsort((np.arange(len(rows)), ids, heaviest, label))
    order = order[size[order] > 0]
    # Postings in the order of examples, then, stably, by term; large arrays are made once and given up early.
    rows, size = [rows[k] for k in order.tolist()], size[order]
    borders = np.append(0, np.cumsum(size))
    term, entry = _joined([r[2] for r in rows]), np.empty(borders[-1])
    for start, end, part in _parts(rows):
        entry[borders[start] : borders[end]] = entries(part)[2]
    by = np.argsort(term, kind="stable")
    term, entry = term[by], entry[by]
    example = np.repeat(np.arange(len(rows), dtype=np.int32), size)[by]
    del by
    block = example // BLOCK
    # Short and dense lists are never looked up by block: each is one cut.
    listed = np.bincount(term, minlength=len(df))
    by_block = (listed >= SHORT) & (listed * DENSE < max(1, len(rows)))
    new = np.ones(len(term), dtype=bool)
    new[1:] = (term[1:] != term[:-1]) | ((block[1:] != block[:-1]) & by_block[term[1:]])
    first = np.flatnonzero(new)
    total = max(1, sum(labelled))
    return Index(
        found,
        weights,
        ids[order],
        label[order],
        np.array([labelled[y] / max(1, int(sampled[y])) for y in (0, 1)]),
        labelled[1] / total,
        np.searchsorted(term[first], np.arange(len(df) + 1)),
        block[first],
        np.maximum.reduceat(entry, first) if len(first) else entry,
        np.append(first, len(term)).astype(np.int32),
        example,
        entry,
    )


def _lists(column: pa.ChunkedArray, kind: type) -> list[np.ndarray]:
    """The numbers in each cell, as views of the column's buffers."""
    return [np.frombuffer(cell.as_buffer(), dtype=kind) for chunk in column.chunks for cell in chunk]


def document_frequencies(docs: DataFrame, found: Terms, text: str = "text") -> np.ndarray:
    """How many documents hold each of the terms: a task adds up its own, then one sum for each term is taken."""
    shared = docs.sparkSession.sparkContext.broadcast(found)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = shared.value
        total = np.zeros(len(found.names), dtype=np.int64)
        for batch in batches:
            for _, owner, hashes in terms(batch.column("text")):
                total += np.bincount(found.counts(owner, hashes)[1], minlength=len(total))
        at = np.flatnonzero(total)
        for k in range(0, len(at), 1 << 16):
            part = at[k : k + (1 << 16)]
            yield pa.RecordBatch.from_pydict({"term": pa.array(part.astype(np.int32)), "n": pa.array(total[part])})

    sums = docs.select(F.col(text).alias("text")).mapInArrow(count, "term int, n long").groupBy("term").agg(F.sum("n").alias("n"))
    rows = sums.toArrow()  # as many rows as the index has terms
    df = np.zeros(len(found.names), dtype=np.int64)
    df[rows.column("term").to_numpy()] = rows.column("n").to_numpy()
    return df


def fit(docs: DataFrame, labels: DataFrame, learn: Column, id: str = "doc_id", text: str = "text", label: str = "toxic") -> Index:
    """Index of labelled documents where `learn` holds (an expression over the labels).

    Labels other than 0 and 1 and rows with a null id are left out; of several labels of an id the largest
    counts. Of several documents of an id each is an example of its own, equal ones are one. The bounds hold for rows:
    an id with very many documents does not lift them.
    """
    B.ready(docs.sparkSession)
    known = (
        labels.where(learn & F.col(label).isin(0, 1) & F.col(id).isNotNull())
        .groupBy(F.col(id).cast("long").alias("id"))
        .agg(F.max(label).cast("int").alias("label"))
    )
    labelled = known.agg(F.count_if(F.col("label") == 0), F.count_if(F.col("label") == 1)).first()
    picked = None
    for y in (0, 1):  # at most MAX_EXAMPLES ids each
        some = known.where(F.col("label") == y).orderBy(F.xxhash64("id"), "id").limit(MAX_EXAMPLES)
        picked = some if picked is None else picked.unionByName(some)
    picked = B.staged(picked, "examples")
    texts = docs.select(
        F.col(id).cast("long").alias("id"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    ).withColumn("h", F.xxhash64("id", "text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(b"", b"")] * batch.num_rows
            for first, owner, hashes in terms(batch.column("text")):
                border = np.searchsorted(owner, np.arange(int(owner[-1]) + 2)) if len(owner) else np.zeros(1, dtype=np.int64)
                for k in range(len(border) - 1):
                    names, n = np.unique(hashes[border[k] : border[k + 1]], return_counts=True)
                    found[first + k] = names.tobytes(), n.astype(np.int32).tobytes()
            yield pa.RecordBatch.from_pydict(
                {c: batch.column(c) for c in ("id", "label", "h")}
                | {
                    "bytes": pa.array(B.text_bytes(batch.column("text"))),
                    "names": pa.array([a for a, _ in found], pa.binary()),
                    "counts": pa.array([b for _, b in found], pa.binary()),
                }
            )

    counted = texts.join(F.broadcast(picked), "id").select("id", "label", "h", "text")
    schema = "id long, label int, h long, bytes long, names binary, counts binary"
    counted = B.staged(counted.mapInArrow(count, schema).dropDuplicates(["id", "h"]), "terms")
    chosen = []
    for y in (0, 1):
        some = counted.where(F.col("label") == y).select("id", "h", "bytes").orderBy("h", "id").limit(MAX_EXAMPLES).collect()
        upto = np.cumsum([r["bytes"] for r in some])
        chosen += [(r["id"], r["h"]) for k, r in enumerate(some) if k == 0 or upto[k] <= MAX_BYTES]
    wanted = counted.sparkSession.createDataFrame(chosen, "id long, h long")
    examples = counted.join(F.broadcast(wanted), ["id", "h"], "left_semi").orderBy("id", "h")
    examples = examples.select("id", "label", "names", "counts").toArrow()
    names, all_names = _lists(examples.column("names"), np.uint64), np.zeros(0, dtype=np.uint64)
    for start in range(0, len(names), PART):  # a part's terms at a time: most are met again and again
        all_names = np.union1d(all_names, np.concatenate(names[start : start + PART]))
    found = Terms(all_names)
    places = [np.searchsorted(found.names, some).astype(np.int32) for some in names]
    ids, label, counts = (examples.column(c) for c in ("id", "label", "counts"))
    rows = list(zip(ids.to_pylist(), label.to_pylist(), places, _lists(counts, np.int32), strict=True))
    del examples, names
    df = document_frequencies(docs, found, text)
    return build_index(found, df, docs.count(), rows, (labelled[0], labelled[1]))


RESULTS = "score double, evidence array<struct<doc_id: long, toxic: int, similarity: double>>"


def toxicity(docs: DataFrame, index: Index, text: str = "text") -> DataFrame:
    """Columns of docs with `score` (0 to 1) and `evidence`, the nearest examples.

    Null and empty texts have no term: they get the share of toxic rows among the labelled, and no
    evidence; without labels the score is 0. Whole texts count, however long. Scores of equal texts differ in the last
    digits at most. Examples at
    the same distance count in the order of their places in the index. Columns of docs that bear a result's name are
    replaced.
    """
    spark = B.ready(docs.sparkSession)
    shared = spark.sparkContext.broadcast(index)
    schema = B.result_schema(docs, RESULTS)
    kept = [f.name for f in schema][:-2]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for batch in batches:
            scores, evidence = np.full(batch.num_rows, index.prior), [[] for _ in range(batch.num_rows)]
            for first, owner, hashes in terms(batch.column(text)):
                owner, at, counts = index.terms.counts(owner, hashes)
                vector = unit(owner, counts, index.weights[at])
                border = np.flatnonzero(np.diff(owner, prepend=-1, append=batch.num_rows))
                same: dict[bytes, list[int]] = {}
                for t, (a, b) in enumerate(zip(border[:-1].tolist(), border[1:].tolist(), strict=True)):
                    same.setdefault(at[a:b].tobytes() + counts[a:b].tobytes(), []).append(t)
                alike = list(same.values())
                for start in range(0, len(alike), BATCH):
                    some = alike[start : start + BATCH]
                    firsts = np.array([ts[0] for ts in some])
                    sizes = border[firsts + 1] - border[firsts]
                    spots = W.rows_of(border[firsts], sizes)
                    shares = index.shares(np.repeat(np.arange(len(some)), sizes), at[spots], vector[spots], len(some))
                    for ts, share in zip(some, shares, strict=True):
                        a, b = border[ts[0]], border[ts[0] + 1]
                        places, cosines = index.nearest(at[a:b], vector[a:b], share, NEIGHBOURS)
                        score = index.score(places, cosines)
                        best = [
                            {"doc_id": int(index.ids[p]), "toxic": int(index.toxic[p]), "similarity": float(c)}
                            for p, c in zip(places[:EVIDENCE], cosines[:EVIDENCE], strict=True)
                        ]
                        for t in ts:
                            scores[first + owner[border[t]]], evidence[first + owner[border[t]]] = score, best
            kind = pa.list_(pa.struct([("doc_id", pa.int64()), ("toxic", pa.int32()), ("similarity", pa.float64())]))
            columns = {c: batch.column(c) for c in kept} | {"score": pa.array(scores), "evidence": pa.array(evidence, kind)}
            yield pa.RecordBatch.from_pydict(columns)
        shared.value.forget()

    return docs.mapInArrow(run, schema)


def held_out(id: str = "doc_id") -> Column:
    """Rows that no score may learn from: crc32 of the id as text is divisible by 5."""
    return F.coalesce(F.pmod(F.crc32(F.col(id).cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))
