"""LM scoring: masked pseudo-likelihood of documents under a bidirectional window network.

Every word is predicted from the words before and after it (WINDOW on either side): a table of words and a matrix
per distance give each neighbour's share of the hidden layer, and the output is a softmax in two steps, first over
classes of words, narrow for frequent ones, then over the words of a class. A document's score is the sum of the
log-probabilities of its words, each given both its sides.

All words of all documents are counted exactly. The network knows the most frequent ones and buckets of the
others by hash; both grow with the root of the number of distinct words, and so do classes and their width. A word
of a bucket has the bucket's probability times its share of the bucket's count, where words never met hold as much
as those met once, and one more. The counts of a block's words come back to the block, so no task and not the
driver holds the table of all words.

Training runs over all documents once, in shards whose number grows with the texts: in every round each task goes
through its blocks of the shard in numpy, starting from the common weights, and the weights are then averaged by
the number of words behind them, piece by piece and in two steps, so that no task gathers more than a few of them
at a time. Only the weights and the network's words pass the driver.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfmark.llm import blocks as B, words as W
from shelfmark.session import fresh_dir

# At least so many words, and for each root of the number of distinct words; words for a bucket, buckets at least.
WORDS = 960
WORDS_A_ROOT = 8
WORDS_A_BUCKET = 15
BUCKETS = 64
CLASS = 16  # words of a class at least
WINDOW = 2
DISTANCES = (-2, -1, 1, 2)
HIDDEN = 16
ROUNDS = 4  # at least
BATCH = 1 << 15
RATE = 0.2
STEP = 0.5  # of a word's table, against the rate
PIECE = 1 << 13  # numbers of a piece of the weights
SALTS = 16

KEYS = "block long, bucket int, keys binary, counts binary"
TOKENS = "shard int, block long, n_tokens long, tokens binary, rows binary"


@dataclass
class Vocabulary:
    """Hashes of the frequent words in order, the token of each, all tokens' frequencies, words met once by bucket."""

    hashes: np.ndarray
    tokens: np.ndarray
    counts: np.ndarray
    once: np.ndarray

    @property
    def size(self) -> int:
        return len(self.counts)

    def of(self, h: np.ndarray) -> np.ndarray:
        """Token of each word; words outside the vocabulary go to a bucket by their hash."""
        first = len(self.hashes)
        out = (first + (h % np.uint64(len(self.once))).astype(np.int64)).astype(kind_of(self.size))
        if first:
            at = np.minimum(np.searchsorted(self.hashes, h), first - 1)
            known = self.hashes[at] == h
            out[known] = self.tokens[at[known]]
        return out

    def inside(self, tokens: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Log-probability of words, met `counts` times, within their tokens; of all words never met together at 0."""
        out, first = np.zeros(len(tokens)), len(self.hashes)
        rare = np.flatnonzero(tokens >= first)
        token = tokens[rare].astype(np.int64)
        unseen = self.once[token - first] + 1
        out[rare] = np.log(np.where(counts[rare] > 0, counts[rare], unseen) / (self.counts[token] + unseen))
        return out


def kind_of(size: int) -> str:
    """Type of tokens, of which there are `size` and one for no word."""
    return "<u2" if size < 1 << 16 else "<u4"


def hashes_of(texts: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    buf, offsets = W.buffers(texts)
    buf = W.LOWER[buf]
    starts, ends, firsts = W.spans(buf, offsets)
    return W.word_hashes(buf, starts, ends), firsts


def count_words(blocks: DataFrame, text: str) -> DataFrame:
    """Exact counts of all words by hash, staged: per block and bucket for the block's distinct words in order of
    their hashes, and per bucket, without a block, for all of them."""
    bits = B.bucket_bits(blocks)

    def report(block: int, table: pa.Table) -> pa.Table:
        h, _ = hashes_of(table.column(text))
        keys, counts = np.unique(h, return_counts=True)
        edges = np.searchsorted(keys >> np.uint64(64 - bits), np.arange((1 << bits) + 1).astype(np.uint64))
        full = np.flatnonzero(np.diff(edges))
        return rows_of(np.full(len(full), block), full, keys, counts, edges[full], edges[full + 1])

    def total(table: pa.Table) -> pa.Table:
        flat = np.frombuffer(b"".join(table.column("keys").to_pylist()), dtype="<u8")
        counts = np.frombuffer(b"".join(table.column("counts").to_pylist()), dtype="<i8")
        ends = np.cumsum([len(x) // 8 for x in table.column("keys").to_pylist()])
        keys, place = np.unique(flat, return_inverse=True)
        sums = np.zeros(len(keys), dtype=np.int64)
        np.add.at(sums, place, counts)
        starts, bucket = np.append(0, ends[:-1]), table.column("bucket").to_numpy()
        answers = rows_of(table.column("block").to_numpy(), bucket, None, sums[place], starts, ends)
        return pa.concat_tables([answers, rows_of(None, bucket[:1], keys, sums, [0], [len(keys)])])

    def rows_of(block, bucket, keys, counts, starts, ends) -> pa.Table:
        cut = lambda x, kind: [x[a:b].astype(kind).tobytes() for a, b in zip(starts, ends, strict=True)]
        return pa.table(
            {
                "block": pa.array([None] * len(bucket) if block is None else block, pa.int64()),
                "bucket": pa.array(bucket, pa.int32()),
                "keys": pa.array([None] * len(bucket) if keys is None else cut(keys, "<u8"), pa.binary()),
                "counts": pa.array(cut(counts, "<i8"), pa.binary()),
            }
        )

    return B.staged(B.per_block(blocks, report, KEYS).groupBy("bucket").applyInArrow(total, KEYS), "words")


def learn_vocabulary(blocks: DataFrame, text: str) -> Vocabulary:
    """The most frequent words by exact counts, and what falls into the buckets of the others."""
    return vocabulary_of(count_words(blocks, text))


def vocabulary_of(counted: DataFrame) -> Vocabulary:
    every = counted.where("block IS NULL").select("keys", "counts")
    distinct = (every.agg(F.sum(F.length("keys"))).first()[0] or 0) // 8
    n_words = max(WORDS, WORDS_A_ROOT * math.isqrt(distinct))
    n_buckets = max(BUCKETS, n_words // WORDS_A_BUCKET)

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for batch in batches:
            for keys, counts in zip(batch.column("keys"), batch.column("counts"), strict=True):
                yield np.frombuffer(keys.as_buffer(), dtype="<u8"), np.frombuffer(counts.as_buffer(), dtype="<i8")

    def most(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, counts in words(batches):
            order = np.lexsort((keys.view(np.int64), -counts))[:n_words]
            yield pa.RecordBatch.from_pydict({"word": pa.array(keys[order].view(np.int64)), "c": pa.array(counts[order])})

    best = every.mapInArrow(most, "word long, c long").orderBy(F.desc("c"), "word").limit(n_words).collect()
    hashes = np.array([r["word"] for r in best], dtype=np.int64).view(np.uint64)
    order = np.argsort(hashes)
    counts = np.zeros(len(best) + n_buckets, dtype=np.int64)
    counts[: len(best)] = [r["c"] for r in best]
    found = Vocabulary(hashes[order], order.astype(kind_of(len(counts))), counts, np.zeros(n_buckets, dtype=np.int64))

    def rest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, once = np.zeros(n_buckets, dtype=np.int64), np.zeros(n_buckets, dtype=np.int64)
        for keys, counts in words(batches):
            at = found.of(keys).astype(np.int64) - len(found.hashes)
            np.add.at(sums, at[at >= 0], counts[at >= 0])
            np.add.at(once, at[(at >= 0) & (counts == 1)], 1)
        met = np.flatnonzero(sums)
        yield pa.RecordBatch.from_pydict({"k": pa.array(met), "c": pa.array(sums[met]), "once": pa.array(once[met])})

    sums = every.mapInArrow(rest, "k long, c long, once long").groupBy("k").agg(F.sum("c").alias("c"), F.sum("once").alias("once"))
    for r in sums.collect():  # n_buckets rows at most
        found.counts[len(best) + r["k"]], found.once[r["k"]] = r["c"], r["once"]
    return found


class Network:
    """Weights as one array of 32-bit numbers, and views into it. Biases are the last column of output weights.

    Tokens are ranked by frequency and classes are stretches of ranks, wider the rarer their tokens are, so that
    a token of probability p costs about 1 / sqrt(p) outputs within its class.
    """

    def __init__(self, counts: np.ndarray, weights: np.ndarray | None = None) -> None:
        self.size = len(counts)
        order = np.argsort(-counts, kind="stable")
        self.rank = np.empty(self.size, dtype=np.int64)
        self.rank[order] = np.arange(self.size)
        self.shares = (counts[order] + 1.0) / (counts.sum() + self.size)
        widths, edges = np.maximum(CLASS, (1 / np.sqrt(self.shares)).astype(np.int64)), [0]
        while edges[-1] < self.size:
            edges.append(min(self.size, edges[-1] + int(widths[edges[-1]])))
        self.edges = np.array(edges)
        self.classes = len(edges) - 1
        shapes = {
            "words": (self.size + 1, HIDDEN),
            "places": (2 * WINDOW, HIDDEN, HIDDEN),
            "hidden": (HIDDEN,),
            "of_class": (self.classes, HIDDEN + 1),
            "of_word": (self.size, HIDDEN + 1),
        }
        total = sum(int(np.prod(s)) for s in shapes.values())
        self.weights = np.zeros(total, dtype=np.float32) if weights is None else weights
        at = 0
        for name, shape in shapes.items():
            n = int(np.prod(shape))
            setattr(self, name, self.weights[at : at + n].reshape(shape))
            at += n

    @classmethod
    def fresh(cls, counts: np.ndarray) -> Network:
        """Small random tables; biases that predict every word by its frequency."""
        net = cls(counts)
        random = np.random.default_rng(7)
        net.words[:] = random.normal(0, 0.3, net.words.shape)
        net.places[:] = random.normal(0, 0.3, net.places.shape)
        net.of_class[:, :HIDDEN] = random.normal(0, 0.1, (net.classes, HIDDEN))
        net.of_word[:, :HIDDEN] = random.normal(0, 0.1, (net.size, HIDDEN))
        if net.size:
            of_class = np.add.reduceat(net.shares, net.edges[:-1])
            net.of_class[:, HIDDEN] = np.log(of_class)
            net.of_word[:, HIDDEN] = np.log(net.shares / np.repeat(of_class, np.diff(net.edges)))
        return net

    def hidden_of(self, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The words of a row of tokens; the hidden layer at its places but the first and last WINDOW, and a one after it."""
        words, n = self.words.take(row, axis=0), len(row) - 2 * WINDOW
        total = np.tile(self.hidden, (n, 1))
        for d, place in zip(DISTANCES, self.places, strict=True):
            total += words[WINDOW + d : WINDOW + d + n] @ place
        out = np.empty((n, HIDDEN + 1), dtype=np.float32)
        np.tanh(total, out=out[:, :HIDDEN])
        out[:, HIDDEN] = 1
        return words, out

    def log_probs(self, row: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Log-probability of the token at each of the places of a row, given the tokens around it."""
        rank = self.rank[row[at]]
        order = np.argsort(rank, kind="stable")
        rank = rank[order]
        cuts = np.searchsorted(rank, self.edges)
        h = self.hidden_of(row)[1].take(at[order] - WINDOW, axis=0)
        _, sums, shift = exponentials(h, self.of_class)
        of = np.repeat(np.arange(self.classes), np.diff(cuts))
        logs = np.einsum("ij,ij->i", h, self.of_class[of] + self.of_word[rank]) - np.log(sums) - shift
        for k in np.flatnonzero(np.diff(cuts)).tolist():
            a, b = cuts[k], cuts[k + 1]
            _, sums, shift = exponentials(h[a:b], self.of_word[self.edges[k] : self.edges[k + 1]])
            logs[a:b] -= np.log(sums) + shift
        out = np.empty(len(at))
        out[order] = logs
        return out

    def step(self, row: np.ndarray, at: np.ndarray, rate: float) -> None:
        """One step of gradient ascent on the mean log-probability of the tokens at these places, per word it touches.

        The gradient of a softmax is what the targets add less what all outputs hold, so exponentials are
        neither divided nor copied: rows of the hidden layer are scaled instead.
        """
        n = len(at)
        rank = self.rank[row[at]]
        order = np.argsort(rank, kind="stable")
        at, rank = at[order] - WINDOW, rank[order]
        words, hidden = self.hidden_of(row)
        h = hidden.take(at, axis=0)
        heads = heads_of(rank)
        kinds, met = rank[heads], np.add.reduceat(h, heads, axis=0)
        cuts, cuts_of_kinds = np.searchsorted(rank, self.edges), np.searchsorted(kinds, self.edges)
        full = np.flatnonzero(np.diff(cuts))
        of_kind = np.repeat(np.arange(self.classes), np.diff(cuts_of_kinds))
        targets = self.of_class[of_kind, :HIDDEN] + self.of_word[kinds, :HIDDEN]
        down = np.repeat(targets, np.diff(np.append(heads, n)), axis=0)
        e, sums, _ = exponentials(h, self.of_class)
        down -= (e @ self.of_class[:, :HIDDEN]) / sums[:, None]
        gain = -((h / sums[:, None]).T @ e).T
        gain[full] += np.add.reduceat(met, cuts_of_kinds[full], axis=0)
        self.of_class += np.float32(rate * 8 / n) * gain
        for k in full.tolist():
            a, b, first = cuts[k], cuts[k + 1], self.edges[k]
            table = self.of_word[first : self.edges[k + 1]]
            e, sums, _ = exponentials(h[a:b], table)
            down[a:b] -= (e @ table[:, :HIDDEN]) / sums[:, None]
            gain = -((h[a:b] / sums[:, None]).T @ e).T
            i, j = cuts_of_kinds[k], cuts_of_kinds[k + 1]
            gain[kinds[i:j] - first] += met[i:j]
            table += np.float32(rate * 2 / (b - a)) * gain
        down *= 1 - h[:, :HIDDEN] ** 2
        self.hidden += np.float32(rate * 8 / n) * down.sum(axis=0)
        m = len(hidden)
        placed = np.zeros((m, HIDDEN), dtype=np.float32)
        placed[at] = down
        of_row = np.zeros((len(row), HIDDEN), dtype=np.float32)
        for o, d in enumerate(DISTANCES):
            part = slice(WINDOW + d, WINDOW + d + m)
            of_row[part] += placed @ self.places[o].T
            self.places[o] += np.float32(rate * 8 / n) * (words[part].T @ placed)
        order = np.argsort(row, kind="stable")
        heads = heads_of(row[order])
        # The more often a word was met, the closer its step is to the mean.
        often = np.sqrt(np.diff(np.append(heads, len(row)))).astype(np.float32)
        sums = np.add.reduceat(of_row.take(order, axis=0), heads, axis=0)
        self.words[row[order[heads]]] += np.float32(rate * STEP) * sums / often[:, None]


def exponentials(h: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray | float]:
    """Exponentials of h times the table, less a shift where they might overflow; their sums by row; the shift."""
    e, shift = h @ table.T, 0.0
    if np.abs(table).sum(axis=1).max() > 80:  # a hidden layer lies within -1 and 1
        shift = e.max(axis=1)
        e -= shift[:, None]
    np.exp(e, out=e)
    return e, e @ np.ones(len(table), dtype=np.float32), shift


def heads_of(values: np.ndarray) -> np.ndarray:
    """Where each value of a sorted array starts."""
    return np.flatnonzero(np.append(True, values[1:] != values[:-1])) if len(values) else np.zeros(0, dtype=np.int64)


def row_of(tokens: np.ndarray, firsts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The tokens of all texts in one row, WINDOW times `size`, which is no token, around each text; their places."""
    at = np.arange(len(tokens)) + WINDOW * (1 + np.repeat(np.arange(len(firsts) - 1), np.diff(firsts)))
    row = np.full(len(tokens) + WINDOW * len(firsts), size, dtype=kind_of(size))
    row[at] = tokens
    return row, at


def batches_of(row: np.ndarray, at: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Stretches of a row with what is around them, and the places of at most BATCH tokens in each."""
    for k in range(0, len(at), BATCH):
        some = at[k : k + BATCH]
        begin = some[0] - WINDOW
        yield row[begin : some[-1] + WINDOW + 1], some - begin


def _tokenised(blocks: DataFrame, id: str, text: str, vocabulary: Vocabulary, counted: DataFrame, shards: int) -> DataFrame:
    """Blocks with the tokens of their texts instead of these, staged by shard; `inside` sums what words have within them."""

    def run(block: int, table: pa.Table, answers: pa.Table) -> pa.Table:
        h, firsts = hashes_of(table.column(text))
        keys, place = np.unique(h, return_inverse=True)
        parts = answers.sort_by("bucket").column("counts").to_pylist()
        counts = np.frombuffer(b"".join(parts), dtype="<i8")
        tokens = vocabulary.of(keys)
        inside = sums_of(vocabulary.inside(tokens, counts)[place], firsts)
        kept = pa.table({"id": table.column(id), "n": pa.array(np.diff(firsts)), "inside": pa.array(inside)})
        shard = int(W.mix(np.array([block], dtype=np.uint64))[0] % np.uint64(shards))
        return pa.table(
            {
                "shard": pa.array([shard], pa.int32()),
                "block": [block],
                "n_tokens": pa.array([len(h)], pa.int64()),
                "tokens": [tokens[place].tobytes()],
                "rows": [B.pack(kept)],
            }
        )

    answers = counted.where("block IS NOT NULL").select("block", "bucket", "counts")
    found = B.with_answers(blocks, answers, run, TOKENS)
    path = fresh_dir(blocks.sparkSession, "tokens")
    found.write.partitionBy("shard").parquet(path)
    return blocks.sparkSession.read.schema(found.schema).parquet(path)


def sums_of(values: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """Sum over the words of each text."""
    if not len(values):
        return np.zeros(len(firsts) - 1)
    sums = np.add.reduceat(np.append(values, 0.0), firsts[:-1])
    return np.where(np.diff(firsts) > 0, sums, 0.0)


def _block_tokens(tokens, rows, size: int) -> tuple[pa.Table, np.ndarray, np.ndarray]:
    table = B.unpack(rows.as_buffer())
    return table, np.frombuffer(tokens.as_buffer(), dtype=kind_of(size)), np.append(0, np.cumsum(table.column("n").to_numpy()))


def train(spark: SparkSession, tokens: DataFrame, counts: np.ndarray, rounds: int = ROUNDS) -> Network:
    """The network after one pass over all tokens."""
    net = Network.fresh(counts)
    size, frequencies = net.size, spark.sparkContext.broadcast(counts)
    tasks = 2 * spark.sparkContext.defaultParallelism  # each sends weights
    for turn in range(rounds):
        shard = tokens.where(F.col("shard") == turn).coalesce(tasks)
        shared = spark.sparkContext.broadcast(net.weights)
        rate = RATE * (1 - turn / (2 * rounds))

        def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            mine, seen = Network(frequencies.value, shared.value.copy()), 0
            for batch in batches:
                for blob, rows in zip(batch.column("tokens"), batch.column("rows"), strict=True):
                    _, found, firsts = _block_tokens(blob, rows, size)
                    for part, at in batches_of(*row_of(found, firsts, size)):
                        mine.step(part, at, rate)
                    seen += len(found)
            if seen:
                pieces = range(0, len(mine.weights), PIECE)
                yield pa.RecordBatch.from_pydict(
                    {
                        "piece": pa.array([k // PIECE for k in pieces], pa.int32()),
                        "source": pa.array([TaskContext.get().partitionId()] * len(pieces), pa.int32()),
                        "mean": pa.array([mine.weights[k : k + PIECE].tobytes() for k in pieces], pa.binary()),
                        "n": pa.array([seen] * len(pieces), pa.int64()),
                    }
                )

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total, n, piece, source = None, 0, None, 0
            for batch in batches:
                for p, s, blob, c in zip(*[batch.column(x) for x in ("piece", "source", "mean", "n")], strict=True):
                    part = np.frombuffer(blob.as_buffer(), dtype=np.float32).astype(np.float64) * c.as_py()
                    total = part if total is None else total + part
                    n, piece, source = n + c.as_py(), p.as_py(), s.as_py()
            yield pa.RecordBatch.from_pydict(
                {"piece": pa.array([piece], pa.int32()), "source": pa.array([source], pa.int32()), "mean": [(total / n).astype(np.float32).tobytes()], "n": pa.array([n], pa.int64())}
            )

        kind = "piece int, source int, mean binary, n long"
        parts = shard.select("tokens", "rows").mapInArrow(learn, kind)
        parts = parts.withColumn("salt", F.pmod("source", F.lit(SALTS))).groupBy("piece", "salt").applyInArrow(add, kind)
        rows = parts.groupBy("piece").applyInArrow(add, kind).orderBy("piece").collect()  # as long as the weights
        shared.unpersist()
        if rows:
            net = Network(counts, np.concatenate([np.frombuffer(r["mean"], dtype=np.float32) for r in rows]))
    return net


def lm_scores(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The id, `n_tokens`, `log_prob` (sum over the words) and `mean_log_prob` of every document.

    Words are runs between white space, A-Z lower-cased. Null and empty texts have no words, log_prob 0 and a
    null mean. Equal texts have equal scores, but for rounding, and repeated rows stay; words of equal frequency
    enter the vocabulary by their hash. A text is tokenised whole, whatever its length. An empty table has no
    rows. Other columns of docs are left out, so their names don't matter.
    """
    spark = B.ready(docs.sparkSession)
    blocks = B.to_blocks(docs.select(id, text), text)
    counted = count_words(blocks, text)
    vocabulary = vocabulary_of(counted)
    size, rounds = vocabulary.size, max(ROUNDS, B.bucket_bits(blocks))
    tokens = _tokenised(blocks, id, text, vocabulary, counted, rounds)
    frequencies = spark.sparkContext.broadcast(vocabulary.counts)
    shared = spark.sparkContext.broadcast(train(spark, tokens, vocabulary.counts, rounds).weights)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = Network(frequencies.value, shared.value)
        for batch in batches:
            for blob, rows in zip(batch.column("tokens"), batch.column("rows"), strict=True):
                table, found, firsts = _block_tokens(blob, rows, size)
                parts = [net.log_probs(part, at) for part, at in batches_of(*row_of(found, firsts, size))]
                logs = np.concatenate([np.zeros(0), *parts])
                n = np.diff(firsts)
                sums = sums_of(logs, firsts) + table.column("inside").to_numpy()
                means = pa.array(np.divide(sums, n, out=np.zeros(len(n)), where=n > 0), mask=n == 0)
                yield pa.RecordBatch.from_arrays(
                    [table.column("id").combine_chunks(), pa.array(n), pa.array(sums), means], [id, "n_tokens", "log_prob", "mean_log_prob"]
                )

    kind = docs.schema[id].dataType.simpleString()
    return tokens.select("tokens", "rows").mapInArrow(score, f"`{id}` {kind}, n_tokens long, log_prob double, mean_log_prob double")
