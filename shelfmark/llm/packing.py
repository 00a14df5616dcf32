"""Packing: documents in order, cut into sequences of at most `length` tokens.

The tokens of a partition form one stream, each document ended by an end token. Cuts may fall
after a document (no penalty), after a sentence, or, in long sentences, after every STRIDE tokens;
the penalties are counted in padding tokens. The best cuts minimise padding plus penalties:
cost(j) = length + penalty(j) + min cost(i) over all i at most `length` tokens before j. That
minimum slides along with j, so a queue of rising costs gives it in constant time. A
partition is solved piece by piece; the last sequence of a piece stays open and starts the next.

The last sequence of a partition, less than `length` tokens, is its tail. Tails go on to a next pass: those of
TAILS partitions in a row form a stream of their own in one group and are packed by the same programme, and so
on with the tails of the groups until one is left. A sequence is padded to `length` unless its own length is a power of
two, so that last rest, which no document can fill, is cut into powers of two: one rest, however the input
is split. Only tails are shuffled, and each task holds about STREAM tokens and one document, or TAILS tails.
"""

from __future__ import annotations

import os
import re
from collections import deque
from collections.abc import Iterator
from functools import lru_cache
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from shelfmark.llm.blocks import give_back, ready, staged

LENGTH = 2048
END_ID = 1
SENTENCE_PENALTY = 4
INNER_PENALTY = 24
STRIDE = 32
STREAM = 1 << 20
TAILS = 1 << 10  # tails that are packed together
# Where a blank stands before anything but white space, a token of a byte-level tokenizer starts.
CUT = re.compile(r"(?= \S)")
# Latin letters, digits, marks, blanks and line feeds: cut alike by the tokenizers library and by tiktoken.
PLAIN = re.compile("[\n -~\xa1-\u024f]*")


def byte_letters() -> dict[str, int]:
    """The byte of each letter of byte-level names: visible Latin-1 stands for itself, the other bytes,
    in order, for the letters from 256 on."""
    seen = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in seen]
    return {chr(b): b for b in seen} | {chr(256 + k): b for k, b in enumerate(hidden)}


class ByteBpe:
    """Ids as the tokenizers library gives them for a byte-level file whose ids rise with merge rank.

    Stretches of plain text are encoded by tiktoken from the same vocabulary, which is several times
    as fast; stretches with other characters or special tokens by the tokenizers library itself.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        letters = byte_letters()
        special = set(self.library.get_added_tokens_decoder())
        names = {
            k: bytes(map(letters.__getitem__, name)) for name, k in self.library.get_vocab().items() if k not in special
        }
        self.sentence = np.zeros(max(names) + 1, dtype=bool)
        for k, name in names.items():
            self.sentence[k] = b"\n" in name or name.rstrip(b"\"')").endswith((b".", b"!", b"?"))
        self.quick = tiktoken.Encoding(
            "plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks={b: k for k, b in names.items()}, special_tokens={}
        )

    def encode(self, text: str) -> np.ndarray:
        if is_plain(text):
            return np.array(self.quick.encode_ordinary(text), dtype="<u4")
        ids: list[int] = []
        for plain, chunks in groupby(CUT.split(text), is_plain):
            stretch = "".join(chunks)
            ids += self.quick.encode_ordinary(stretch) if plain else self.library.encode(stretch, add_special_tokens=False).ids
        return np.array(ids, dtype="<u4")


def is_plain(text: str) -> bool:
    return PLAIN.fullmatch(text) is not None and "<|" not in text


@lru_cache(maxsize=2)
def byte_bpe(path: str) -> ByteBpe:
    return ByteBpe(path)


def cut_points(ids: np.ndarray, first: int, total: int, sentence: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places after which a document's tokens may be cut, counted from `first`, and their penalties.

    `ids` are its tokens from `first` on, the last one its end token.
    """
    known = ids < len(sentence)
    stops = np.flatnonzero(sentence[np.where(known, ids, 0)] & known) + 1
    edges = np.arange(STRIDE - first % STRIDE, len(ids), STRIDE)
    places = np.union1d(stops, edges)
    places = places[places < len(ids) - 1]  # the end token stays with its document
    penalties = np.full(len(places) + 1, INNER_PENALTY)
    penalties[:-1][np.isin(places, stops)] = SENTENCE_PENALTY
    penalties[-1] = 0
    return np.append(places, len(ids)), penalties


def best_cuts(places: list[int], penalties: list[int], length: int) -> list[int]:
    """Ends of the sequences of a stream from 0 to the last place."""
    places, penalties = [0, *places], [0, *penalties]
    cost, back = [0] * len(places), [0] * len(places)
    queue: deque[int] = deque([0])
    for j in range(1, len(places)):
        least = places[j] - length
        while places[queue[0]] < least:
            queue.popleft()
        i = queue[0]
        mine = cost[i] + length + penalties[j]
        cost[j], back[j] = mine, i
        while queue and cost[queue[-1]] >= mine:
            queue.pop()
        queue.append(j)
    ends, j = [], len(places) - 1
    while j:
        ends.append(places[j])
        j = back[j]
    return ends[::-1]


class Packer:
    """The open part of a stream: (id, tokens in all, first open token, open tokens)."""

    def __init__(self, length: int, sentence: np.ndarray, sequence: int) -> None:
        self.length, self.sentence, self.sequence = length, sentence, sequence
        self.open: list[tuple[object, int, int, np.ndarray]] = []
        self.size = 0

    def add(self, name, ids: np.ndarray, total: int | None = None, first: int = 0) -> None:
        self.open.append((name, len(ids) if total is None else total, first, ids))
        self.size += len(ids)

    def tail(self) -> list[tuple]:
        """The open documents as pieces of no sequence yet, in order."""
        return [(name, first, len(ids), ids.tobytes(), total, None, k) for k, (name, total, first, ids) in enumerate(self.open)]

    def flush(self, last: bool) -> list[tuple]:
        """Pieces of all finished sequences; at the end of all."""
        if not self.open:
            return []
        places, penalties, at = [], [], 0
        for _, total, first, ids in self.open:
            p, q = cut_points(ids, first, total, self.sentence)
            places.append(p + at)
            penalties.append(q)
            at += len(ids)
        ends = best_cuts(np.concatenate(places).tolist(), np.concatenate(penalties).tolist(), self.length)
        if last:
            begin = ends[-2] if len(ends) > 1 else 0
            rest, ends = at - begin, ends[:-1]
            for k in range(rest.bit_length() - 1, -1, -1):
                if rest >> k & 1:
                    begin += 1 << k
                    ends.append(begin)
        else:
            ends = ends[:-1]
        return self._cut(ends)

    def _cut(self, ends: list[int]) -> list[tuple]:
        out, k, at = [], 0, 0  # the open document, and where its first open token is
        begin = 0
        left = self.open
        for end in ends:
            place = begin
            while place < end:
                name, total, first, ids = left[k]
                n = min(end, at + len(ids)) - place
                inside = place - at
                out.append((name, first + inside, n, ids[inside : inside + n].tobytes(), total, self.sequence, place - begin))
                place += n
                if place == at + len(ids):
                    at += len(ids)
                    k += 1
            begin = end
            self.sequence += 1
        self.open = left[k:]
        if self.open and begin > at:
            name, total, first, ids = self.open[0]
            self.open[0] = (name, total, first + begin - at, ids[begin - at :])
        self.size = sum(len(x[3]) for x in self.open)
        return out


def pack(
    docs: DataFrame,
    path: str,
    id: str = "doc_id",
    text: str = "text",
    length: int = LENGTH,
    end_id: int = END_ID,
) -> DataFrame:
    """One row per piece: the id, `start` (tokens of its document before it), `length`, `ids` (binary,
    little-endian unsigned 32 bit), `doc_tokens`, `sequence_id` and `offset` in the sequence.

    Null and empty texts have the end token alone. Every row is a document of its own, equal ones and
    those with equal or null ids too. A text is encoded whole, whatever its length, and may fill many sequences. Other
    columns of docs are left out, whatever their names; an empty table gives no rows. Sequences are numbered within
    their partition or group of tails, which gives the leading bits; documents keep the order of the rows.
    """
    ready(docs.sparkSession)
    kind = docs.schema[id].dataType.simpleString()
    names = (id, "start", "length", "ids", "doc_tokens", "sequence_id", "offset")
    schema = f"`{id}` {kind}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, _part long"

    def pieces(found: list[tuple], part: int, kinds) -> pa.RecordBatch:
        columns = [*zip(*found, strict=True)] or [()] * len(names)
        arrays = [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)]
        return pa.RecordBatch.from_arrays([*arrays, pa.array([part] * len(found), pa.int64())], [*names, "_part"])

    def kinds_of(batch) -> tuple:
        return batch.schema.field(id).type, pa.int64(), pa.int64(), pa.binary(), *[pa.int64()] * 3

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, part = byte_bpe(path), TaskContext.get().partitionId()
        packer, kinds = Packer(length, bpe.sentence, part << 40), None
        for batch in batches:
            kinds = kinds or kinds_of(batch)
            for name, words in zip(batch.column(id).to_pylist(), batch.column(text), strict=True):
                packer.add(name, np.append(bpe.encode(words.as_py() or ""), np.uint32(end_id)).astype("<u4"))
                if packer.size >= STREAM:
                    yield pieces(packer.flush(False), part, kinds)
        if packer.open:
            yield pieces(packer.flush(False), part, kinds)
            yield pieces(packer.tail(), part, kinds)
        give_back()

    def tails(level: int, last: bool):
        def run(table: pa.Table) -> pa.Table:
            group = table.column("_part")[0].as_py() // TAILS
            table = table.sort_by([("_part", "ascending"), ("offset", "ascending")])
            packer, kinds, out = Packer(length, byte_bpe(path).sentence, (1 << 62) + (level << 58) + (group << 40)), kinds_of(table), []
            for row in table.to_pylist():
                packer.add(row[id], np.frombuffer(row["ids"], dtype="<u4"), row["doc_tokens"], row["start"])
                if packer.size >= STREAM:
                    out.append(pieces(packer.flush(False), group, kinds))
            out.append(pieces(packer.flush(last), group, kinds))
            if packer.open:
                out.append(pieces(packer.tail(), group, kinds))
            return pa.Table.from_batches(out)

        return run

    level, found = 0, staged(docs.select(id, text).mapInArrow(run, schema), "pieces")
    result = found.where("sequence_id IS NOT NULL").select(*names)
    while True:
        level, rest = level + 1, found.where("sequence_id IS NULL")
        most = rest.agg(F.max("_part")).first()[0]
        if most is None:
            return result
        last = most < TAILS
        packed = rest.groupBy(F.floor(F.col("_part") / TAILS)).applyInArrow(tails(level, last), schema)
        found = staged(packed, "tails")
        result = result.unionByName(found.where("sequence_id IS NOT NULL").select(*names))
