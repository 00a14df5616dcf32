"""BPE encoding and decoding of whole texts: speculate, verify, merge only where that fails.

Greedy longest match proposes tokens for a word. A token sequence is the one that merging in rank
order gives if and only if every adjacent pair of tokens would also come out of merging the pair
alone. That is checked for all pairs of all new words at once: the merges of the two tokens are
undone from the latest backwards, and at each step the two pieces that touch must not have a merge
that would have come first. Words with a pair that fails are merged step by step.

Texts are cut into pieces (words, digits, marks), whose tokens depend on the piece alone. Each worker
keeps a bounded table of pieces it has met. Texts of Latin letters are lower-cased and cut by a pattern;
all others are normalised and cut by the tokenizer file's own rules.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, types as T

from shelfmark.llm.blocks import ready

# Pieces kept per worker, and pieces of texts taken at once.
CACHE_PIECES = 300_000
SLICE_PIECES = 100_000
NEVER = np.iinfo(np.int64).max
# Characters that normalisation leaves alone and whose lower case is among them.
LATIN = re.compile("[\t-\r -~\xa1-\u012f\u0131-\u017f]*")
# Letters and numbers of lower-cased LATIN texts.
LETTER, NUMBER = "a-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u017f", "0-9\xb2\xb3\xb9\xbc-\xbe"
PIECES = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{LETTER}]+|[{NUMBER}]|[^\\s{LETTER}{NUMBER}]+")
# Marks of pieces already in byte letters, and of special tokens.
CUT, SPECIAL = "\0", "\1"


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte: visible Latin-1 for itself, the letters from 256 on for the others."""
    seen = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in seen]
    return {b: chr(b) for b in seen} | {b: chr(256 + k) for k, b in enumerate(hidden)}


class WordBpe:
    """A tokenizer file of BPE with word ends."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.end = model["end_of_word_suffix"]
        self.vocab: dict[str, int] = model["vocab"]
        library = Tokenizer.from_file(path)
        self.normalizer, self.splitter = library.normalizer, library.pre_tokenizer
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_pattern = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        names = self.vocab | self.special
        self.names = [""] * (max(names.values()) + 1)
        for name, k in names.items():
            self.names[k] = name
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        ranks = {(self.vocab[a], self.vocab[b]): r for r, (a, b) in reversed(list(enumerate(merges)))}
        n = len(self.names)
        self.rank = np.full(n, -1, dtype=np.int64)
        self.left, self.right = np.arange(n), np.arange(n)
        self.made = np.array([self.vocab[a + b] for a, b in merges], dtype=np.int64)
        for (a, b), r in ranks.items():
            whole = self.made[r]
            if self.rank[whole] < 0 or r < self.rank[whole]:
                self.rank[whole], self.left[whole], self.right[whole] = r, a, b
        self.width = n
        keys = np.array([a * n + b for a, b in ranks], dtype=np.int64)
        order = np.argsort(keys)
        self.pair_keys, self.pair_ranks = keys[order], np.array(list(ranks.values()), dtype=np.int64)[order]
        # Tokens that merging their own characters does not give back must not be proposed.
        self.longest = max(len(name) for name in self.vocab if not name.endswith(self.end))
        self.proposable = dict(self.vocab)
        made = np.flatnonzero(self.rank >= 0)
        symbols = [self._symbols(self.names[k]) for k in made.tolist()]
        owner = np.repeat(np.arange(len(made)), [len(x) for x in symbols])
        tokens, owner = self.merge(np.array([k for x in symbols for k in x], dtype=np.int64), owner)
        first = np.searchsorted(owner, np.arange(len(made)))
        for k in made[(np.bincount(owner, minlength=len(made)) != 1) | (tokens[first] != made)].tolist():
            del self.proposable[self.names[k]]
        self.cache: dict[str, bytes] = {}
        self.letters = byte_letters()
        self.exact = 0

    def _symbols(self, piece: str) -> list[int]:
        """Tokens of the single characters, the last one with the word end."""
        if piece.endswith(self.end):
            body = piece[: -len(self.end)]
            return [self.vocab[c] for c in body[:-1]] + [self.vocab[body[-1] + self.end]]
        return [self.vocab[c] for c in piece]

    def _rank_of(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Rank of the merge of each pair of tokens, NEVER where there is none."""
        key = x * self.width + y
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == key, self.pair_ranks[at], NEVER)

    def merge(self, tokens: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merge the tokens of many words, each word's by least rank, leftmost first, to the end.

        Words lie one after the other; `owner` numbers them. Gives tokens and owners of all words.
        """
        done_tokens, done_owner = [], []
        rank = np.full(len(tokens), NEVER)
        rank[:-1][owner[1:] == owner[:-1]] = 0
        pairs = np.flatnonzero(rank == 0)
        rank[pairs] = self._rank_of(tokens[pairs], tokens[pairs + 1])
        while len(tokens):
            heads = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            sizes = np.diff(np.append(heads, len(tokens)))
            least = np.minimum.reduceat(rank, heads)
            over = np.repeat(least == NEVER, sizes)
            if over.any():
                done_tokens.append(tokens[over])
                done_owner.append(owner[over])
                tokens, owner, rank, least, sizes = tokens[~over], owner[~over], rank[~over], least[least != NEVER], sizes[least != NEVER]
                continue
            place = np.flatnonzero(rank == np.repeat(least, sizes))
            place = place[np.append(True, owner[place[1:]] != owner[place[:-1]])]
            tokens[place] = self.made[rank[place]]
            stay = np.ones(len(tokens), dtype=bool)
            stay[place + 1] = False
            place = place - np.arange(len(place))  # one token fewer for each merge before
            tokens, owner, rank = tokens[stay], owner[stay], rank[stay]
            for at in (place - 1, place):
                at = at[at >= 0]
                inside = np.zeros(len(at), dtype=bool)
                few = at + 1 < len(tokens)
                inside[few] = owner[at[few]] == owner[at[few] + 1]
                rank[at[~inside]] = NEVER
                at = at[inside]
                rank[at] = self._rank_of(tokens[at], tokens[at + 1])
        if not done_tokens:
            return tokens, owner
        owner = np.concatenate(done_owner)
        order = np.argsort(owner, kind="stable")
        return np.concatenate(done_tokens)[order], owner[order]

    def propose(self, piece: str) -> list[int]:
        """Longest token first; every single character is a token, and the last token bears the word end."""
        get, whole, last = self.proposable.get, piece + self.end, len(piece) - 1
        out, at = [], 0
        while (k := get(whole[at:])) is None:
            to = min(last, at + self.longest)
            while (k := get(piece[at:to])) is None:
                to -= 1
                if to == at:
                    raise ValueError(f"no token for {piece[at]!r}")
            out.append(k)
            at = to
        out.append(k)
        return out

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether merging the characters of a pair of tokens gives just these two tokens."""
        a, b = a.copy(), b.copy()
        until_a, until_b = np.full(len(a), NEVER), np.full(len(a), NEVER)
        good = np.ones(len(a), dtype=bool)
        live = np.arange(len(a))
        while len(live):
            x, y = a[live], b[live]
            rank = self._rank_of(x, y)
            bad = (rank < until_a[live]) & (rank <= until_b[live]) & (rank != NEVER)
            good[live[bad]] = False
            more = ~bad & ((self.rank[x] >= 0) | (self.rank[y] >= 0))
            live, x, y = live[more], x[more], y[more]
            first = self.rank[x] > self.rank[y]
            undo, keep = live[first], live[~first]
            until_a[undo], a[undo] = self.rank[x[first]], self.right[x[first]]
            until_b[keep], b[keep] = self.rank[y[~first]], self.left[y[~first]]
        return good

    def pieces(self, text: str) -> list[str]:
        """Pieces of a text under their names in the table."""
        if LATIN.fullmatch(text) and "<|" not in text:
            return PIECES.findall(text.lower())
        out = []
        for segment in self.special_pattern.split(text) if self.special_pattern else [text]:
            if segment in self.special:
                out.append(SPECIAL + segment)
            elif segment:
                out += [CUT + p for p, _ in self.splitter.pre_tokenize_str(self.normalizer.normalize_str(segment))]
        return out

    def learn(self, new: list[str]) -> None:
        """Add the tokens of new pieces to the table."""
        tokens: list[list[int]] = []
        texts: list[str] = []
        for name in new:
            if name[0] == SPECIAL:
                tokens.append([self.special[name[1:]]])
                texts.append("")
                continue
            text = name[1:] if name[0] == CUT else name
            if name[0] != CUT and not name.isascii():
                text = "".join(map(self.letters.__getitem__, name.encode()))
            tokens.append(self.propose(text))
            texts.append(text)
        owner, flat = _flat(tokens)
        inside = np.flatnonzero(owner[1:] == owner[:-1])
        failed = np.unique(owner[inside[~self.compatible(flat[inside], flat[inside + 1])]])
        if len(failed):
            self.exact += len(failed)
            where, symbols = _flat([self._symbols(texts[k] + self.end) for k in failed.tolist()])
            merged, where = self.merge(symbols, where)
            right = ~np.isin(owner, failed)
            flat, owner = np.append(flat[right], merged), np.append(owner[right], failed[where])
            order = np.argsort(owner, kind="stable")
            flat, owner = flat[order], owner[order]
        ids = flat.astype("<u4").tobytes()
        places = (4 * np.searchsorted(owner, np.arange(len(new) + 1))).tolist()
        self.cache.update(zip(new, [ids[a:b] for a, b in zip(places, places[1:], strict=False)], strict=True))

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        out = [bytearray() for _ in texts]
        held: list[tuple[int, list[str]]] = []
        size = 0
        for k, text in enumerate(texts):
            pieces = self.pieces(text)
            for at in range(0, len(pieces), SLICE_PIECES):
                held.append((k, pieces[at : at + SLICE_PIECES]))
                size += len(held[-1][1])
                if size >= SLICE_PIECES:
                    self._fill(out, held)
                    held, size = [], 0
        self._fill(out, held)
        return [bytes(x) for x in out]

    def _fill(self, out: list[bytearray], held: list[tuple[int, list[str]]]) -> None:
        new = set().union(*[pieces for _, pieces in held]).difference(self.cache)
        if len(self.cache) + len(new) > CACHE_PIECES:
            self.cache.clear()
            new = set().union(*[pieces for _, pieces in held])
        if new:
            self.learn(list(new))
        for k, pieces in held:
            out[k] += b"".join(map(self.cache.__getitem__, pieces))

    def decode(self, ids: bytes) -> str:
        """Names of the tokens with blanks between them: the file names no other decoder."""
        return " ".join(map(self.names.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))


def _flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """Number of the list of each element, and all elements."""
    sizes = np.array([len(x) for x in lists], dtype=np.int64)
    flat = np.fromiter((k for x in lists for k in x), dtype=np.int64, count=int(sizes.sum()))
    return np.repeat(np.arange(len(lists)), sizes), flat


@lru_cache(maxsize=2)
def word_bpe(path: str) -> WordBpe:
    return WordBpe(path)


def bpe_encode(docs: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Columns of docs with `ids` (binary, little-endian unsigned 32 bit) and `n_tokens`.

    Null and empty texts, and texts of white space only, have no tokens. Rows keep their place; equal
    rows have equal results. Strings of special tokens become these tokens. Columns of docs that bear a
    result's name are replaced.
    """
    return _mapped(docs, {ids: T.BinaryType(), "n_tokens": T.LongType()}, lambda rows: _encode(rows, path, text, ids))


def bpe_decode(docs: DataFrame, path: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """Columns of docs with the decoded text; null ids are none and give the empty text."""
    return _mapped(docs, {decoded: T.StringType()}, lambda rows: _decode(rows, path, ids, decoded))


def _encode(rows: pa.RecordBatch, path: str, text: str, ids: str) -> dict[str, pa.Array]:
    found = word_bpe(path).encode_all([x or "" for x in rows.column(text).to_pylist()])
    return {ids: pa.array(found, pa.binary()), "n_tokens": pa.array([len(x) // 4 for x in found], pa.int64())}


def _decode(rows: pa.RecordBatch, path: str, ids: str, decoded: str) -> dict[str, pa.Array]:
    bpe = word_bpe(path)
    return {decoded: pa.array([bpe.decode(x or b"") for x in rows.column(ids).to_pylist()], pa.string())}


def _mapped(docs: DataFrame, added: dict[str, T.DataType], make) -> DataFrame:
    """`make` for slices of rows of about a megabyte, its columns after the others."""
    ready(docs.sparkSession)
    names = {n.lower() for n in added}
    kept = [f for f in docs.schema if f.name.lower() not in names]
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in kept] + [T.StructField(n, t) for n, t in added.items()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            step = max(1, batch.num_rows * (1 << 20) // (batch.nbytes + 1))
            for k in range(0, batch.num_rows, step):
                rows = batch.slice(k, step)
                columns = {f.name: rows.column(f.name) for f in kept} | make(rows)
                yield pa.RecordBatch.from_pydict(columns)

    return docs.mapInArrow(run, schema)
