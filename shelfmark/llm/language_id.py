"""Language identification by hyperdimensional profiles.

Every letter has a random vector of DIMS entries +1 and -1, made from its code point. Three letters in a row
are bound to one vector: the first letter's, shifted by two places, times the second's, shifted by one, times
the third's. A text is the bundle of its letter triples, that is the sum of their vectors; a language is
the bundle of all texts in it. The cosine between a text's bundle and the prototype of each language gives
the prediction.

Texts are lower-cased; anything between letters counts as one blank, which has a vector of its own, and so do both
ends of a text. Bundles are sums, so prototypes are added up from the bundles of batches: tasks send one bundle per
language, never texts or triples. Prototypes are the only thing sent to all tasks, DIMS numbers per language.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from shelfmark.llm.blocks import ready, result_schema, text_bytes

DIMS = 1024
SEED = 8191
# Languages that may be learned; prototypes of so many fit every task.
MAX_LANGUAGES = 4096
# Bytes of the texts bundled at once, and of those that prototypes are learned from.
BATCH_BYTES = 1 << 17
LEARN_BYTES = 1 << 21
SALTS = 16
UNKNOWN = "und"
BLANK = 0x20
POINTS = 0x110000
PARTIAL = "lang string, salt int, bundle binary"


@lru_cache(maxsize=1)
def _alphabet() -> np.ndarray:
    """For every code point its lower-case letter, and BLANK for what is no letter."""
    out = np.full(POINTS, BLANK, dtype=np.uint32)
    for point in range(POINTS):
        c = chr(point)
        if c.isalpha():
            low = c.lower()
            out[point] = ord(low) if len(low) == 1 else point
    return out


@lru_cache(maxsize=4096)
def letter_vector(point: int) -> np.ndarray:
    """Random entries +1 and -1 of a letter."""
    return (np.random.default_rng([SEED, point]).integers(0, 2, DIMS) * 2 - 1).astype(np.float32)


def triples(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Letter triples of the texts as numbers, and which text each is of; a text without letters has none."""
    points = np.frombuffer("\x00".join(["", *[t or "" for t in texts], ""]).encode("utf-32-le", "surrogatepass"), dtype="<u4")
    # lengths, not the zeros just put in, say where texts end: texts may hold zeros
    edges = np.cumsum([0, *[len(t or "") + 1 for t in texts]])
    letters = _alphabet()[points]
    owner = np.repeat(np.arange(len(texts)), np.diff(edges))
    owner = np.append(owner, len(texts) - 1)[: len(points)] if len(texts) else owner
    border = np.zeros(len(points), dtype=bool)
    border[edges] = True
    blank = letters == BLANK
    # of blanks in a row one is kept, but borders are kept all
    kept = ~blank | border
    kept[1:] |= blank[1:] & ~blank[:-1]
    at = np.flatnonzero(kept)
    at = at[~(blank[at] & ~border[at] & np.append(border[at][1:] & blank[at][1:], False))]  # a blank before an end
    word, ends = letters[at].astype(np.uint64), border[at]
    if len(at) < 3:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    keys = word[:-2] << np.uint64(42) | word[1:-1] << np.uint64(21) | word[2:]
    inside = ~ends[1:-1]  # the middle one lies within a text
    return keys[inside], owner[at[1:-1][inside]]


def bound(keys: np.ndarray) -> np.ndarray:
    """The vector of each triple."""
    letters, place = np.unique(np.concatenate([keys >> np.uint64(s) & np.uint64(0x1FFFFF) for s in (42, 21, 0)]), return_inverse=True)
    table = np.array([letter_vector(int(x)) for x in letters], dtype=np.float32).reshape(-1, DIMS)
    first, second, third = place.reshape(3, -1)
    out = np.roll(table, 2, axis=1)[first]
    out *= np.roll(table, 1, axis=1)[second]
    out *= table[third]
    return out


def bundles(keys: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """The bundle of each of n owners of triples."""
    if not len(keys):
        return np.zeros((n, DIMS), dtype=np.float32)
    kinds, place = np.unique(keys, return_inverse=True)
    out = np.zeros((n, DIMS), dtype=np.float32)
    step = max(1, (1 << 23) // max(n, DIMS))  # kinds of triples at a time
    for a in range(0, len(kinds), step):
        mine = (place >= a) & (place < a + step) if len(kinds) > step else slice(None)
        m = min(step, len(kinds) - a)
        counts = np.bincount(owner[mine] * m + place[mine] - a, minlength=n * m).reshape(n, m)
        out += counts.astype(np.float32) @ bound(kinds[a : a + m])
    return out


def _portions(batch: pa.RecordBatch, text: str, size: int) -> Iterator[pa.RecordBatch]:
    """Rows in order, cut at about `size` bytes of text."""
    part = np.cumsum(text_bytes(batch.column(text)) + 16) // size
    edges = np.append(np.flatnonzero(np.append(True, part[1:] != part[:-1])), len(part)) if len(part) else [0]
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        yield batch.slice(int(a), int(b - a))


def learn(docs: DataFrame, among: Column, text: str = "text", lang: str = "lang") -> DataFrame:
    """One prototype per language: lang, bundle (DIMS doubles), from the rows for which `among` holds."""
    ready(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        salt = TaskContext.get().partitionId() % SALTS
        for batch in batches:
            for part in _portions(batch, "text", LEARN_BYTES):
                codes = part.column("lang").dictionary_encode()
                keys, owner = triples(part.column("text").to_pylist())
                found = bundles(keys, codes.indices.to_numpy()[owner].astype(np.int64), len(codes.dictionary))
                met = np.unique(codes.indices.to_numpy()[owner])
                for code in met.tolist():
                    name = codes.dictionary[code].as_py()
                    sums[name] = sums.get(name, 0.0) + found[code].astype(np.float64)
            if len(sums) > MAX_LANGUAGES:
                yield rows(sums, salt)
                sums = {}
        if sums:
            yield rows(sums, salt)

    def rows(sums: dict[str, np.ndarray], salt: int) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict(
            {"lang": pa.array(list(sums), pa.string()), "salt": pa.array([salt] * len(sums), pa.int32()), "bundle": [x.tobytes() for x in sums.values()]}
        )

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, lang, salt = np.zeros(DIMS), None, 0
        for batch in batches:
            for name, s, blob in zip(batch.column("lang"), batch.column("salt"), batch.column("bundle"), strict=True):
                total += np.frombuffer(blob.as_buffer(), dtype=np.float64)
                lang, salt = name.as_py(), s.as_py()
        yield pa.RecordBatch.from_pydict({"lang": pa.array([lang]), "salt": pa.array([salt], pa.int32()), "bundle": [total.tobytes()]})

    rows_in = docs.where(among & F.col(text).isNotNull() & F.col(lang).isNotNull())
    parts = rows_in.select(F.col(text).alias("text"), F.col(lang).cast("string").alias("lang")).mapInArrow(run, PARTIAL)
    parts = parts.groupBy("lang", "salt").applyInArrow(add, PARTIAL)
    return parts.groupBy("lang").applyInArrow(add, PARTIAL).select("lang", "bundle")


def language_id(docs: DataFrame, prototypes: DataFrame, text: str = "text") -> DataFrame:
    """docs with `lang_pred` and `score`, the cosine with that language's prototype (0 if negative).

    A null text and one without letters is UNKNOWN with score 0, and so is every text if nothing was learned. Of
    equal cosines the first language in order of its name wins. Equal texts get equal results, repeated rows
    stay, whole texts count whatever their length, and columns of docs named lang_pred or score are replaced. An
    empty table stays empty. More than MAX_LANGUAGES languages are refused.
    """
    ready(docs.sparkSession)
    learned = prototypes.orderBy("lang").limit(MAX_LANGUAGES + 1).collect()
    if len(learned) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    names = [r["lang"] for r in learned]
    table = np.array([np.frombuffer(r["bundle"]) for r in learned]).reshape(-1, DIMS)
    lengths = np.linalg.norm(table, axis=1, keepdims=True)
    shared = docs.sparkSession.sparkContext.broadcast((table / np.where(lengths > 0, lengths, 1)).astype(np.float32))
    kept = [c for c in docs.columns if c.lower() not in ("lang_pred", "score")]
    schema = result_schema(docs, "lang_pred string, score double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _portions(batch, text, BATCH_BYTES):
                n = part.num_rows
                pred, score = np.full(n, len(names)), np.zeros(n)
                keys, owner = triples(part.column(text).to_pylist())
                if len(names) and len(keys):
                    found = bundles(keys, owner, n)
                    norms = np.sqrt(np.einsum("ij,ij->i", found, found, dtype=np.float64))
                    cosines = (found @ shared.value.T) / np.where(norms > 0, norms, 1)[:, None]
                    lettered = np.bincount(owner, minlength=n) > 0
                    pred = np.where(lettered, cosines.argmax(axis=1), pred)
                    score = np.where(lettered, np.clip(cosines.max(axis=1), 0, 1), 0.0)
                columns = [part.column(c) for c in kept]
                said = pa.array([*names, UNKNOWN], pa.string()).take(pa.array(pred))
                yield pa.RecordBatch.from_arrays([*columns, said, pa.array(score, pa.float64())], [*kept, "lang_pred", "score"])

    return docs.mapInArrow(run, schema)
