from collections import Counter
import random

import awkward as A
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from shelfmark.llm import bpe as E
from shelfmark.llm import packing as P

WORD = public_tokenizers.path("word_bpe_49k.json")
BYTE = public_tokenizers.path("byte_bpe_50k.json")
LETTERS = [
    *map(chr, range(0x250)),
    *"̀́Σςİẞ 　가가一\U0001f600Ⅰ٠ΩÅﬁ\U0001d400",
    *["  ", "\n\n", "   ", "<|endoftext|>", "<|startoftext|>", "'ll", " 's"],
]


def odd_texts(n, seed=1):
    r = random.Random(seed)
    return ["".join(r.choice(LETTERS if r.random() < 0.5 else "abcdehinostr'  \n.<|>1") for _ in range(r.randrange(30))) for _ in range(n)]


def test_encoding_equals_the_library():
    library, own = Tokenizer.from_file(WORD), E.WordBpe(WORD)
    texts = [*odd_texts(1500), *[t or "" for t in A.texts()], "a" * 3000, "ab" * 500, "</w>", "é" * 300, "ha" * 33 + "!" * 77]
    for text, ids in zip(texts, own.encode_all(texts), strict=True):
        want = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, dtype="<u4").tolist() == want
        assert own.decode(ids) == library.decode(want, skip_special_tokens=False)
    assert own.exact > 0


def test_pairs_are_checked_like_merging():
    own = E.WordBpe(WORD)
    r = np.random.default_rng(4)
    plain = np.array([k for k, name in enumerate(own.names) if not name.endswith(own.end) and name not in own.special])
    last = np.array([k for k, name in enumerate(own.names) if name.endswith(own.end)])
    a, b = r.choice(plain, 3000), r.choice(last, 3000)
    good = own.compatible(a, b)
    for x, y, ok in zip(a.tolist(), b.tolist(), good.tolist(), strict=True):
        symbols = own._symbols(own.names[x] + own.names[y])
        merged, _ = own.merge(np.array(symbols), np.zeros(len(symbols), dtype=np.int64))
        assert (merged.tolist() == [x, y]) == ok


def test_a_full_table_is_emptied(monkeypatch):
    monkeypatch.setattr(E, "CACHE_PIECES", 50)
    monkeypatch.setattr(E, "SLICE_PIECES", 20)
    library, own = Tokenizer.from_file(WORD), E.WordBpe(WORD)
    texts = [A.prose(k, 90) for k in range(20)]
    for text, ids in zip(texts, own.encode_all(texts), strict=True):
        assert np.frombuffer(ids, dtype="<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_round_trip_in_spark(spark):
    library = Tokenizer.from_file(WORD)
    docs = A.frame(spark).withColumnRenamed("seen", "ids")
    found = E.bpe_decode(E.bpe_encode(docs, WORD), WORD)
    assert [c for c in found.columns if c in ("ids", "n_tokens", "decoded")] == ["ids", "n_tokens", "decoded"]
    rows = found.collect()
    assert len(rows) == len(A.rows())
    for r in rows:
        want = library.encode(r.text or "", add_special_tokens=False).ids
        assert np.frombuffer(bytes(r.ids), dtype="<u4").tolist() == want and r.n_tokens == len(want)
        assert r.decoded == library.decode(want, skip_special_tokens=False)
    assert E.bpe_decode(E.bpe_encode(A.empty(spark), WORD), WORD).count() == 0


def test_packed_ids_equal_the_library():
    library, own = Tokenizer.from_file(BYTE), P.ByteBpe(BYTE)
    for text in [*odd_texts(1500, 2), *[t or "" for t in A.texts()]]:
        assert own.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids


def slow_cost(places, penalties, length):
    cost = {0: 0}
    for j, (p, q) in enumerate(zip(places, penalties, strict=True)):
        before = [0, *places[:j]]
        cost[p] = min(cost[i] for i in before if p - i <= length) + length + q
    return cost[places[-1]]


@pytest.mark.parametrize("seed", range(5))
def test_cuts_cost_least(seed):
    r = random.Random(seed)
    places = sorted(r.sample(range(1, 400), 120)) + [400]
    penalties = [r.choice([0, 4, 24]) for _ in places]
    ends = P.best_cuts(places, penalties, 50)
    assert ends[-1] == 400 and all(b - a <= 50 for a, b in zip([0, *ends], ends, strict=False))
    assert sum(50 + penalties[places.index(e)] for e in ends) == slow_cost(places, penalties, 50)


def check_pieces(rows, texts, length, library):
    """Every id in one piece, sequences without gaps, padding in all."""
    sequences, documents = {}, {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append(r)
        assert len(r.ids) == 4 * r.length
    pad = total = 0
    for pieces in sequences.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at and r.length > 0
            at += r.length
        assert at <= length
        total += at
        pad += length - at if at & (at - 1) else 0
    for r in sorted(rows, key=lambda r: r.start):
        documents.setdefault(r.doc_id, []).append(r)
    for id, text in texts:
        want = [*library.encode(text or "", add_special_tokens=False).ids, 1]
        got = b"".join(bytes(r.ids) for r in documents[id])
        assert np.frombuffer(got, dtype="<u4").tolist() == want
        starts = [r.start for r in documents[id]]
        assert starts == np.cumsum([0, *[r.length for r in documents[id]]])[:-1].tolist()
        assert {r.doc_tokens for r in documents[id]} == {len(want)}
    return pad, total


@pytest.mark.parametrize("stream", [1 << 20, 300])
def test_every_id_is_in_one_piece(spark, monkeypatch, stream):
    monkeypatch.setattr(P, "STREAM", stream)
    library = Tokenizer.from_file(BYTE)
    texts = [(k, t) for k, t in enumerate(A.texts())]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    rows = P.pack(docs, BYTE, length=64).collect()
    pad, total = check_pieces(rows, texts, 64, library)
    assert pad < 0.2 * total


def test_little_padding(spark):
    texts = [(k, ". ".join(A.prose(50 * k + j, 12) for j in range(20)) + ".") for k in range(300)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").coalesce(1)
    rows = P.pack(docs, BYTE).collect()
    pad, total = check_pieces(rows, texts, 2048, Tokenizer.from_file(BYTE))
    assert pad < 0.01 * total


def test_rows_of_one_id_are_documents_of_their_own(spark):
    docs = A.frame(spark)
    rows = P.pack(docs, BYTE).collect()
    assert sum(r.start == 0 for r in rows) == docs.count()
    assert sum(r.doc_id is None and r.start == 0 for r in rows) == 2
    assert P.pack(A.empty(spark), BYTE).count() == 0


@pytest.mark.parametrize("tails", [1024, 4])
def test_tails_are_packed_however_the_input_is_split(spark, monkeypatch, tails):
    """Of many small partitions only one rest is cut into powers of two; groups of tails in several levels."""
    monkeypatch.setattr(P, "TAILS", tails)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").repartition(40, "doc_id")
    texts = [(r.doc_id, r.text) for r in docs.collect()]
    rows = P.pack(docs, BYTE).collect()
    check_pieces(rows, texts, 2048, Tokenizer.from_file(BYTE))
    sizes = Counter()
    for r in rows:
        sizes[r.sequence_id] += r.length
    scraps = [n for n in sizes.values() if n < 2048 and n & (n - 1) == 0]
    assert len(scraps) <= 11 + 3 and sum(sizes.values()) > 40 * 2048
    assert sum(scraps) < 0.02 * sum(sizes.values())
