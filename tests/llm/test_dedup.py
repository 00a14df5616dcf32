import random

import awkward as A
import numpy as np
import pytest

from shelfmark.llm import jaccard_join as J
from shelfmark.llm import substring_dedup as S
from shelfmark.llm import words as W
from shelfmark.llm.line_dedup import SeenTwice, line_dedup
from shelfmark.llm.substring_dedup import substring_dedup


def ordered(rows):
    return sorted(rows, key=repr)


def test_covers_meet_at_every_distance():
    for period, cover in S.COVERS.items():
        for distance in range(period):
            assert any((a - b) % period == distance for a in cover for b in cover)


@pytest.mark.parametrize("window", [1, 2, 3, 8, 35])
def test_substring_equals_plain(spark, window):
    docs = A.frame(spark)
    rows = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    plain = A.plain_substring([t for _, t, _ in rows], window)
    want = [(i, t, s, n, n - len(k), " ".join(k)) for (i, t, s), (n, k) in zip(rows, plain, strict=True)]
    found = substring_dedup(docs, window=window)
    assert found.columns == [*[c for c in docs.columns if c not in ("n_words", "kept_text")], "n_words", "n_removed", "kept_text"]
    got = [tuple(r) for r in found.select("doc_id", "text", "source", "n_words", "n_removed", "kept_text").collect()]
    assert ordered(got) == ordered(want)


def test_substring_across_many_blocks(spark, monkeypatch):
    from shelfmark.llm import blocks

    monkeypatch.setattr(blocks, "BLOCK_BYTES", 500)
    monkeypatch.setattr(blocks, "BUCKET_BYTES", 2000)
    r = random.Random(5)
    passages = [A.prose(100 + k, 20) for k in range(4)]
    texts = [" ".join(r.choice([A.prose(k * 10 + j, r.randrange(15)), r.choice(passages)]) for j in range(4)) for k in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {r.doc_id: r.kept_text for r in substring_dedup(docs, window=12).collect()}
    assert got == {k: " ".join(x) for k, (_, x) in enumerate(A.plain_substring(texts, 12))}


def test_lines_equal_plain(spark):
    docs = A.frame(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = [(i, n, k) for (i, _), (n, k) in zip(rows, A.plain_lines(rows), strict=True)]
    got = [tuple(r) for r in line_dedup(docs).select("doc_id", "n_lines", "kept_text").collect()]
    assert ordered(got) == ordered(want)


def test_wrong_suspicions_change_nothing(spark, monkeypatch):
    from shelfmark.llm import line_dedup as L

    monkeypatch.setattr(L.SeenTwice, "suspected", lambda self, h: np.ones(len(h), dtype=bool))
    rows = [(k, f"line number {k} stands alone\nshared by two {k // 2} at least") for k in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.kept_text for r in line_dedup(docs).collect()}
    assert got == {i: k for (i, _), (_, k) in zip(rows, A.plain_lines(rows), strict=True)}


def test_filters_miss_no_repeat():
    r = np.random.default_rng(3)
    h = r.integers(0, 1 << 64, 5000, dtype=np.uint64)
    filters = SeenTwice(10_000)
    filters.add(h, np.zeros(5000, dtype=bool))
    other = np.append(h[:1000], r.integers(0, 1 << 64, 4000, dtype=np.uint64))
    filters.add(other, np.arange(5000) == 4999)
    assert filters.suspected(h[:1000]).all() and filters.suspected(other[-1:]).all()
    assert filters.suspected(h[1000:]).mean() < 0.05


def groups_of(spark, rows, **options):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3, "text")
    return ordered(tuple(r) for r in J.jaccard_groups(docs, **options).collect())


def test_groups_equal_plain(spark):
    docs = A.frame(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = [(i, n, c) for (i, _), (n, c, _) in zip(rows, A.plain_groups(rows), strict=True)]
    assert ordered(tuple(r) for r in J.jaccard_groups(docs).collect()) == ordered(want)


def near_copies(seed, n=60):
    """Chains and stars of near copies around the limit, and unrelated texts with a common passage."""
    r = random.Random(seed)
    passage = A.prose(500, 30)
    rows = []
    for k in range(n):
        if k % 3 == 0:
            text = f"{A.prose(1000 + k, 40)} {passage} {A.prose(2000 + k, 40)}".split()
        else:
            text = list(rows[r.randrange(max(0, len(rows) - 8), len(rows))][1].split())
            for _ in range(r.randrange(4)):
                text[r.randrange(len(text))] = f"new{r.randrange(99)}"
            if r.random() < 0.3:
                text += A.prose(3000 + k, r.randrange(12)).split()
        rows.append((k * 7 % 101, " ".join(text)))
    return rows


@pytest.mark.parametrize("limit", [None, 3])
@pytest.mark.parametrize("seed", [1, 2])
def test_groups_of_near_copies(spark, monkeypatch, seed, limit):
    if limit:  # all regions but the smallest are joined in slices and rounds
        monkeypatch.setattr(J, "REGION_SETS", limit)
        monkeypatch.setattr(J, "PIVOTS", 2)
    rows = near_copies(seed)
    want = [(i, n, c) for (i, _), (n, c, _) in zip(rows, A.plain_groups(rows), strict=True)]
    assert groups_of(spark, rows) == ordered(want)


def test_large_regions_take_few_jobs(spark, monkeypatch):
    """A region's strays are looked at in rounds that grow, and a round's components take a few checkpoints."""
    made, cut = [], J.cut_lineage
    monkeypatch.setattr(J, "cut_lineage", lambda df: made.append(1) or cut(df))
    monkeypatch.setattr(J, "REGION_SETS", 3)
    monkeypatch.setattr(J, "PIVOTS", 1)
    words = iter(range(10_000))  # one passage makes a region of sets that do not link
    common = " ".join(f"w{next(words)}" for _ in range(40))
    rows = [(k, " ".join([common, *(f"w{next(words)}" for _ in range(24))])) for k in range(12)]
    rows += [(50 + k, text + f" end{k}") for k, (_, text) in enumerate(rows[:3])]
    want = [(i, n, c) for (i, _), (n, c, _) in zip(rows, A.plain_groups(rows, percent=50), strict=True)]
    assert groups_of(spark, rows, percent=50) == ordered(want)
    assert len(made) <= 40


@pytest.mark.parametrize("limit", [None, 2])
def test_components_equal_plain(spark, monkeypatch, limit):
    if limit:  # links do not fit a task
        monkeypatch.setattr(J, "LINKS_AT_ONCE", limit)
    r = random.Random(5)
    pairs = [(k, k + 1) for k in range(0, 20)] + [(r.randrange(30, 90), r.randrange(30, 90)) for _ in range(40)]
    pairs = [x if r.random() < 0.5 else x[::-1] for x in pairs]
    least = {k: k for x in pairs for k in x if x[0] != x[1]}
    for _ in least:
        for a, b in pairs:
            if a != b:
                least[a] = least[b] = min(least[a], least[b])
    frame = spark.createDataFrame([(bytes([a]), bytes([b])) for a, b in pairs], J.LINKS).repartition(5)
    got = sorted((x["set"][0], x["label"][0]) for x in J.components(frame).collect())
    assert got == sorted(least.items())


def test_other_widths_and_limits(spark):
    rows = near_copies(3, 40)
    for width, percent in ((1, 50), (3, 100)):
        want = [(i, n, c) for (i, _), (n, c, _) in zip(rows, A.plain_groups(rows, width, percent), strict=True)]
        assert groups_of(spark, rows, width=width, percent=percent) == ordered(want)


def test_one_document_of_each_group_stays(spark):
    docs = A.frame(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    kept = J.near_dedup(docs)
    assert kept.schema == docs.schema
    got = kept.collect()
    groups = A.plain_groups(rows)
    assert len(got) == len({tuple(m) for _, _, m in groups})
    for r in got:
        _, component, _ = next(g for g, x in zip(groups, rows, strict=True) if x == (r.doc_id, r.text))
        assert r.doc_id == component


@pytest.mark.parametrize("make", [substring_dedup, line_dedup, J.jaccard_groups, J.near_dedup])
def test_empty_tables(spark, make):
    assert make(A.empty(spark)).count() == 0
    blank = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert make(blank).count() == 2


def test_word_hashes_depend_on_the_word_alone(monkeypatch):
    import pyarrow as pa

    texts = ["a bb ccc", "ccc  bb\ta", "", None, "long" * 300 + " a"]

    def hashes():
        buf, offsets = W.buffers(pa.array(texts))
        starts, ends, firsts = W.spans(buf, offsets)
        return W.word_hashes(buf, starts, ends).tolist(), firsts.tolist()

    h, firsts = hashes()
    assert firsts == [0, 3, 6, 6, 6, 8]
    assert h[:3] == h[5:2:-1] and h[0] == h[7] and len(set(h)) == 4
    monkeypatch.setattr(W, "SLICE", 3)
    assert hashes()[0][:6] == h[:6]
