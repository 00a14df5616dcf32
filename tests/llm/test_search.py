"""Ranked lexical search against a plain version."""

import math
import random
import re
from collections import Counter

import awkward as A
import pytest

from shelfmark.llm import ranked_search as R

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
ITEMS = "item_id long, text string, score long, rank string"


def plain_ranking(docs, items, k):
    """Rows (item_id, rank, doc_id, score) by counting everything."""
    held = [(d, Counter(TERM.findall(A.lower(t)))) for d, t in docs if d is not None]
    n = sum(1 for _, c in held if c)
    total = sum(sum(c.values()) for _, c in held)
    df = Counter(w for _, c in held for w in c)
    asked = {}
    for i, t in items:
        if i is not None:
            asked.setdefault(i, set()).update(TERM.findall(A.lower(t)))
    out = []
    for i, terms in asked.items():
        scores = []
        for d, c in held:
            size, score = sum(c.values()), 0
            for w in terms & set(c):
                weight = math.floor(1000 * math.log((2 * n + 2) / (2 * df[w] + 1)))
                m = 100 - 90 + (90 * size * n) // total
                score += weight * ((10**9 * c[w]) // (1000 * c[w] + 8 * m))
            if score > 0:
                scores.append((-score, d))
        out += [(i, r, d, -s) for r, (s, d) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out)


def found(spark, docs, items, k=10):
    docs = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    got = R.ranked_search(docs, spark.createDataFrame(items, "item_id long, text string"), k)
    return sorted(tuple(r) for r in got.select("item_id", "rank", "doc_id", "score").collect())


def corpus(seed, n):
    r = random.Random(seed)
    words = [f"w{int(r.paretovariate(0.7))}" for _ in range(3000)]
    docs = [(k, " ".join(r.choice(words) for _ in range(r.randrange(0, 60)))) for k in range(n)]
    docs += [(n + k, docs[k][1]) for k in range(0, n, 7)]  # ties
    items = [(k, " ".join(r.choice(words) for _ in range(r.randrange(0, 25)))) for k in range(40)]
    return docs, items


@pytest.mark.parametrize("group, run, k", [(256, 1 << 20, 10), (7, 1 << 20, 3), (256, 60, 10)])
def test_ranking_equals_plain(spark, monkeypatch, group, run, k):
    """However many groups and runs the items need."""
    monkeypatch.setattr(R, "GROUP_ITEMS", group)
    monkeypatch.setattr(R, "RUN_TERMS", run)
    docs, items = corpus(group + k, 300)
    assert found(spark, docs, items, k) == plain_ranking(docs, items, k)


def test_small_shards_prune_without_loss(spark, monkeypatch):
    """Shards smaller and larger than k, each with its own bounds."""
    ready = R.ready

    def small(session):
        ready(session)
        session.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "23")
        return session

    monkeypatch.setattr(R, "ready", small)
    docs, items = corpus(5, 400)
    assert found(spark, docs, items, 4) == plain_ranking(docs, items, 4)


def test_pruning_drops_documents_that_cannot_win():
    """The k-th best of an item bounds all others of the shard."""
    import numpy as np

    scores = np.array([[9, 7, 5, 0], [1, 0, 0, 0]])
    assert R._best(scores, 2).tolist() == [7, 0]
    assert R._best(scores, 5).tolist() == [0, 0]


def test_awkward_rows(spark):
    items = [(1, "The the RIVER, stone!", 1, "x"), (1, "one two", 2, None), (2, None, 3, "x"), (3, "", 4, "x"), (None, "one", 5, "x")]
    items += [(4, "日本語 Straße ÖL", 6, "x"), (5, "neverheard", 7, "x"), (6, A.texts()[18], 8, "x"), (6, A.texts()[18], 8, "x"), (7, "x" * 70_000, 9, "x")]
    got = R.ranked_search(A.frame(spark), spark.createDataFrame(items, ITEMS))
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    plain = plain_ranking([(r[0], r[1]) for r in A.rows()], [(r[0], r[1]) for r in items], 10)
    assert sorted(map(tuple, got.collect())) == plain
    assert {r[0] for r in plain} == {1, 4, 6, 7}


def test_empty_tables(spark):
    some = spark.createDataFrame([(1, "one", 1, "x")], ITEMS)
    assert R.ranked_search(A.empty(spark), some).collect() == []
    assert R.ranked_search(A.frame(spark), some.limit(0)).collect() == []
    no_terms = spark.createDataFrame([(1, "..."), (2, None)], "doc_id long, text string")
    assert R.ranked_search(no_terms, some).collect() == []
