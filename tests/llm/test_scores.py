import math
import random
import re
from collections import Counter
from fractions import Fraction

import awkward as A
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from shelfmark.llm import lm_scoring as L
from shelfmark.llm import quality_rules as Q
from shelfmark.llm import topk_search as K
from shelfmark.llm import toxicity as X

# Toxicity ----------------------------------------------------------------------------------------

BAD = ["grubble", "snarkish", "vilefop"]


def labelled(n=400):
    r = random.Random(3)
    docs, labels = [], []
    for k in range(n):
        words = A.prose(k, 40).split()
        toxic = k % 4 == 0
        if toxic:
            for _ in range(3):
                words[r.randrange(40)] = r.choice(BAD) + r.choice(["", "s", "ing", "ED", "!"])
        docs.append((k, " ".join(words)))
        labels.append((k, int(toxic)))
    return docs, labels


def test_held_out_documents_are_told_apart(spark):
    docs, labels = labelled()
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    labels = spark.createDataFrame(labels, "doc_id long, toxic int")
    index = X.fit(docs, labels, ~X.held_out())
    assert not any(X_held(i) for i in index.ids.tolist())
    rows = X.toxicity(docs, index).where(X.held_out()).join(labels, "doc_id").collect()
    assert len(rows) > 40
    assert sum((r.score >= 0.5) != (r.toxic == 1) for r in rows) <= 1
    assert all(e.toxic in (0, 1) and 0 < e.similarity <= 1 for r in rows for e in r.evidence)


def X_held(id):
    import zlib

    return zlib.crc32(str(id).encode()) % 5 == 0


def plain_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain_scores(docs, examples, labelled):
    """Scores by the definition: `examples` are (text, label), `labelled` the labelled rows of either label."""
    df = Counter(w for text in docs for w in set(plain_words(text)))
    counts = [Counter(plain_words(text)) for text, _ in examples]
    n = Counter(y for _, y in examples)
    held = {y: Counter(w for c, (_, z) in zip(counts, examples, strict=True) if z == y for w in c) for y in (0, 1)}

    def weight(w):
        a, b, c, d = held[1][w] + 0.5, n[1] - held[1][w] + 0.5, held[0][w] + 0.5, n[0] - held[0][w] + 0.5
        sure = abs(math.log(a * d / (b * c))) - 2 * math.sqrt(1 / a + 1 / b + 1 / c + 1 / d)
        return (math.log((1 + len(docs)) / (1 + df[w])) + 1) * (0.3 + max(0, sure))

    weights = {w: weight(w) for c in counts for w in c}

    def unit(c):
        v = {w: (1 + math.log(x)) * weights[w] for w, x in c.items() if w in weights}
        norm = math.sqrt(sum(x * x for x in v.values()))
        return {w: x / norm for w, x in v.items()}

    vectors = [unit(c) for c in counts]
    stands = [labelled[y] / max(1, n[y]) for y in (0, 1)]
    scores = []
    for text in docs:
        q = unit(Counter(plain_words(text)))
        near = sorted((-min(1, round(sum(x * v.get(w, 0) for w, x in q.items()), 12)), y) for v, (_, y) in zip(vectors, examples, strict=True))
        votes = [0.0, 0.0]
        for c, y in [(-c, y) for c, y in near[:15] if c < 0]:
            votes[y] += c * c / (1 - c + 0.001) * stands[y]
        prior = 0.05 * sum(stands) / 2
        tie = len(near) > 15 and near[15][0] == near[14][0] < 0
        scores.append((None if tie else (prior * labelled[1] / sum(labelled) + votes[1]) / (prior + sum(votes))))
    return scores


def test_scores_are_those_of_the_definition(spark):
    docs, labels = labelled()
    docs += [(400 + k, text) for k, text in enumerate([None, "", "grubble", "zzz zzz", "GRUBBLE! vilefops " * 50, docs[0][1]])]
    some = [(i, y) for i, y in labels if not X_held(i)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    index = X.fit(frame, spark.createDataFrame(labels, "doc_id long, toxic int"), ~X.held_out())
    texts = dict(docs)
    wanted = plain_scores([text for _, text in docs], [(texts[i], y) for i, y in some], [sum(y == z for _, y in some) for z in (0, 1)])
    given = {r.doc_id: r.score for r in X.toxicity(frame, index).collect()}
    assert sum(w is not None for w in wanted) > 380
    for (k, _), w in zip(docs, wanted, strict=True):
        assert w is None or given[k] == pytest.approx(w, abs=1e-7)
    assert given[405] == pytest.approx(given[0], abs=1e-9)


def test_copies_of_toxic_examples_are_flagged_however_few_there_are(spark):
    docs = [(k, A.prose(k, 60)) for k in range(120)]
    docs += [(200 + k, docs[k][1]) for k in range(3)]
    labels = spark.createDataFrame([(k, int(k < 3)) for k in range(120)], "doc_id long, toxic int")
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    index = X.fit(frame.where("doc_id < 200"), labels, F.lit(True))
    flagged = {r.doc_id for r in X.toxicity(frame, index).collect() if r.score >= 0.5}
    assert flagged == {0, 1, 2, 200, 201, 202}


def test_documents_of_one_id_are_examples_of_their_own_within_the_bound(spark, monkeypatch):
    docs = spark.createDataFrame([(k // 3, f"{A.prose(k, 20)} tail") for k in range(30)] + [(0, f"{A.prose(0, 20)} tail")], "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(10)], "doc_id long, toxic int")
    index = X.fit(docs, labels, F.lit(True))
    assert Counter(index.ids.tolist()) == {k: 3 for k in range(10)}
    monkeypatch.setattr(X, "MAX_EXAMPLES", 7)
    index = X.fit(docs, labels, F.lit(True))
    assert index.toxic.tolist().count(0) == index.toxic.tolist().count(1) == 7
    monkeypatch.setattr(X, "MAX_BYTES", 1)
    assert len(X.fit(docs, labels, F.lit(True)).ids) == 2


@pytest.mark.parametrize("block, short", [(64, 1), (16, 90), (256, 256)])
@pytest.mark.parametrize("dense", [1, 6, 1000])
def test_block_max_search_is_exact(dense, block, short, monkeypatch):
    monkeypatch.setattr(X, "DENSE", dense)
    monkeypatch.setattr(X, "BLOCK", block)
    monkeypatch.setattr(X, "SHORT", short)
    monkeypatch.setattr(X, "PART", block)
    r = np.random.default_rng(5)
    rows = []
    for k in range(1000):
        at = np.sort(r.choice(40, r.integers(0, 8), False))
        rows.append((k, int(r.random() < 0.5), at, r.integers(1, 4, len(at))))
    df = np.bincount(np.concatenate([x[2] for x in rows]), minlength=40)
    index = X.build_index(X.Terms(np.arange(40, dtype=np.uint64)), df, 1000, rows, (900, 100))
    whole = np.zeros((len(index.ids), 40))
    whole[index.example, np.repeat(np.repeat(np.arange(40), np.diff(index.cuts)), np.diff(index.first))] = index.entry
    assert np.allclose((whole * whole).sum(axis=1), 1)
    for _ in range(200):
        at = np.sort(r.choice(40, 4, False))
        q = X.unit(np.zeros(4, dtype=np.int64), r.integers(1, 3, 4), index.weights[at])
        cosines = np.round(whole[:, at] @ q, 9)
        order = np.lexsort((np.arange(len(cosines)), -cosines))[:15]
        order = order[cosines[order] > 0]
        share = index.shares(np.zeros(4, dtype=np.int64), at, q, 1)[0]
        places, found = index.nearest(at, q, share, 15)
        assert np.allclose(found, cosines[order])
        near = cosines[order][-1]
        assert set(places[found > near + 1e-6].tolist()) == set(order[cosines[order] > near + 1e-6].tolist())


def test_terms_are_the_words_of_each_text(monkeypatch):
    texts = ["One, two-three!", "", None, "two", "straße 42", "two TWO"]
    whole = [(k, h) for first, o, x in X.terms(pa.array(texts)) for k, h in zip((o + first).tolist(), x.tolist(), strict=True)]
    monkeypatch.setattr(X, "SLICE_BYTES", 5)
    assert sorted(whole) == sorted((k, h) for first, o, x in X.terms(pa.array(texts)) for k, h in zip((o + first).tolist(), x.tolist(), strict=True))
    of = [{h for k, h in whole if k == n} for n in range(6)]
    assert [len(x) for x in of] == [3, 0, 0, 1, 2, 1]
    assert of[3] < of[0] and of[3] == of[5] and not of[4] & of[0]


def test_toxicity_of_awkward_documents(spark):
    docs, labels = labelled()
    labels = [*labels, (None, 1), (0, None), (1, 7), (2, 0), (2, 1), (10_000, 1)]
    labels = spark.createDataFrame(labels, "doc_id long, toxic int")
    index = X.fit(spark.createDataFrame(docs, "doc_id long, text string"), labels, F.lit(True))
    rows = X.toxicity(A.frame(spark).withColumnRenamed("seen", "score"), index).collect()
    assert len(rows) == len(A.rows())
    for r in rows:
        assert 0 <= r.score <= 1
        if not A.words_of(r.text):
            assert r.score == index.prior and r.evidence == []
    assert X.toxicity(A.empty(spark), index).count() == 0


def test_without_labels(spark):
    docs = A.frame(spark)
    none = spark.createDataFrame([], "doc_id long, toxic int")
    index = X.fit(docs, none, F.lit(True))
    assert {r.score for r in X.toxicity(docs, index).collect()} == {0.0}
    index = X.fit(A.empty(spark), spark.createDataFrame([(1, 1)], "doc_id long, toxic int"), F.lit(True))
    assert X.toxicity(docs, index).count() == docs.count()


# Quality rules -----------------------------------------------------------------------------------


def plain_measures(text):
    text = text or ""
    words, lines = A.words_of(text), [x for x in text.split("\n") if A.words_of(x)]
    places = {}
    for k in range(len(words) - 2):
        places.setdefault(tuple(words[k : k + 3]), []).append(k)
    repeated = {k + j for w in places.values() if len(w) > 1 for k in w for j in range(3)}
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(words), len(lines), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(repeated)


def plain_failed(m):
    n, lines, chars, symbols, dups, repeated = m
    fails = [n < 50, 100 * repeated > 50 * n, 10 * symbols > n, 2 * dups > lines, chars < 2 * n, chars > 12 * n]
    return sum(1 << k for k, x in enumerate(fails) if x)


def test_ledger_equals_plain(spark):
    docs = A.frame(spark)
    want = sorted(repr((r.doc_id, r.source, *(m := plain_measures(r.text)), plain_failed(m))) for r in docs.collect())
    ledger = Q.rule_ledger(docs)
    got = sorted(repr(tuple(r)) for r in ledger.select("doc_id", "source", *Q.MEASURES, "failed").collect())
    assert got == want
    assert "text" not in ledger.columns and ledger.columns.count("n_words") == 1
    assert Q.rule_ledger(A.empty(spark)).count() == 0


def test_policies_and_ablations(spark):
    ledger = Q.rule_ledger(A.frame(spark)).cache()
    rows = ledger.collect()
    for version, rules in Q.POLICIES.items():
        mask = Q.mask_of(rules)
        for r in Q.apply_policy(ledger, version).collect():
            assert r.kept == (r.failed & mask == 0) and r.base_failed == (r.failed & 3 != 0)
        found = {r.rule: (r.n_failed, r.n_failed_alone, r.n_kept_without) for r in Q.ablations(ledger, version).collect()}
        assert list(found) == list(rules)
        for name in rules:
            bit = Q.mask_of((name,))
            want = (
                sum(r.failed & bit != 0 for r in rows),
                sum(r.failed & mask == bit for r in rows),
                sum(r.failed & mask & ~bit == 0 for r in rows),
            )
            assert found[name] == want
    assert [r.n_failed for r in Q.ablations(ledger.limit(0)).collect()] == [0] * len(Q.RULES)


# Top-k search ------------------------------------------------------------------------------------


def plain_topk(rows, k, every):
    good = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out, asked = [], {}
    for i, v in sorted(good):
        if i % every == 0:
            asked.setdefault(i, v)
    for i, v in asked.items():
        scores = sorted((-sum(a * b for a, b in zip(v, w, strict=False)), j) for j, w in good if j != i)[:k]
        out += [(i, n, j, -s) for n, (s, j) in enumerate(scores, 1)]
    return sorted(out)


def vectors(n, dims, seed, spread=1.0):
    r = np.random.default_rng(seed)
    return [(k, [float(np.float32(x)) for x in r.normal(0, spread, dims)]) for k in range(n)]


@pytest.mark.parametrize("drop", [0, 2, 50])
def test_topk_equals_plain(spark, monkeypatch, drop):
    monkeypatch.setattr(K, "GROUP_QUERIES", 7)
    rows = vectors(300, 9, 1, 0.3)
    rows += [(1000 + k, rows[10][1]) for k in range(80)]  # a common vector
    rows += [(None, rows[0][1]), (2001, None), (2002, [None] * 9), (2003, [math.nan] * 9), (2004, [math.inf] * 9), (2010, []), (2020, [0.5, -0.5]), (20, rows[20][1])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    frame = frame.withColumn("score", F.lit("x")).withColumn("id", F.lit(1))
    found = K.topk_search(frame, F.col("vec_id") % 10 == 0, drop=drop)
    assert sorted(tuple(r) for r in found.collect()) == plain_topk(rows, 5, 10)


def test_topk_of_few_and_none(spark):
    schema = "vec_id long, embedding array<float>"
    asked = F.col("vec_id") % 50 == 0
    assert K.topk_search(spark.createDataFrame([], schema), asked).count() == 0
    assert K.topk_search(spark.createDataFrame([(1, [1.0])], schema), asked).count() == 0
    assert K.topk_search(spark.createDataFrame([(0, [1.0])], schema), asked).count() == 0
    few = K.topk_search(spark.createDataFrame([(0, [1.0]), (3, [1e30]), (2, [-1e30]), (4, [3e30])], schema), asked).collect()
    assert [(r.rank, r.vec_id, r.score) for r in few] == [(1, 4, 2**63 - 1), (2, 3, 2**63 - 1), (3, 2, -(2**63))]


def exact_score(a, b):
    whole = lambda x: math.floor(Fraction(x) * 256)
    return sum(whole(x) * whole(y) for x, y in zip(a, b))


@pytest.mark.parametrize("largest", [7e4, 1e7, 1e12, 1e200])
def test_large_components_are_exact(spark, largest):
    """Among ordinary vectors, with ties, near ties beyond a double's precision, and either sign."""
    rows = [(k, [float(x) for x in v]) for k, v in vectors(120, 4, 5, 3.0)]
    r = random.Random(3)
    rows += [(200 + k, [r.choice([-1, 1]) * largest * (1 + r.randrange(3) * 2.0**-45) for _ in range(4)]) for k in range(60)]
    rows += [(300, rows[130][1]), (301, rows[130][1]), (302, [0.0] * 4), (310, [largest])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    found = sorted(tuple(r) for r in K.topk_search(frame, F.col("vec_id") % 10 == 0).collect())
    expected, by_id = [], dict(rows)
    for q in sorted(i for i in by_id if i % 10 == 0):
        scored = sorted((-exact_score(by_id[q], v), i) for i, v in rows if i != q)[:5]
        expected += [(q, n, i, max(-(2**63), min(2**63 - 1, -s))) for n, (s, i) in enumerate(scored, 1)]
    assert found == expected


def test_components_beyond_24_bits(spark):
    rows = [(0, [1.0]), (1, [70000.0]), (2, [90000.0])]
    found = K.topk_search(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), F.col("vec_id") % 50 == 0).collect()
    assert [(r.rank, r.vec_id, r.score) for r in found] == [(1, 2, 5898240000), (2, 1, 4587520000)]


def test_order_keys_sort_as_numbers():
    r = random.Random(1)
    numbers = [r.choice([-1, 1]) * r.randrange(10 ** r.randrange(1, 60)) for _ in range(500)] + [0, 9, 10, -9, -10]
    assert sorted(numbers) == sorted(numbers, key=K.order_key)


# LM scoring --------------------------------------------------------------------------------------


def grammar(seed, n):
    """Words that depend on the one before."""
    r, out, at = random.Random(seed), [], 0
    for _ in range(n):
        at = (at * 7 + r.choice([1, 2])) % 40
        out.append(f"w{at}")
    return " ".join(out)


def windows(context, tokens):
    """A row in which every token stands amid its context, and where the tokens are."""
    half = context.shape[1] // 2
    row = np.column_stack([context[:, :half], tokens, context[:, half:]]).ravel()
    return row, np.arange(len(tokens)) * (2 * half + 1) + half


def test_gradient_step_raises_the_score():
    r = np.random.default_rng(1)
    net = L.Network.fresh(r.integers(1, 50, 70))
    context, tokens = r.integers(0, 71, (500, 2 * L.WINDOW)).astype(np.uint16), r.integers(0, 70, 500).astype(np.uint16)
    before = net.log_probs(*windows(context, tokens)).mean()
    for _ in range(20):
        net.step(*windows(context, tokens), 0.05)
    assert net.log_probs(*windows(context, tokens)).mean() > before + 0.05


def test_probabilities_sum_to_one():
    net = L.Network.fresh(np.arange(1, 71))
    context = np.tile(np.array([[3, 70, 5, 9]], dtype=np.uint16), (70, 1))
    total = np.exp(net.log_probs(*windows(context, np.arange(70, dtype=np.uint16)))).sum()
    assert abs(total - 1) < 1e-4


def plain_log_prob(net, tokens, k):
    """Log-probability of the k-th of a text's tokens, by loops over the network's weights in 64 bits."""
    total = net.hidden.astype(float)
    for o, d in enumerate(L.DISTANCES):
        word = int(tokens[k + d]) if 0 <= k + d < len(tokens) else net.size
        total = total + net.words[word].astype(float) @ net.places[o].astype(float)
    h = np.append(np.tanh(total), 1.0)
    rank = int(net.rank[tokens[k]])
    of = max(c for c in range(net.classes) if net.edges[c] <= rank)
    by_class = np.exp(net.of_class.astype(float) @ h)
    inside = np.exp(net.of_word[net.edges[of] : net.edges[of + 1]].astype(float) @ h)
    return math.log(by_class[of] / by_class.sum()) + math.log(inside[rank - net.edges[of]] / inside.sum())


def trained(seed, size=150, n=900):
    r = np.random.default_rng(seed)
    texts = [r.integers(0, size, k).astype(np.uint16) for k in (0, 1, 2, 3, 7, n, 0)]
    flat, firsts = np.concatenate(texts), np.cumsum([0, *map(len, texts)])
    net = L.Network.fresh(np.bincount(flat, minlength=size) ** 2)
    row, at = L.row_of(flat, firsts, size)
    for _ in range(3):
        net.step(row, at, 0.3)
    return net, texts, flat, firsts


def test_scores_equal_plain_recomputation(monkeypatch):
    monkeypatch.setattr(L, "BATCH", 100)
    net, texts, flat, firsts = trained(3)
    assert net.classes > 2
    got = np.concatenate([net.log_probs(*b) for b in L.batches_of(*L.row_of(flat, firsts, net.size))])
    plain = [plain_log_prob(net, t, k) for t in texts for k in range(len(t))]
    assert np.allclose(got, plain, atol=1e-4)


def test_step_follows_the_gradient():
    """Output biases move as finite differences say."""
    net, _, flat, firsts = trained(4, 60, 80)
    row, at = L.row_of(flat, firsts, net.size)
    before = net.weights.copy()
    for table, places in (("of_class", range(net.classes)), ("hidden", range(4))):
        for k in places:
            place = (k, L.HIDDEN) if table == "of_class" else k
            ends = []
            for shift in (-1e-2, 1e-2):
                net.weights[:] = before
                getattr(net, table)[place] += np.float32(shift)
                ends.append(net.log_probs(row, at).mean())
            net.weights[:] = before
            old = float(getattr(net, table)[place])
            net.step(row, at, 1e-2)
            moved = (float(getattr(net, table)[place]) - old) / (1e-2 * 8)
            net.weights[:] = before
            # the hidden layer is met after the output tables have moved by a small step
            assert abs(moved - (ends[1] - ends[0]) / 2e-2) < 2e-3


def test_overflowing_weights_are_shifted():
    net, texts, flat, firsts = trained(5, 60, 80)
    net.of_word *= 400
    net.of_class *= 400
    got = net.log_probs(*L.row_of(flat, firsts, net.size))
    assert np.isfinite(got).all() and (got <= 1e-3).all()


def test_vocabulary_counts_every_word(spark, monkeypatch):
    from shelfmark.llm import blocks

    monkeypatch.setattr(blocks, "BLOCK_BYTES", 700)
    texts = [grammar(k, 100) + f" rare{k}" for k in range(20)] + [None, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    vocabulary = L.learn_vocabulary(blocks.to_blocks(docs, "text"), "text")
    count = Counter(w for t in texts for w in A.words_of(t))
    assert vocabulary.counts.sum() == sum(count.values())
    h, _ = L.hashes_of(pa.array(list(count)))
    for word, token in zip(count, vocabulary.of(h).tolist(), strict=True):
        assert vocabulary.counts[token] >= count[word]
    assert len(vocabulary.hashes) == len(count)


def test_vocabulary_grows_and_shares_buckets_by_count(spark, monkeypatch):
    from shelfmark.llm import blocks

    monkeypatch.setattr(L, "WORDS", 10)
    monkeypatch.setattr(L, "WORDS_A_ROOT", 4)
    monkeypatch.setattr(L, "BUCKETS", 2)
    sizes = []
    for n in (100, 1600):
        texts = [" ".join(f"w{k}" for k in range(n)), " ".join(f"w{k}" for k in range(0, n, 2))]
        staged = blocks.to_blocks(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), "text")
        v = L.learn_vocabulary(staged, "text")
        sizes.append((len(v.hashes), len(v.once)))
        count = Counter(w for t in texts for w in t.split())
        h, _ = L.hashes_of(pa.array(list(count)))
        tokens, c = v.of(h), np.array(list(count.values()))
        share = np.exp(v.inside(tokens, c))
        for token in range(len(v.hashes), v.size):  # the words of a bucket, and those never met, make up all of it
            mine = tokens == token
            unseen = np.exp(v.inside(np.array([token]), np.array([0])))[0]
            assert c[mine].sum() == v.counts[token] and abs(share[mine].sum() + unseen - 1) < 1e-9
        assert (share[tokens < len(v.hashes)] == 1).all()
    assert sizes == [(40, 2), (160, 10)]


def test_rare_words_score_below_common_ones(spark, monkeypatch):
    monkeypatch.setattr(L, "WORDS", 4)
    monkeypatch.setattr(L, "BUCKETS", 2)
    monkeypatch.setattr(L, "WORDS_A_ROOT", 1)
    texts = [grammar(k, 300) for k in range(20)]
    junk = " ".join(f"junk{k}" for k in range(300))
    docs = spark.createDataFrame([*enumerate(texts), (500, junk)], "doc_id long, text string").coalesce(1)
    score = {r.doc_id: r.mean_log_prob for r in L.lm_scores(docs).collect()}
    assert score[500] < min(score[k] for k in range(20)) - 1


def test_order_of_words_counts(spark):
    texts = [grammar(k, 300) for k in range(120)]
    shuffled = grammar(500, 300).split()
    random.Random(1).shuffle(shuffled)
    rows = [*enumerate(texts), (500, grammar(500, 300)), (501, " ".join(shuffled))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    score = {r.doc_id: r.mean_log_prob for r in L.lm_scores(docs).collect()}
    assert score[500] > score[501] + 0.05


def test_scores_of_awkward_documents(spark):
    docs = A.frame(spark)
    rows = L.lm_scores(docs).collect()
    assert len(rows) == docs.count()
    assert sorted(r.n_tokens for r in rows) == sorted(len(A.words_of(r.text)) for r in docs.collect())
    for r in rows:
        assert (r.mean_log_prob is None) == (r.n_tokens == 0) and r.log_prob <= 0 and math.isfinite(r.log_prob)
        if r.n_tokens:
            assert abs(r.mean_log_prob * r.n_tokens - r.log_prob) < 1e-6 * max(1, abs(r.log_prob))
    assert L.lm_scores(A.empty(spark)).count() == 0
    assert [r.log_prob for r in L.lm_scores(spark.createDataFrame([(1, None)], "doc_id long, text string")).collect()] == [0.0]
