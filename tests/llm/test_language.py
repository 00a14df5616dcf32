"""Language identification: triples and bundles against plain versions, held-out accuracy."""

import re

import awkward as A
import numpy as np
from pyspark.sql import functions as F

import __spark_entry__ as driver
from shelfmark.llm import language_id as L

SF_DIR = "/root/testdata/sf0.01"


def plain_triples(text):
    letters = "".join(c.lower() if len(c.lower()) == 1 and c.isalpha() else c if c.isalpha() else " " for c in text or "")
    words = re.sub(" +", " ", letters).strip(" ")
    padded = f" {words} "
    return [tuple(map(ord, padded[k : k + 3])) for k in range(len(padded) - 2)] if words else []


def plain_bundle(text):
    total = np.zeros(L.DIMS)
    for a, b, c in plain_triples(text):
        total += np.roll(L.letter_vector(a), 2) * np.roll(L.letter_vector(b), 1) * L.letter_vector(c)
    return total


def some_texts():
    return [*A.texts()[:18], *A.texts()[19:], "a", "a\x00b", "\x00", " \x00 x", "ÀÉÎ İß", "Ab1cd--ef", "é" * 5]


def test_triples_equal_plain():
    texts = some_texts()
    keys, owner = L.triples(texts)
    at = [[int(k) >> s & 0x1FFFFF for s in (42, 21, 0)] for k in keys]
    for k, t in enumerate(texts):
        assert [tuple(x) for x, o in zip(at, owner, strict=True) if o == k] == plain_triples(t), t
    assert L.triples([])[0].size == 0 and L.triples([None, ""])[0].size == 0


def test_bundles_equal_plain(monkeypatch):
    texts = [t for t in some_texts() if len(t or "") < 2000]
    keys, owner = L.triples(texts)
    expected = np.array([plain_bundle(t) for t in texts])
    assert np.array_equal(L.bundles(keys, owner, len(texts)), expected)


def test_predictions_equal_plain(spark):
    docs = A.frame(spark).withColumn("lang", F.expr("CASE pmod(doc_id, 3) WHEN 0 THEN 'aa' WHEN 1 THEN 'bb' END"))
    among = F.coalesce(F.col("doc_id") < 14, F.lit(False))
    learned = {r["lang"]: np.frombuffer(r["bundle"]) for r in L.learn(docs, among).collect()}
    expected = {}
    for doc_id, text, *_ in A.rows():
        if doc_id is not None and doc_id < 14 and text is not None and doc_id % 3 < 2:
            name = "aa" if doc_id % 3 == 0 else "bb"
            expected[name] = expected.get(name, 0) + plain_bundle(text)
    assert set(learned) == set(expected)
    for name, vector in expected.items():
        assert np.allclose(learned[name], vector)
    clashing = docs.withColumn("score", F.lit("old")).withColumn("Lang_Pred", F.lit(7))
    got = L.language_id(clashing, L.learn(docs, among))
    assert got.columns == [*A.frame(spark).columns, "lang_pred", "score"]
    rows = got.collect()
    assert len(rows) == len(A.rows())
    for r in rows:
        vector = plain_bundle(r["text"])
        if not plain_triples(r["text"]):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
            continue
        cosines = {n: v @ vector / max(1e-9, np.linalg.norm(v) * np.linalg.norm(vector)) for n, v in expected.items()}
        assert abs(r["score"] - min(1, max(0, max(cosines.values())))) < 1e-4
        assert cosines[r["lang_pred"]] > max(cosines.values()) - 1e-4
    by_text = {}
    for r in rows:
        assert by_text.setdefault(r["text"], (r["lang_pred"], round(r["score"], 5))) == (r["lang_pred"], round(r["score"], 5))


def test_nothing_learned_and_empty_tables(spark):
    none = L.learn(A.empty(spark), F.lit(True))
    assert none.collect() == []
    assert {r["lang_pred"] for r in L.language_id(A.frame(spark), none).collect()} == {"und"}
    assert L.language_id(A.empty(spark), L.learn(A.frame(spark), F.lit(True))).collect() == []


def test_held_out_accuracy(spark):
    """Labels of documents kept back are not used: changing them changes nothing."""
    got = driver.queries()["op12_language_id"](spark, SF_DIR)
    truth = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "lang", "text")
    rows = got.join(truth, "doc_id").where("held_out AND lang IS NOT NULL AND length(text) > 40").collect()
    assert len(rows) > 100
    assert np.mean([r["lang"] == r["lang_pred"] for r in rows]) > 0.98
    assert got.count() == truth.count()
