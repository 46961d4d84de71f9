import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from picsift.llm import langid, quality
from picsift.llm.textvec import cuts

from helpers import empty_docs, odd_docs, prose

SF = "/root/testdata/sf0.01"


def fold(i, n):
    return zlib.crc32(str(i).encode()) % n


@pytest.fixture(scope="module")
def scored(spark):
    return {r.doc_id: r for r in quality.op3_quality(spark, SF).collect()}


def test_quality_on_held_out_labels(spark, scored):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert scored.keys() == {r.doc_id for r in docs.select("doc_id").collect()}
    assert all(r.held_out == (fold(i, 5) == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for i, r in scored.items())
    held = [r for r in spark.read.parquet(f"{SF}/labels.parquet").collect() if fold(r.doc_id, 5) == 0]
    assert np.mean([scored[r.doc_id].predicted == r.quality for r in held]) > 0.95
    good, bad = ([scored[r.doc_id].score for r in held if r.quality == q] for q in (1, 0))
    assert np.mean([a > b for a in good for b in bad]) > 0.97


def test_quality_never_learns_from_held_out_labels(spark, scored):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    turned = labels.withColumn("quality", F.when(quality.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    again = quality.score(docs, quality.fit(docs, turned), keep=["doc_id"]).collect()
    assert all(abs(scored[r.doc_id].score - r.score) < 1e-6 for r in again)


def test_cosine_votes_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = quality.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"), most=100)
    assert 50 < len(model.labels) <= 100
    texts = [r.text for r in docs.limit(40).collect()]
    for text, score in zip(texts, model.scores(texts)):
        v = model.latent([quality.features(text)])[0]
        cosines = sorted(((float(v @ model.vectors[:, i]), model.labels[i]) for i in range(len(model.labels))), key=lambda x: -x[0])[:quality.NEIGHBOURS]
        weight = [max(c, 0) ** quality.POWER for c, _ in cosines]
        assert abs(score - sum(w * y for w, (_, y) in zip(weight, cosines)) / sum(weight)) < 1e-3


def test_quality_odd_rows(spark, tmp_path):
    docs = odd_docs(spark, clashes=True)
    labels = spark.createDataFrame([(1, 1, 0), (4, 0, 0), (4, 1, 0), (None, 0, None), (9, None, 1), (10, 0, 0), (7, 1, 0), (8, 1, 1)],
                                   "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    rows = quality.score(docs, quality.fit(docs, labels), keep=["doc_id"], name="s").collect()
    assert len(rows) == docs.count() and all(0 <= r.s <= 1 for r in rows)
    kept = quality.keep_good(spark, docs, str(tmp_path))
    assert kept.columns == docs.columns and kept.count() <= docs.count()
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.s for r in quality.score(docs, quality.fit(docs, none), keep=["doc_id"], name="s").collect()} == {0.5}
    assert quality.keep_good(spark, empty_docs(spark), str(tmp_path)).count() == 0


@pytest.fixture(scope="module")
def languages(spark):
    return {r.doc_id: r for r in langid.op5_language(spark, SF).collect()}


def test_language_on_held_out_rows(spark, languages):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert languages.keys() == {r.doc_id for r in docs}
    assert all(r.held_out == (fold(i, 4) == 2) and 0 <= r.score <= 1 for i, r in languages.items())
    held = [(languages[r.doc_id], r.lang) for r in docs if fold(r.doc_id, 4) == 2]
    right = np.array([p.lang_pred == lang for p, lang in held])
    assert right.mean() > 0.98
    assert abs(np.mean([p.score for p, _ in held]) - right.mean()) < 0.03       # calibrated


def test_language_never_learns_from_held_out_rows(spark, languages):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    turned = docs.withColumn("lang", F.when(langid.held_out(F.col("doc_id")), F.lit("xx")).otherwise(F.col("lang")))
    model = langid.fit(turned)
    assert "xx" not in model.languages
    assert all(languages[r.doc_id].lang_pred == r.lang_pred for r in langid.predict(docs, model, keep=["doc_id"]).collect())


def test_language_odd_rows(spark):
    docs = odd_docs(spark, clashes=True)
    rows = langid.predict(docs, langid.fit(docs), names=("l", "s")).collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert (r.l == "und" and r.s == 0) == (not any(c.isalpha() for c in r.text or ""))
    kept = langid.keep_known(spark, docs, "")
    assert kept.columns == docs.columns and all(any(c.isalpha() for c in r.text) for r in kept.collect())
    assert langid.keep_known(spark, empty_docs(spark), "").count() == 0
    unknown = langid.predict(docs, langid.fit(docs.withColumn("lang", F.lit(None).cast("string"))), keep=["doc_id"]).collect()
    assert {(r.lang_pred, r.score) for r in unknown} == {("und", 0.0)}


def test_weights_are_sparse(spark):
    model = langid.fit(spark.read.parquet(f"{SF}/documents.parquet"))
    assert (model.weights == 0).mean() > 0.5 and model.temperature > 0


def test_long_texts_in_portions():
    data = prose(1, 5000).encode()
    assert b"".join(cuts(data, 100)) == data and max(map(len, cuts(data, 100))) <= 100
    assert list(cuts(b"", 10)) == [b""] and b"".join(cuts(b"x" * 55, 10)) == b"x" * 55
