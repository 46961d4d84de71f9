"""run() against the stages' definitions applied one document at a time."""

import base64
import hashlib

import public_tokenizers
import tiktoken

import __spark_entry__ as entry
import corpus_pipeline
from picsift.llm import langid, quality, tiling

from test_simhash import grouped, naive

SF = "/root/testdata/sf0.001"


def test_pipeline_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = docs.collect()
    model = quality.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    rows = [r for r, s in zip(rows, model.scores([r.text for r in rows])) if s >= quality.THRESHOLD]
    ids = [r.doc_id for r in rows]
    assert 0 < len(rows) < docs.count()
    known = langid.fit(docs.filter(docs.doc_id.isin(ids)))
    rows = [r for r in rows if known.predict(r.text)[0] != "und" and known.predict(r.text)[1] >= langid.MIN_SCORE]
    group = grouped({naive(r.text) for r in rows})
    first = {}
    for r in sorted(rows, key=lambda r: r.doc_id):
        first.setdefault(group[naive(r.text)], r)
    items = [tiling.tokens(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]

    def clean(text):
        words = tiling.tokens(text)
        return all(sum(n for _, _, n in tiling.tiles(i, words)) < tiling.COVERAGE * len(i) for i in items)

    rows = [r for r in first.values() if clean(r.text)]
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    bpe = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    want = sorted((r.doc_id, len(x), sha(" ".join(map(str, x))), sha(r.text)) for r in rows for x in [bpe.encode_ordinary(r.text)])
    got = corpus_pipeline.run(spark, SF)
    assert sorted(map(tuple, got.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect())) == want


def test_registered_names():
    names = entry.queries()
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11))
    assert set(entry.oracle_sql()) <= set(names)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "language ID", "SimHash near-dedup", "benchmark decontamination", "byte-level BPE"]


def test_pipeline_on_odd_and_empty_tables(spark, tmp_path):
    from helpers import empty_docs, odd_docs, prose

    labels = spark.createDataFrame([(1, 1, 0), (4, 1, 0), (None, 0, None), (9, None, 1), (7, 1, 0)], "doc_id long, quality int, toxic int")
    bench = spark.createDataFrame([(1, prose(2, 30)), (None, None), (3, "")], "item_id long, text string")
    for name, docs in (("odd", odd_docs(spark, clashes=True)), ("empty", empty_docs(spark))):
        docs.write.parquet(f"{tmp_path}/{name}/documents.parquet")
        (labels if name == "odd" else labels.limit(0)).write.parquet(f"{tmp_path}/{name}/labels.parquet")
        (bench if name == "odd" else bench.limit(0)).write.parquet(f"{tmp_path}/{name}/benchmark.parquet")
    rows = corpus_pipeline.run(spark, f"{tmp_path}/odd").collect()
    assert {r.doc_id for r in rows} <= {1, 4, 5, 7, 9, None} and len(rows) >= 2
    empty = corpus_pipeline.run(spark, f"{tmp_path}/empty")
    assert empty.count() == 0 and empty.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    for name in ("op1_document_fingerprints", "op2_sharding", "op3_quality_classifier", "op4_benchmark_decontamination",
                 "op5_language_id", "op6_simhash_near_dedup", "op7_byte_bpe", "op8_token_counts"):
        assert entry.queries()[name](spark, f"{tmp_path}/empty").count() == 0
        assert entry.queries()[name](spark, f"{tmp_path}/odd").count() >= 0
