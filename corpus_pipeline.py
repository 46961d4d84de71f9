"""The curation of ``documents``, stage by stage.

Each stage takes (spark, docs, sf_dir) and works on all that the one before it kept; its
result is written as Parquet into the shared folder and read again as the next
one's documents.  All but the last return the columns of ``documents``; the last gives
each remaining document's token count and the hashes of its ids and of what they decode to.

    quality classifier      documents of low quality go
    language ID             documents in no recognisable language go
    SimHash near-dedup      one document of each group of near copies stays
    decontamination         documents that hold a benchmark item go
    byte-level BPE          what is left is encoded and decoded

A stage on an empty table returns an empty table with the same columns.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from picsift.llm.bpe import digests
from picsift.llm.langid import keep_known
from picsift.llm.quality import keep_good
from picsift.llm.simhash import keep_one
from picsift.llm.tiling import drop_contaminated
from picsift.session import ensure_checkpoint_dir


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every remaining document."""
    # workers that ran the earlier stages have less memory left than those of op7
    return digests(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), max_states=200_000)


STAGES = [
    ("quality classifier", keep_good),
    ("language ID", keep_known),
    ("SimHash near-dedup", keep_one),
    ("benchmark decontamination", drop_contaminated),
    ("byte-level BPE", encode),
]

#: SQL expresses neither the trained classifiers nor the tiling and the encoder;
#: tests/llm compares run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the rows of the last.  Stage tables lie in a folder of
    their own under spark.checkpoint.dir, so a lost executor costs its tasks only."""
    folder = f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        path = f"{folder}/{number}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
