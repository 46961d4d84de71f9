"""Quality classifier by nearest-neighbour voting (operator 3).

Texts become latent-semantic vectors: hashed TF-IDF of character-class trigrams
(how a text is written), folded words (what it says) and immediate word repeats, projected on
the leading singular vectors of a bounded labelled sample.  The sample's vectors
and labels are broadcast; every document's cosine to every one of them is
computed exactly, block by block, and the ``k`` nearest vote with weights that
follow their similarity.

Bounds: at most ``MAX_SAMPLE`` labelled texts (6000 x 64 floats, 1.5 MB) and the
projection (``DIM`` x 64 floats, 1 MB) are broadcast, whatever the corpus.  Document frequencies
cover every document.  No shuffle of texts: the sampled label rows, bounded too, are
broadcast to the scan.

Defined results: null, empty and featureless texts get the sample's mean label
as their score; without any labelled row every score is 0.5.  Labels with a null
id or quality are left out; several labels of one id are averaged and rounded, 1
on a tie.  Repeated rows give repeated rows.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .common import fresh, read, with_text_function
from .textvec import Counts, Sample, cuts, gather, share, weighted, words_of

#: Labelled texts the model is fitted on, at most.
MAX_SAMPLE = 6000
#: Latent dimensions, neighbours that vote, power of the similarity in a vote.
LATENT, NEIGHBOURS, POWER = 64, 21, 4
#: A document with a lower score is of low quality.
THRESHOLD = 0.3
#: Documents whose cosines are computed at a time.
BLOCK = 256

_STYLE, _WORDS = 2048, 2048
DIM = _STYLE + _WORDS + 1
_MIX = np.uint64(0x9E3779B97F4A7C15)
_PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def _classes() -> np.ndarray:
    """Byte -> 1 small letter or part of a non-ASCII character, 2 capital, 3 digit, 4 space,
    5 line end, 6 other control, 7 and up each punctuation sign."""
    out = np.full(256, 1, dtype=np.int64)
    out[:33] = 6
    out[127] = 6
    out[ord(" ")], out[ord("\n")] = 4, 5
    out[ord("A"):ord("Z") + 1] = 2
    out[ord("0"):ord("9") + 1] = 3
    for i, c in enumerate(_PUNCTUATION):
        out[ord(c)] = 7 + i
    return out


_CLASS = _classes()

def _bucket(values: np.ndarray, size: int) -> np.ndarray:
    return ((values * _MIX) >> np.uint64(65 - size.bit_length())).astype(np.int64)


def features(text: str) -> Counts:
    """Square roots of each term's share in its block of terms."""
    style, words = np.zeros(_STYLE, dtype=np.int64), np.zeros(_WORDS, dtype=np.int64)
    repeats = 0
    last = None
    for part in cuts(text.encode("utf-8", "surrogatepass")):
        data = np.frombuffer(part, dtype=np.uint8)
        if len(data) >= 3:
            k = _CLASS[data]
            style += np.bincount(_bucket((k[:-2] << 12 | k[1:-1] << 6 | k[2:]).astype(np.uint64), _STYLE), minlength=_STYLE)
        word, _ = words_of(data)
        if len(word):
            words += np.bincount(_bucket(word, _WORDS), minlength=_WORDS)
            repeats += int((word[1:] == word[:-1]).sum()) + (word[0] == last)
            last = word[-1]
    total = int(words.sum())
    parts = [style / max(int(style.sum()), 1), words / max(total, 1), [repeats / max(total, 1)]]
    dense = np.concatenate(parts)
    idx = np.flatnonzero(dense)
    return idx, np.sqrt(dense[idx])


@dataclass
class Model:
    idf: np.ndarray          # (DIM,)
    basis: np.ndarray        # (DIM, latent)
    vectors: np.ndarray      # (latent, sample), unit columns
    labels: np.ndarray       # (sample,)

    def latent(self, counts: list[Counts]) -> np.ndarray:
        """Unit rows; a text without features has a zero row."""
        out = np.zeros((len(counts), self.basis.shape[1]), dtype=np.float32)
        for i, c in enumerate(counts):
            idx, v = weighted(c, self.idf)
            out[i] = v @ self.basis[idx]
        n = np.linalg.norm(out, axis=1, keepdims=True)
        return np.divide(out, n, out=np.zeros_like(out), where=n > 1e-6)

    def scores(self, texts: list[str | None], k: int = NEIGHBOURS, power: int = POWER) -> list[float]:
        if not len(self.labels):
            return [0.5] * len(texts)
        prior = float(self.labels.mean())
        out: list[float] = []
        for start in range(0, len(texts), BLOCK):
            rows = self.latent([features(t or "") for t in texts[start:start + BLOCK]])
            cosines = rows @ self.vectors
            k = min(k, cosines.shape[1])
            near = np.argpartition(-cosines, k - 1, axis=1)[:, :k]
            weight = np.maximum(np.take_along_axis(cosines, near, axis=1), 0).astype(np.float64) ** power
            total = weight.sum(axis=1)
            score = np.where(total > 0, (weight * self.labels[near]).sum(axis=1) / np.where(total > 0, total, 1), prior)
            score = np.where(rows.any(axis=1), score, prior)
            out += np.clip(np.round(score, 6), 0, 1).tolist()
        return out


def fit_sample(sample: Sample, latent: int = LATENT, seed: int = 7) -> Model:
    """Singular vectors of the sample's TF-IDF matrix by a randomised range finder."""
    idf = sample.idf
    matrix = np.zeros((len(sample.vectors), DIM), dtype=np.float32)
    for i, c in enumerate(sample.vectors):
        idx, v = weighted(c, idf)
        matrix[i, idx] = v
    labels = np.array([float(t) for t in sample.targets])
    latent = min(latent, *matrix.shape) if len(labels) else latent
    if not len(labels):
        return Model(idf, np.zeros((DIM, latent), dtype=np.float32), np.zeros((latent, 0), dtype=np.float32), labels)
    width = min(latent + 16, *matrix.shape)
    q = np.random.default_rng(seed).standard_normal((DIM, width)).astype(np.float32)
    for _ in range(3):
        q, _ = np.linalg.qr(matrix.T @ (matrix @ q))
    _, _, v = np.linalg.svd(matrix @ q, full_matrices=False)
    model = Model(idf, np.ascontiguousarray(q @ v.T[:, :latent]), np.zeros((latent, 0), dtype=np.float32), labels)
    model.vectors = np.ascontiguousarray(model.latent(sample.vectors).T)
    return model


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned from."""
    return F.crc32(doc_id.cast("string")) % 5 == 0


def fit(df: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", label: str = "quality",
        most: int = MAX_SAMPLE) -> Model:
    """Learn from the rows of ``labels`` that are not held out; document
    frequencies are those of all rows of ``df``."""
    usable = (labels.select(F.col(doc_id).alias("label_id"), F.col(label).alias("label"))
              .filter(F.col("label_id").isNotNull() & F.col("label").isNotNull() & ~held_out(F.col("label_id"))))
    n = usable.select("label_id").distinct().count()
    taken = (usable.filter(share(F.col("label_id"), min(1.0, most / max(n, 1)), 3))
             .groupBy("label_id").agg((F.avg("label") >= 0.5).cast("int").alias("label")))
    # about ``most`` rows of (id, label), whatever the size of the tables
    rows = df.select(F.col(doc_id).alias("row_id"), F.col(text).alias("row_text")).join(
        F.broadcast(taken), F.col("row_id") == F.col("label_id"), "left")
    sample = gather(rows, F.col("row_text"), F.col("label"), F.lit(True), lambda: features, DIM, most)
    return fit_sample(sample)


def score(df: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None,
          name: str = "score") -> DataFrame:
    """Columns ``keep`` (all by default) and the score of each row's text."""
    keep = df.columns if keep is None else keep
    sent = df.sparkSession.sparkContext.broadcast(model)

    def make() -> Callable:
        return lambda texts: [sent.value.scores(texts)]

    return with_text_function(df, text, keep, StructType([StructField(name, DoubleType())]), make)


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    scored = score(docs, fit(docs, read(spark, sf_dir, "labels")), keep=["doc_id"])
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Stage: documents whose score reaches the threshold stay, with their columns."""
    name = fresh("score", docs.columns)
    scored = score(docs, fit(docs, read(spark, sf_dir, "labels")), name=name)
    return scored.filter(F.col(name) >= THRESHOLD).select(*docs.columns)
