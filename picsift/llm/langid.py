"""Language identification (operator 5): sparse multinomial logistic regression
on TF-IDF character n-grams, trained by follow-the-regularised-leader with an
elastic-net penalty, then calibrated by a temperature.

Features are the 1- to 3-grams of the lower-cased letters of a text (everything
else is a space), hashed.  Document frequencies cover every document that may be
learned from; the weights are fitted on at most ``MAX_SAMPLE`` different texts,
spread over the languages, a fifth of which sets the temperature.  The model (4 weights for each
feature here) is broadcast; predicting needs no shuffle.

Defined results: ``und`` with score 0 for a null text or one without letters,
and for every text where there is nothing to learn from.  Rows with a null
language, or a null id, are predicted but not learned from.  Repeated rows give repeated rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from .common import fresh, read, with_text_function
from .textvec import Counts, Sample, gather, share, weighted

#: Labelled texts the model is fitted on, at most, over all languages.
MAX_SAMPLE = 6000
#: Different languages that can be learned.
MAX_LANGUAGES = 500
#: Follow-the-regularised-leader: learning rate, its smoothing, L1 and L2 penalty, passes.
ALPHA, BETA, L1, L2, EPOCHS = 0.5, 1.0, 0.05, 0.01, 3
#: Least confidence with which the pipeline keeps a document.
MIN_SCORE = 0.3
#: Characters of a text that are turned into features at a time.
CUT = 1 << 20

DIM = 1 << 13
_MIX = np.uint64(0x9E3779B97F4A7C15)
_letter: np.ndarray | None = None


def _letters() -> np.ndarray:
    global _letter
    if _letter is None:
        _letter = np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=bool, count=0x110000)
    return _letter


def features(text: str) -> Counts:
    """Square roots of the n-gram shares; no feature: no letters."""
    total = np.zeros(DIM, dtype=np.int64)
    for start in range(0, len(text), CUT):
        code = np.frombuffer(text[start:start + CUT].lower().encode("utf-32-le", "surrogatepass"), dtype="<u4")
        letter = _letters()[code]
        if not letter.any():
            continue
        code = np.concatenate([[32], np.where(letter, code, 32), [32]]).astype(np.uint64)
        letter = np.concatenate([[False], letter, [False]])
        two = (code[:-1] << np.uint64(21)) + code[1:]
        three = (two[:-1] << np.uint64(21)) + code[2:]
        grams = [code[letter], two[letter[:-1] | letter[1:]] + np.uint64(1 << 62),
                 three[(letter[:-2] & letter[1:-1]) | (letter[1:-1] & letter[2:])] + np.uint64(1 << 63)]
        at = (np.concatenate(grams) * _MIX) >> np.uint64(64 - 13)
        total += np.bincount(at.astype(np.int64), minlength=DIM)
    idx = np.flatnonzero(total)
    return idx, np.sqrt(total[idx] / max(int(total.sum()), 1))


def _softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray      # (DIM + 1, languages); the last row is the bias
    temperature: float = 1.0

    def logits(self, counts: Counts) -> np.ndarray:
        idx, v = weighted(counts, self.idf)
        return v @ self.weights[idx] + self.weights[-1]

    def predict(self, text: str | None) -> tuple[str, float]:
        counts = features(text or "")
        if not len(counts[0]) or not self.languages:
            return "und", 0.0
        p = _softmax(self.logits(counts) / self.temperature)
        best = int(p.argmax())
        return self.languages[best], round(float(p[best]), 6)


def train(sample: Sample, epochs: int = EPOCHS, seed: int = 11) -> Model:
    """FTRL-proximal over the sample in a seeded order, then the temperature
    that minimises the log loss of the texts set aside."""
    languages = sorted(set(sample.targets))
    model = Model(languages, sample.idf, np.zeros((DIM + 1, len(languages)), dtype=np.float64))
    number = {x: i for i, x in enumerate(languages)}
    usable = [i for i, v in enumerate(sample.vectors) if len(v[0])]
    aside = [i for i in usable if zlib.crc32(sample.keys[i].encode()) % 5 == 0]
    learn = [i for i in usable if zlib.crc32(sample.keys[i].encode()) % 5] or usable
    z, n, w = np.zeros_like(model.weights), np.zeros_like(model.weights), model.weights
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in rng.permutation(learn):
            idx, v = weighted(sample.vectors[i], model.idf)
            at, x = np.append(idx, DIM), np.append(v, 1.0)
            error = _softmax(x @ w[at])
            error[number[sample.targets[i]]] -= 1
            g = x[:, None] * error
            root = np.sqrt(n[at])
            n[at] += g * g
            grown = np.sqrt(n[at])
            z[at] += g - (grown - root) / ALPHA * w[at]
            pull = z[at]
            w[at] = np.where(np.abs(pull) > L1, (np.sign(pull) * L1 - pull) / ((BETA + grown) / ALPHA + L2), 0.0)
    if aside and len(languages) > 1:
        logits = np.array([model.logits(sample.vectors[i]) for i in aside])
        truth = np.array([number[sample.targets[i]] for i in aside])

        def loss(log_t: float) -> float:
            p = _softmax(logits / np.exp(log_t))
            return float(-np.log(np.maximum(p[np.arange(len(truth)), truth], 1e-12)).mean())

        low, high, golden = -3.0, 3.0, (5 ** 0.5 - 1) / 2
        for _ in range(40):
            a, b = high - golden * (high - low), low + golden * (high - low)
            low, high = (low, b) if loss(a) < loss(b) else (a, high)
        model.temperature = float(np.exp((low + high) / 2))
    return model


def held_out(doc_id: Column) -> Column:
    """Rows that are never learned from."""
    return F.crc32(doc_id.cast("string")) % 4 == 2


def fit(df: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id", most: int = MAX_SAMPLE) -> Model:
    rows = df.select(F.col(doc_id).alias("row_id"), F.col(lang).alias("row_lang"), F.col(text).alias("row_text"))
    usable = F.col("row_id").isNotNull() & F.col("row_lang").isNotNull() & ~held_out(F.col("row_id"))
    counts = rows.filter(usable).groupBy("row_lang").count().limit(MAX_LANGUAGES + 1).collect()
    if len(counts) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    each = most / max(len(counts), 1)
    taken = F.lit(False)
    for r in counts:
        taken = taken | ((F.col("row_lang") == r.row_lang) & share(F.col("row_id"), min(1.0, each / r["count"]), 5))
    sample = gather(rows.filter(usable), F.col("row_text"), F.when(taken, F.col("row_lang")), F.lit(True),
                    lambda: features, DIM, most)
    return train(sample)


_FIELDS = ("lang_pred", "score")


def predict(df: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None,
            names: tuple[str, str] = _FIELDS) -> DataFrame:
    """Columns ``keep`` (all by default), the predicted language and its calibrated probability."""
    keep = df.columns if keep is None else keep
    sent = df.sparkSession.sparkContext.broadcast(model)
    fields = StructType([StructField(names[0], StringType()), StructField(names[1], DoubleType())])

    def make() -> Callable:
        def run(texts: list) -> list[list]:
            got = [sent.value.predict(t) for t in texts]
            return [[x[0] for x in got], [x[1] for x in got]]
        return run

    return with_text_function(df, text, keep, fields, make)


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return (predict(docs, fit(docs), keep=["doc_id"])
            .select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score"))


def keep_known(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Stage: documents in a recognised language stay, with their columns; ``und`` and
    guesses below ``MIN_SCORE`` go."""
    names = tuple(fresh(n, docs.columns) for n in _FIELDS)
    known = predict(docs, fit(docs), names=names)
    return known.filter((F.col(names[0]) != "und") & (F.col(names[1]) >= MIN_SCORE)).select(*docs.columns)
