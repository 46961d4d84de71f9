"""Byte-level BPE encoding and decoding (operator 7).

``encode`` gives each text's ids, ``decode`` turns ids back into text and
``digests`` runs both and gives the counts and hashes of the contract.  Each works
on its rows alone: no shuffle.  The rank file is read once by the driver (a
vocabulary, under 1 MB here; ``MAX_VOCABULARY`` bounds it) and broadcast.

Defined results: a null text is an empty text (no ids); ids outside the
vocabulary fail; bytes that are not UTF-8 decode to U+FFFD.  Repeated rows give repeated
rows.  Texts of any length are encoded whole, in portions cut where the split
pattern cuts anyway.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Callable, Iterator

import numpy as np
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from .bpe_fst import WHITE, Codec, Decimals, Utf8Decoder, Vocabulary, stream
from .common import read, with_text_function

#: Largest rank file that is broadcast, in bytes.
MAX_VOCABULARY = 64 << 20
#: Characters of a text that are encoded at a time.
CUT = 1 << 20
#: States that a worker's machine learns before it starts anew: about 0.4 KB each, with their arcs.
STATES = 600_000

_made: dict[tuple[str, str, int], Codec] = {}
_cut_at = re.compile(f"(?<=[^{WHITE}]) (?=[^{WHITE}])")


def cut(text: str, size: int = CUT) -> Iterator[str]:
    """Portions of about ``size`` characters, cut before a single space between
    two words, where no pre-token goes on; a text without such a place stays whole."""
    start = 0
    while len(text) - start > size:
        m = _cut_at.search(text, start + size)
        if not m:
            break
        yield text[start:m.start()]
        start = m.start()
    yield text[start:] if start else text


def _vocabulary(spark: SparkSession, path: str):
    if os.path.getsize(path) > MAX_VOCABULARY:
        raise ValueError(f"{path} has more than {MAX_VOCABULARY} bytes")
    with open(path, "rb") as f:
        return spark.sparkContext.broadcast(f.read())


def _codec(data: bytes, pattern: str, max_states: int = STATES) -> Codec:
    """The worker's machine: what it has learned serves later tasks too."""
    key = (hashlib.sha256(data).hexdigest(), pattern, max_states)
    if key not in _made:
        _made[key] = Codec(Vocabulary(data), pattern, max_states)
    return _made[key]


def encode_texts(codec: Codec, texts: list[str | None]) -> list[np.ndarray]:
    """Ids of whole texts."""
    parts, owner = [], []
    for i, t in enumerate(texts):
        for p in cut(t or ""):
            parts.append(p)
            owner.append(i)
    if len(parts) == len(texts):
        return codec.encode_batch(parts)
    out: list[list[np.ndarray]] = [[] for _ in texts]
    for i, p in zip(owner, parts):
        out[i] += codec.encode_batch([p])
    return [np.concatenate(x) for x in out]


def encode(df: DataFrame, path: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",),
           pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """Columns ``keep`` and ``ids`` array<int>."""
    data = _vocabulary(df.sparkSession, path)

    def make() -> Callable:
        codec = _codec(data.value, pattern)
        return lambda texts: [[x.tolist() for x in encode_texts(codec, texts)]]

    return with_text_function(df, text, list(keep), StructType([StructField("ids", ArrayType(IntegerType()))]), make)


def decode(df: DataFrame, path: str, ids: str = "ids", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns ``keep`` and ``text``, read back from the ids as a stream."""
    import pyarrow as pa

    data = _vocabulary(df.sparkSession, path)
    schema = StructType([*(df.schema[c] for c in keep), StructField("text", StringType())])
    names = list(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(data.value, public_tokenizers.PATTERN)
        decoder = Utf8Decoder(codec.vocab)
        for batch in batches:
            texts = ["".join(stream(decoder, x.as_py() or [])) for x in batch.column(len(names))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, pa.string())], names=[*names, "text"])

    return df.select(*names, ids).mapInArrow(run, schema)


DIGESTS = StructType([StructField("n_tokens", LongType()), StructField("ids_sha256", StringType()),
                      StructField("decoded_sha256", StringType())])


def digests(df: DataFrame, path: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",),
            pattern: str = public_tokenizers.PATTERN, max_states: int = STATES) -> DataFrame:
    """Columns ``keep``, the number of ids, the hash of the ids as decimals
    joined by one space and the hash of what the ids decode to.  ``max_states`` bounds
    the memory of a worker's machine; results don't depend on it."""
    data = _vocabulary(df.sparkSession, path)

    def make() -> Callable:
        codec = _codec(data.value, pattern, max_states)
        decoder, decimals = Utf8Decoder(codec.vocab), Decimals(codec.vocab)

        def run(texts: list) -> list[list]:
            n, written, back = [], [], []
            for x in encode_texts(codec, texts):
                ids = x.tolist()
                n.append(len(ids))
                written.append(decimals.digest(ids))
                h = hashlib.sha256()
                for t in stream(decoder, ids, 1 << 16):
                    h.update(t.encode())
                back.append(h.hexdigest())
            return [n, written, back]

        return run

    return with_text_function(df, text, list(keep), DIGESTS, make)


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"))
