"""Token counts by separator scan (operator 8).

A token file is a flat row of fixed-width little-endian ids in which an
end-of-document id follows each document; there is no index.  Files are cut
into blocks that know nothing of documents:

1. each block is searched for the separator with one vectorised comparison and
   gives its number of tokens and the places of its separators;
2. a prefix scan over these summaries, by file and block, gives each block the
   number of tokens and separators before it and the place of the last separator before it;
3. from that each separator gets its document's number in the file, its first token
   and its token count, across block boundaries.

Only the places of separators (4 bytes a document) and one summary row for each block are
shuffled.  Blocks are bounded (``BLOCK`` tokens), so a file that ``write_tokens`` stores as
blocks is scanned by many tasks; ``blocks_of_files`` reads a flat file whole, in one task.

Defined results: a document without tokens counts 0; tokens after a file's last
separator are a last document that is not closed; an empty file or table gives no
row; a file whose length is no multiple of the id's width is an error, and so is a vocabulary
with the separator among its ids or with ids that the width can't hold.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..session import ensure_checkpoint_dir
from .bpe import _codec, _vocabulary, encode_texts
from .common import portions, read, stored

#: Tokens in a block; the end-of-document id and id type of the registered query's files.
BLOCK, END_OF_DOCUMENT, WIDTH = 1 << 20, 50256, "<u2"
#: States of the encoder's machine; the writer needs memory of its own.
STATES = 300_000


def blocks_of_files(spark: SparkSession, path: str, width: str = WIDTH, block: int = BLOCK) -> DataFrame:
    """(file, block, tokens) of flat token files under ``path`` (each below 2 GB)."""
    size = block * np.dtype(width).itemsize
    files = spark.read.format("binaryFile").load(path)
    numbers = F.sequence(F.lit(0).cast("long"), F.floor((F.col("length") - 1) / size))
    return (files.filter("length > 0").select(F.col("path").alias("file"), "content", F.explode(numbers).alias("block"))
            .select("file", "block", F.substring("content", (F.col("block") * size + 1).cast("int"), F.lit(size)).alias("tokens")))


def scan(blocks: DataFrame, separator: int = END_OF_DOCUMENT, width: str = WIDTH) -> DataFrame:
    """(file, block, n_tokens, ends): places of the separators in each block."""
    schema = f"file {blocks.schema['file'].dataType.simpleString()}, block bigint, n_tokens bigint, ends array<int>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, ends = [], []
            for raw in batch.column(2):
                ids = np.frombuffer(raw.as_buffer() if raw.is_valid else b"", dtype=width)
                n.append(len(ids))
                ends.append(np.flatnonzero(ids == separator).astype(np.int32))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1).cast(pa.int64()), pa.array(n, pa.int64()),
                                              pa.array(ends, pa.list_(pa.int32()))], names=["file", "block", "n_tokens", "ends"])

    return blocks.select("file", "block", "tokens").mapInArrow(run, schema)


def documents(scanned: DataFrame) -> DataFrame:
    """(file, ordinal, start, n_tokens, closed): every document of every file."""
    scanned = stored(scanned)
    order = Window.partitionBy("file").orderBy("block")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    sums = (scanned.select("file", "block", "n_tokens", F.size("ends").cast("long").alias("n_ends"),
                           F.try_element_at("ends", F.lit(-1)).alias("last_end"))
            .withColumn("first_token", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))
            .withColumn("first_ordinal", F.coalesce(F.sum("n_ends").over(before), F.lit(0)))
            .withColumn("own_end", F.col("first_token") + F.col("last_end"))
            .withColumn("end_before", F.coalesce(F.max("own_end").over(before), F.lit(-1)))
            .select("file", "block", "first_token", "first_ordinal", "own_end", "end_before", "n_tokens"))
    sums = stored(sums)
    closed = (scanned.filter(F.size("ends") > 0).select("file", "block", "ends").join(sums, ["file", "block"])
              .select("file", "first_token", "first_ordinal", "end_before", "ends", F.posexplode("ends").alias("i", "end"))
              .select("file", (F.col("first_ordinal") + F.col("i")).alias("ordinal"),
                      F.when(F.col("i") == 0, F.col("end_before")).otherwise(F.col("first_token") + F.get("ends", F.col("i") - 1)).alias("after"),
                      (F.col("first_token") + F.col("end")).alias("at"))
              .select("file", "ordinal", (F.col("after") + 1).alias("start"), (F.col("at") - F.col("after") - 1).alias("n_tokens"),
                      F.lit(True).alias("closed")))
    whole = (scanned.groupBy("file").agg(F.sum("n_tokens").alias("tokens"), F.sum(F.size("ends")).cast("long").alias("ordinal"))
             .join(sums.groupBy("file").agg(F.coalesce(F.max("own_end"), F.lit(-1)).alias("last")), "file"))
    rest = (whole.filter(F.col("last") + 1 < F.col("tokens"))
            .select("file", "ordinal", (F.col("last") + 1).alias("start"), (F.col("tokens") - F.col("last") - 1).alias("n_tokens"),
                    F.lit(False).alias("closed")))
    return closed.unionByName(rest)


def _check_ids(ranks: list[int], separator: int, width: str) -> None:
    """An id that wraps, or that is the separator, would split documents unseen."""
    largest = np.iinfo(np.dtype(width)).max
    if max(ranks, default=0) > largest or not 0 <= separator <= largest:
        raise ValueError(f"ids up to {max(ranks, default=0)} and the separator {separator} do not all fit {width}")
    if separator in ranks:
        raise ValueError(f"the separator {separator} is an id of the vocabulary")


def write_tokens(df: DataFrame, folder: str, path: str, text: str = "text", doc_id: str = "doc_id",
                 pattern: str = public_tokenizers.PATTERN, separator: int = END_OF_DOCUMENT, width: str = WIDTH,
                 block: int = BLOCK) -> DataFrame:
    """Encode a table into one flat token file for each of its partitions, stored as
    blocks: (file, block, tokens, doc_ids) - doc_ids names the documents that end in the
    block, in order, and is not read by the scan."""
    data = _vocabulary(df.sparkSession, path)
    _check_ids([int(line.split()[1]) for line in data.value.splitlines() if line.strip()], separator, width)
    kind = df.schema[doc_id].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        from pyspark.sql.pandas.types import to_arrow_type

        codec, file, number = _codec(data.value, pattern, STATES), f"part-{TaskContext.get().partitionId():05d}", 0
        held: list[np.ndarray] = []
        names: list = []           # (tokens up to and with the separator, doc_id), in the block to come
        total = 0
        types = [pa.string(), pa.int64(), pa.binary(), pa.list_(to_arrow_type(kind))]

        def pack(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal held, names, total, number
            flat = np.concatenate(held) if held else np.zeros(0, dtype=width)
            at = 0
            while total - at >= block or (last and at < total):
                end = min(total, at + block)
                done = [x for e, x in names if e <= end]
                names = names[len(done):]
                yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip((file, number, flat[at:end].tobytes(), done), types)],
                                                 names=["file", "block", "tokens", "doc_ids"])
                at, number = end, number + 1
            held, total = [flat[at:]], total - at
            names = [(e - at, x) for e, x in names]

        stop = np.array([separator], dtype=width)
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for first, texts in portions(batch.column(1)):
                for i, x in enumerate(encode_texts(codec, texts), first):
                    held += [x.astype(width), stop]
                    total += len(x) + 1
                    names.append((total, ids[i]))
                if total >= block:
                    yield from pack(False)
        yield from pack(True)

    schema = f"file string, block bigint, tokens binary, doc_ids array<{kind.simpleString()}>"
    df.select(doc_id, text).mapInArrow(run, schema).write.option("compression", "zstd").parquet(folder)
    return df.sparkSession.read.parquet(folder)


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, file, ordinal, n_tokens of every document, read from the token files."""
    folder = f"{ensure_checkpoint_dir(spark)}/tokens-{uuid.uuid4().hex}"
    blocks = write_tokens(read(spark, sf_dir, "documents"), folder, public_tokenizers.path("byte_bpe_50k.tiktoken"))
    found = documents(scan(blocks))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    names = (blocks.select("file", "block", "doc_ids")
             .withColumn("first", F.coalesce(F.sum(F.size("doc_ids")).over(before), F.lit(0)))
             .select("file", "first", F.posexplode("doc_ids").alias("i", "doc_id"))
             .select("file", (F.col("first") + F.col("i")).alias("ordinal"), "doc_id"))
    return found.join(names, ["file", "ordinal"]).select("doc_id", "file", "ordinal", "n_tokens")
