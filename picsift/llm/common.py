"""What the operators of this subpackage share: reading a table, texts from
Arrow batches in bounded portions, stored intermediate results."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ..session import cut_lineage

#: Most bytes of text that one call of a text function gets, unless one text has more.
PORTION = 4 << 20


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the folder of spark.checkpoint.dir,
    which the executors share: it survives the loss of executors."""
    return cut_lineage(df)


def fresh(name: str, taken: Iterable[str]) -> str:
    """``name``, with underscores before it as long as a column has it."""
    used = {c.lower() for c in taken}
    while name.lower() in used:
        name = "_" + name
    return name


def portions(column: pa.Array, most: int = PORTION) -> Iterator[tuple[int, list]]:
    """(first row, values) of consecutive rows of a string column."""
    import pyarrow.compute as pc

    sizes = pc.fill_null(pc.binary_length(column), 0).to_pylist()
    start = total = 0
    for i, n in enumerate(sizes):
        if i > start and total + n > most:
            yield start, column.slice(start, i - start).to_pylist()
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield start, column.slice(start).to_pylist()


def with_text_function(df: DataFrame, text: str, keep: list[str], fields: StructType,
                       make: Callable[[], Callable[[list], list[list]]]) -> DataFrame:
    """Columns ``keep`` of ``df`` and, for each row, what a function of its text
    gives.  ``make()`` runs in the task and returns a function from a list of texts
    (None: null) to one list for each of ``fields``.  No shuffle; rows stay in order.
    """
    text_at = fresh("text_of_row", keep)
    schema = StructType([*(df.schema[c] for c in keep), *fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        function, out = make(), to_arrow_schema(schema)
        for batch in batches:
            column = batch.column(len(keep))
            for first, texts in portions(column):
                got = function(texts)
                arrays = [batch.column(i).slice(first, len(texts)) for i in range(len(keep))]
                arrays = [a if a.type == out.field(i).type else a.cast(out.field(i).type) for i, a in enumerate(arrays)]
                arrays += [pa.array(v, type=out.field(len(keep) + i).type) for i, v in enumerate(got)]
                yield pa.RecordBatch.from_arrays(arrays, schema=out)

    return df.select(*keep, df[text].alias(text_at)).mapInArrow(run, schema)
