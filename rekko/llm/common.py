"""Helpers shared by the corpus operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rekko.session import checkpoint_dir, cut_lineage, remove_table  # noqa: F401  (re-exported for the operators)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_type(docs: DataFrame, id_col: str) -> T.DataType:
    return docs.schema[id_col].dataType


def texts_only(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(id, text)`` under the caller's id name, null text as the empty one.

    Columns besides these two never reach an operator, so extra columns
    cannot clash with its own names.
    """
    return docs.select(F.col(id_col), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def map_texts(docs: DataFrame, id_col: str, text_col: str, fields: list[T.StructField],
              make: Callable[..., list[pa.Array]], slice_chars: int = 4_000_000, with_ids: bool = False) -> DataFrame:
    """One output row per document: the id and the columns ``make`` computes.

    ``make`` gets the texts of a slice of an Arrow batch (about
    ``slice_chars`` characters, one document at least), and their ids with ``with_ids``,
    and returns one Arrow array per field, so the memory of a task is bounded by the slice.
    """
    schema = T.StructType([T.StructField(id_col, id_type(docs, id_col)), *fields])
    names = [id_col, *(f.name for f in fields)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, slice_chars):
                ids = [part.column(0).to_pylist()] if with_ids else []
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *make(part.column(1).to_pylist(), *ids)], names=names)

    return texts_only(docs, id_col, text_col).mapInArrow(run, schema)


def slices(batch: pa.RecordBatch, limit: int) -> Iterator[pa.RecordBatch]:
    """Consecutive slices of a batch whose second column holds about ``limit`` bytes each."""
    import pyarrow.compute as pc

    if not batch.num_rows:
        return
    sizes = pc.binary_length(batch.column(1)).to_pylist()
    start, held = 0, 0
    for i, n in enumerate(sizes):
        if i > start and held + n > limit:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += n
    yield batch.slice(start)


class BoundedCache(dict):
    """A dictionary that computes missing values and keeps at most 2 x ``size`` of them.

    When ``size`` new entries have come in, they become the old generation
    and what was old before goes; an old entry that is asked for moves back.
    Frequent keys therefore stay while a long tail passes through.
    """

    def __init__(self, make: Callable, size: int = 200_000):
        super().__init__()
        self.make, self.size, self.old = make, size, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.size:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


NO_ID = 2 ** 63 - 1


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(``k``, ``t``, ``text``, ``row``): the id as an ordering key (a null id comes last), a
    hash of the text, which tells apart rows that repeat an id with another text, and
    the other columns as one struct, where their names cannot clash."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("k"),
                       F.xxhash64(text).alias("t"), text.alias("text"),
                       F.struct(*[c for c in docs.columns if c != text_col]).alias("row"))


# Paths of the tables that the operators have written for themselves, by application; see release().
_TABLES: dict[str, list[str]] = {}


def own_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared checkpoint folder for a table of an operator's own."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _TABLES.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def release(spark: SparkSession) -> int:
    """Delete the tables that operators have written in this application; returns how many.

    Call it when the results have been written: one that is still lazy reads them.
    """
    paths = _TABLES.pop(spark.sparkContext.applicationId, [])
    return sum(remove_table(spark, p) for p in paths)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared checkpoint folder and read it back.

    Like a checkpoint this cuts lineage and survives lost executors, but the
    columns are compressed.  The table stays until :func:`release`.
    """
    path = own_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
