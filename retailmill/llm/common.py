"""What the operators share: text columns, Arrow mapping, written tables, id ranges."""

from __future__ import annotations

import ctypes
import gc
import sys
from collections.abc import Callable, Iterator
from types import ModuleType
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

import retailmill
from retailmill.session import scratch_dir

# Mapping functions travel with their code, so workers need no copy of the package.
cloudpickle.register_pickle_by_value(retailmill)

#: Rows that a mapping function gets at once; bounds its temporary arrays.
ROWS_AT_ONCE = 256
#: Bytes of text that a mapping function gets at once, or one longer row.
CHARS_AT_ONCE = 500_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame, *more: str) -> DataFrame:
    """doc_id, text (null: empty) and the named columns; others of any name go."""
    return docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"), *more)


def written(df: DataFrame, purpose: str) -> DataFrame:
    """The rows, written to the shared folder and read back. Lineage ends here, and
    a lost executor costs no more than a read."""
    path = scratch_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Scratch:
    """Tables written to the shared folder on the way to a result, and discarded together
    once that is written itself."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def written(self, df: DataFrame, purpose: str) -> DataFrame:
        self.paths.append(scratch_dir(self.spark, purpose))
        df.write.parquet(self.paths[-1])
        return self.spark.read.schema(df.schema).parquet(self.paths[-1])

    def discard(self, keep: int = 0) -> None:
        """Deletes all tables but the last ``keep``."""
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        gone = self.paths[: len(self.paths) - keep]
        for path in gone:
            folder = self.spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(conf).delete(folder, True)
        self.paths = self.paths[len(gone) :]


def map_rows(df: DataFrame, make: Callable[[], Callable[..., dict]], schema: str) -> DataFrame:
    """Maps groups of rows in Arrow, bounded in rows and in bytes of text. ``make()`` is called
    once a task and gives the function, which gets a list for each column of df and returns
    lists or arrays for those of ``schema``."""
    arrow = to_arrow_schema(T.StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = make()
        for part in slices(batches):
            got = fn(*(c.to_pylist() for c in part.columns))
            yield pa.RecordBatch.from_arrays([pa.array(got[f.name], f.type) for f in arrow], schema=arrow)
        del fn
        give_back()

    return df.mapInArrow(run, schema)


def slices(batches: Iterator[pa.RecordBatch], rows: int = ROWS_AT_ONCE, chars: int = CHARS_AT_ONCE) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut so that each has a bounded number of rows and bytes of text, or is one longer row."""
    for batch in batches:
        sizes = np.zeros(batch.num_rows)
        for column in batch.columns:
            if pa.types.is_string(column.type) or pa.types.is_large_string(column.type):
                sizes += np.nan_to_num(pc.binary_length(column).to_numpy(zero_copy_only=False).astype(float))
        for a, b in slices_by_size(sizes, rows, chars):
            yield batch.slice(a, b - a)


def give_back() -> None:
    """At a task's end: returns freed memory to the system, which an idle worker would keep."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        return


def groups_of_rows(
    batches: Iterator[pa.RecordBatch], rows: int = 4 * ROWS_AT_ONCE, chars: int = CHARS_AT_ONCE
) -> Iterator[list[list]]:
    """The columns of Arrow batches as lists, a bounded number of rows and bytes of text at a time."""
    for part in slices(batches, rows, chars):
        yield [c.to_pylist() for c in part.columns]


def slices_by_size(sizes: np.ndarray, rows: int, most: int) -> Iterator[tuple[int, int]]:
    """Consecutive ranges of at most ``rows`` items whose sizes add up to at most ``most``,
    or of a single item."""
    total = np.concatenate([[0], np.cumsum(np.nan_to_num(sizes), dtype=np.int64)])
    a = 0
    while a < len(sizes):
        b = int(np.searchsorted(total, total[a] + most, side="right")) - 1
        b = min(max(b, a + 1), a + rows, len(sizes))
        yield a, b
        a = b


def held_out(doc_id: str | Column = "doc_id") -> Column:
    """crc32 of the id's text has remainder 2 by 4: never used for training."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(c.cast("string")) % 4 == 2, F.lit(False))


def sampled_ids(ids: DataFrame, rows: int) -> DataFrame:
    """At most ``rows`` different doc_ids, the same ones at every call: those whose
    hashes come first. Only ids are moved."""
    own = ids.select("doc_id").where("doc_id IS NOT NULL").distinct()
    return own.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)


def id_ranges(docs: DataFrame, ranges: int) -> list[int]:
    """Ascending doc_ids that cut the rows into at most ``ranges`` parts of about
    equal size; each is the first id of its part. Their number is bounded by the parameter."""
    cuts = docs.agg(F.percentile_approx("doc_id", [i / ranges for i in range(1, ranges)], 100 * ranges)).first()[0]
    return sorted(set(cuts or []))


def range_of(doc_id: Column, cuts: list[int]) -> Column:
    """Number of the part that holds an id: how many cuts are not above it. A null id
    is in part 0."""
    if not cuts:
        return F.lit(0)
    return F.coalesce(
        F.aggregate(F.lit(cuts).cast("array<bigint>"), F.lit(0), lambda n, c: n + (c <= doc_id).cast("int")), F.lit(0)
    )


def once_a_worker(key: str, make: Callable[[], Any]) -> Any:
    """What ``make()`` gives, kept for later tasks of the same Python worker: for
    vocabularies, which are read-only and of fixed size. One is kept at a time, so that a
    worker that goes on to another stage holds no more than that stage needs."""
    kept = sys.modules.setdefault("_retailmill_worker", ModuleType("_retailmill_worker")).__dict__.setdefault("kept", {})
    if key not in kept:
        kept.clear()
        kept[key] = make()
    return kept[key]
