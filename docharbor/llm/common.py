"""What the operators share: columns by exact name, Arrow slices, word hashes, scratch tables."""

from __future__ import annotations

import pickle
import uuid
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast, cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docharbor.session import shared_dir

#: Bytes of text that a Python task holds as words at a time; one longer text is a slice of its own.
SLICE_BYTES = 1 << 20
#: Bytes that a batch of rows to a Python task may hold.
BATCH_BYTES = 4 << 20
_STEP = np.uint64(0x9E3779B97F4A7C15)


def pick(df: DataFrame, *names: str) -> DataFrame:
    """These columns by their exact name, whatever else the table has (even ``TEXT`` beside ``text``)."""
    places = {name: df.columns.index(name) for name in names}
    plain = df.toDF(*(f"_{i}" for i in range(len(df.columns))))
    return plain.select(*(F.col(f"_{i}").alias(name) for name, i in places.items()))


def whole(df: DataFrame, row: str, *names: str) -> DataFrame:
    """``names`` beside all columns packed into the struct ``row``; see :func:`unpack`."""
    plain = df.toDF(*(f"_{i}" for i in range(len(df.columns))))
    packed = F.struct(*(F.col(f"_{i}") for i in range(len(df.columns)))).alias(row)
    return plain.select(packed, *(F.col(f"_{df.columns.index(n)}").alias(n) for n in names))


def unpack(df: DataFrame, row: str, like: DataFrame, **changed) -> DataFrame:
    """The columns that :func:`whole` packed, some of them replaced."""
    return df.select(
        *(changed.get(n, F.col(f"{row}._{i}")).alias(n) for i, n in enumerate(like.columns))
    )


def apart(df: DataFrame, row: str, *names: str) -> DataFrame:
    """``names`` as columns, the others packed into the struct ``row``: nothing is held twice. See :func:`together`."""
    plain = df.toDF(*(f"_{i}" for i in range(len(df.columns))))
    places = {n: df.columns.index(n) for n in names}
    others = [F.col(f"_{i}") for i in range(len(df.columns)) if i not in places.values()]
    packed = F.struct(*(others or [F.lit(0).alias("_none")])).alias(row)
    return plain.select(packed, *(F.col(f"_{i}").alias(n) for n, i in places.items()))


def together(df: DataFrame, row: str, like: DataFrame, *names: str, **changed) -> DataFrame:
    """The columns that :func:`apart` parted, in their order, some of them replaced."""
    own = {like.columns.index(n): F.col(n) for n in names}
    own |= {like.columns.index(n): c for n, c in changed.items()}
    return df.select(*(own.get(i, F.col(f"{row}._{i}")).alias(n) for i, n in enumerate(like.columns)))


def bound_batches(spark: SparkSession) -> None:
    """Batches to Python hold ``BATCH_BYTES``, one longer row excepted, however long the texts are.

    A batch is held several times over, by the JVM and by Python, in every running task.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if not 0 < int(spark.conf.get(key).rstrip("b")) <= BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bound_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """``df`` written to the cluster's shared folder and read again: computed once, no lineage."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def shipped(spark: SparkSession, value) -> Broadcast:
    """A broadcast of any object, classes by value; a task reads it with :func:`received`."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(value))


def received(sent: Broadcast):
    return pickle.loads(sent.value)


def slices(batches: Iterator[pa.RecordBatch], column: str, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut so that ``column`` holds about ``size`` bytes at most, nulls as empty."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        block = np.cumsum(sizes.astype(np.int64)) // size
        cuts = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:], strict=False):
            yield batch.slice(a, b - a)


def texts(batch: pa.RecordBatch, column: str) -> list[bytes]:
    return [t or b"" for t in batch.column(column).to_pylist()]


def hashed(words: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of several texts in a row, and where each text begins and ends."""
    ends = np.zeros(len(words) + 1, np.int64)
    np.cumsum([len(w) for w in words], out=ends[1:])
    flat = chain.from_iterable(words)
    return np.fromiter(map(xxhash.xxh3_64_intdigest, flat), np.uint64, int(ends[-1])), ends


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def runs_of(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash of every ``size`` consecutive values, by start; empty if there are fewer."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(n, size, np.uint64)
    for j in range(size):
        out = out * _STEP + hashes[j : j + n]
    return mixed(out)


def inside(ends: np.ndarray, size: int) -> np.ndarray:
    """Which starts of ``size`` consecutive values stay within one text."""
    n = int(ends[-1]) - size + 1
    if n <= 0:
        return np.zeros(0, bool)
    last = np.repeat(ends[1:], np.diff(ends))[:n]
    return np.arange(n) + size <= last


def owner(ends: np.ndarray) -> np.ndarray:
    """The text that each word belongs to."""
    return np.repeat(np.arange(len(ends) - 1), np.diff(ends))


def covered(starts: np.ndarray, size: int, total: int) -> np.ndarray:
    """Which of ``total`` words lie in a window of ``size`` words that begins at one of ``starts``."""
    change = np.zeros(total + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, np.minimum(starts + size, total), -1)
    return np.cumsum(change[:-1]) > 0


def per_slice(column: str, make: Callable[[pa.RecordBatch], pa.RecordBatch | None], size: int = SLICE_BYTES):
    """A function for ``mapInArrow`` that calls ``make`` for each slice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, column, size):
            if (out := make(batch)) is not None and out.num_rows:
                yield out

    return run


def signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))
