"""Shared helpers of the training-data operators."""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from topicscope.session import scratch_path

#: Words of the contracts: runs of anything but ASCII white space.
WORD_CLASS = r"[^\x20\x09-\x0D]+"

#: Entries a per-process word cache may hold before it starts afresh.
CACHE_WORDS = 200_000

#: Rows of whole texts that Spark hands to Python at once.
BATCH_ROWS = 1000


#: Folders of the staged tables that this process has written, in order.
_written: list[str] = []


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared checkpoint folder and read back.

    Cuts the lineage with files every executor can read, so a lost executor
    costs no recomputation of what lies before.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "llm", f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    _written.append(path)
    return spark.read.schema(df.schema).parquet(path)


def bounded_batches(df: DataFrame) -> DataFrame:
    """``df``, after lowering the session's Arrow batches to ``BATCH_ROWS`` rows.

    Rows here are whole texts: batches of Spark's default of 10,000 rows take
    tens of MB in the JVM and again in each Python worker.  A smaller setting
    stays as it is."""
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    rows = int(conf.get(key))
    if rows <= 0 or rows > BATCH_ROWS:
        conf.set(key, str(BATCH_ROWS))
    return df


def drop_staged(df: DataFrame) -> None:
    """Delete the files of a :func:`staged` table that nothing reads any more."""
    jvm = df.sparkSession.sparkContext._jvm
    conf = df.sparkSession.sparkContext._jsc.hadoopConfiguration()
    for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)


def final(make: Callable[[], DataFrame], name: str) -> DataFrame:
    """``make()`` staged under ``name``; the tables staged on the way to it, which
    nothing else reads, are deleted once it is written."""
    before = len(_written)
    out = staged(make(), name)
    jvm = out.sparkSession.sparkContext._jvm
    conf = out.sparkSession.sparkContext._jsc.hadoopConfiguration()
    for folder in _written[before:-1]:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)
    del _written[before:-1]
    return out


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc_mod(id_col: str, n: int) -> Column:
    """crc32 of the id's text modulo ``n`` (a null id counts as empty text)."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % n


class WordHashes(dict):
    """bytes -> 64-bit hash, computed once per distinct word."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h

    def array(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash: every input bit changes every output bit."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def shingle_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Hashes of the ``width``-word shingles; fewer words make one shingle of
    them all, no word makes none."""
    n = len(words)
    if n == 0:
        return words
    odd = np.uint64(0x9E3779B97F4A7C15)
    if n < width:
        # the length takes part: a short sequence never equals a full shingle
        h = np.array([n], np.uint64)
        for w in words:
            h = mix(h * odd + w)
        return h
    h = np.zeros(n - width + 1, np.uint64)
    for i in range(width):
        h = mix(h * odd + words[i:n - width + 1 + i])
    return h


def crc32_text(value) -> int:
    return zlib.crc32(str(value).encode())


def sliced(batches: Iterable[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The batches in slices of at most ``rows`` rows (bounded work space)."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def blocks(batches: Iterable[pa.RecordBatch], size: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """The rows in blocks of about ``size`` bytes (a longer row is a block of its
    own or ends one); no block is empty."""
    held, held_bytes = [], 0
    for part in sliced(batches, 64):
        if held and held_bytes + part.nbytes > size:
            yield pa.concat_batches(held)
            held, held_bytes = [], 0
        held.append(part)
        held_bytes += part.nbytes
    if held:
        yield pa.concat_batches(held)


def without(docs: DataFrame, names: Iterable[str], *inputs: str) -> DataFrame:
    """``docs`` without the columns that an operator's output replaces (the
    operator's own ``inputs`` stay readable)."""
    return docs.drop(*(set(names) - set(inputs)))
