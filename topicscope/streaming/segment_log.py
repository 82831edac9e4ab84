"""Record log over shared files: segments in order, as a batch or a stream.

A log is a folder of segments, ``segment=<name>/``, each a set of parquet files
of records (key, value, timestamp, partition, offset).  Names grow with time,
so they are the log's order, whatever modification times the file system keeps;
the event time, partition and offset of a record are part of it.

:func:`publish` writes segments with a plain Spark job.  ``segment_log`` is a
Python data source that reads them:

* as a stream, its offset is the last segment's name, and a micro-batch takes at
  most ``segments`` (option) of those that follow, oldest first;
* as a batch, all segments.

Each file is one input partition, read by Arrow in the tasks.  A started query
finds where it is in its checkpoint's offset log (option ``checkpoint``), since a
data source is not told when it plans.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator, Sequence

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from ..operators.sequence import index_within

# Planning and reading run in Python workers; ship the source with the plan.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

FORMAT = "segment_log"
LOG_SCHEMA = "segment string, partition int, offset long, key string, value string, timestamp timestamp"
PREFIX = "segment="


def _place(path: str):
    """(file system, path in it) of a path or URI."""
    from pyarrow import fs
    if path.startswith("file:"):
        path = "/" + path[len("file:"):].lstrip("/")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def _names(path: str) -> list[str]:
    """The log's segments, in order."""
    from pyarrow import fs
    system, root = _place(path)
    found = system.get_file_info(fs.FileSelector(root, allow_not_found=True))
    return sorted(f.base_name[len(PREFIX):] for f in found if f.base_name.startswith(PREFIX))


def _files(path: str, names: Sequence[str]) -> list[InputPartition]:
    from pyarrow import fs
    system, root = _place(path)
    return [InputPartition((name, f.path)) for name in names
            for f in sorted(system.get_file_info(fs.FileSelector(f"{root}/{PREFIX}{name}")), key=lambda f: f.path)
            if f.base_name.endswith(".parquet")]


def _read(path: str, partition: InputPartition | None):
    import pyarrow as pa
    import pyarrow.parquet as pq
    if partition is None:
        return
    name, file = partition.value
    system, _ = _place(path)
    with system.open_input_file(file) as f:
        for batch in pq.ParquetFile(f).iter_batches(columns=["partition", "offset", "key", "value", "timestamp"]):
            time = batch.column("timestamp").cast(pa.timestamp("us", "UTC"), safe=False)
            columns = [pa.array([name] * batch.num_rows, pa.string()),
                       *(batch.column(c) for c in ("partition", "offset", "key", "value")), time]
            yield pa.RecordBatch.from_arrays(
                columns, names=["segment", "partition", "offset", "key", "value", "timestamp"])


class _Batch(DataSourceReader):
    def __init__(self, options):
        self.path = options["path"]

    def partitions(self):
        # an empty log is one empty partition
        return _files(self.path, _names(self.path)) or [InputPartition(None)]

    def read(self, partition) -> Iterator:
        return _read(self.path, partition if partition.value else None)


class _Stream(DataSourceStreamReader):
    def __init__(self, options):
        self.path = options["path"]
        self.limit = int(options.get("segments", "0"))
        self.last = _logged(options["checkpoint"]) if "checkpoint" in options else ""
        self.last = max(self.last, options.get("after", ""))
        self.begin = options.get("after", "")

    def initialOffset(self) -> dict:
        return {"segment": self.begin}

    def latestOffset(self) -> dict:
        # every offset handed out becomes a batch
        names = [n for n in _names(self.path) if n > self.last]
        if names:
            self.last = names[:self.limit or None][-1]
        return {"segment": self.last}

    def partitions(self, start: dict, end: dict):
        names = [n for n in _names(self.path) if start["segment"] < n <= end["segment"]]
        return _files(self.path, names) or [InputPartition(None)]

    def read(self, partition) -> Iterator:
        return _read(self.path, partition if partition.value else None)


def _logged(checkpoint: str) -> str:
    """The last segment in a checkpoint's offset log ('' if there is none)."""
    from pyarrow import fs
    system, root = _place(checkpoint)
    found = [f for f in system.get_file_info(fs.FileSelector(f"{root}/offsets", allow_not_found=True))
             if f.base_name.isdigit()]
    if not found:
        return ""
    with system.open_input_file(max(found, key=lambda f: int(f.base_name)).path) as f:
        lines = f.read().decode().split("\n")[2:]
    return next((json.loads(line)["segment"] for line in lines if '"segment"' in line), "")


class SegmentLog(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return LOG_SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Batch(self.options)

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _Stream(self.options)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """All records of the log."""
    spark.dataSource.register(SegmentLog)
    return spark.read.format(FORMAT).option("path", path).load()


def stream_log(spark: SparkSession, path: str, checkpoint: str, segments: int = 0,
               after: str = "") -> DataFrame:
    """The log's records as a stream, at most ``segments`` segments per micro-batch (0: no
    limit), from the one after ``after`` on."""
    spark.dataSource.register(SegmentLog)
    reader = spark.readStream.format(FORMAT).option("path", path).option("checkpoint", checkpoint) \
        .option("segments", str(segments))
    return (reader.option("after", after) if after else reader).load()


def publish(records: DataFrame, path: str, partitions: int = 1, order: Sequence[str] = ("key", "value")) -> None:
    """Write (segment, key, value, timestamp[, partition]) records to the log.

    A record without a partition gets one by its key; offsets count the records of a
    partition by segment, timestamp, then ``order``, blocks of times numbered apart, so no
    task holds a partition.  One job lands all the segments given; each is written whole."""
    given = F.col("partition") if "partition" in records.columns else F.lit(None)
    dealt = F.coalesce(given.cast("int"), F.pmod(F.crc32(F.coalesce(F.col("key"), F.lit("")).cast("binary")),
                                                 F.lit(partitions)).cast("int"))
    rows = records.select("segment", "key", "value", "timestamp", dealt.alias("partition"),
                          F.unix_micros("timestamp").alias("__us"),
                          *[F.col(c).alias(f"__o{i}") for i, c in enumerate(order)])
    ordered = [f"__o{i}" for i in range(len(order))]
    numbered = index_within(rows, ["partition"], ["segment", "__us", *ordered], block_on=["segment", "__us"],
                            block_size=900_000_000, index_col="offset")
    (numbered.drop("__us", *ordered).repartitionByRange("segment", "timestamp").sortWithinPartitions("segment", "timestamp")
     .write.partitionBy("segment").option("compression", "zstd").parquet(path))


def last_key(spark: SparkSession, path: str, default: str) -> DataFrame:
    """(last_key): key of the log's latest record, or the default one.  The listing names the
    last segment and only that is read: three columns, one row per task before the final one."""
    names = _names(path)
    schema = "offset long, key string, timestamp timestamp"
    if not names:
        return spark.range(1).select(F.lit(default).alias("last_key"))
    last = spark.read.schema(schema).parquet(f"{path.rstrip('/')}/{PREFIX}{names[-1]}")
    return last.agg(F.coalesce(F.max_by("key", F.struct("timestamp", "offset")), F.lit(default)).alias("last_key"))
