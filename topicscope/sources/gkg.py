"""Record scans: the typed TSV reader, the positional line reader, and a
record table built from the driver's star-schema tables.

Paths may be any Hadoop URI (local, HDFS, object store) and lists of paths or
globs; Spark splits the files and reads them in parallel, so no download step
exists.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import FIELD_SEPARATOR, drop_malformed, has_fields, nth_field
from ..functions.time import format_day, gkg_date_string
from ..schema import (ALL_NAMES_INDEX, DATE_INDEX, GKG_COLUMNS, GKG_DATE_FORMAT,
                      gkg_schema)
from ..session import path_exists, scratch_path
from .tables import load_table


def read_gkg(spark: SparkSession, paths: str | Sequence[str], quote: str = "") -> DataFrame:
    """Typed scan of 27-column tab-separated record files.

    Rows with fewer fields are padded with nulls, a date that does not parse
    becomes null, empty fields read as null.  ``quote=""`` turns quoting off:
    a field that starts with a double quote is read as written instead of
    swallowing the following tabs.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    return (spark.read.schema(gkg_schema())
            .option("sep", FIELD_SEPARATOR)
            .option("header", "false")
            .option("dateFormat", GKG_DATE_FORMAT)
            .option("quote", quote)
            .option("mode", "PERMISSIVE")
            .csv(paths))


def gkg_records(records: DataFrame) -> DataFrame:
    """(day, all_names) of the typed scan, rows with a null in either dropped.

    The predicate is a Column expression, so it is pushed into the scan and
    only the two columns are parsed.
    """
    return (records.select(F.col("DATE").alias("day"), F.col("AllNames").alias("all_names"))
            .where(F.col("day").isNotNull() & F.col("all_names").isNotNull()))


def read_lines(spark: SparkSession, paths: str | Sequence[str],
               tolerant: bool = True) -> DataFrame:
    """Plain text scan, one row per line (column ``value``).

    With ``tolerant`` bytes that are not valid UTF-8 are skipped rather than
    kept as replacement characters.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    lines = spark.read.text(paths)
    if tolerant:
        lines = lines.select(drop_malformed("value").alias("value"))
    return lines


def gkg_line_records(lines: DataFrame, min_fields: int = ALL_NAMES_INDEX + 1) -> DataFrame:
    """Positional (day, all_names) from raw lines.

    A line is kept when splitting it on tabs with trailing empty fields
    dropped gives more than 23 fields; the day is characters 1-8 of field 1
    written as ``yyyy-MM-dd``.  Fields are located by counting tabs, so no
    27-element array is built per line.
    """
    v = F.col("value")
    # trailing empty fields do not count: trim the trailing tabs, then look
    # for the (min_fields - 1)-th tab -- no copy of the line through translate
    body = F.rtrim(v, F.lit(FIELD_SEPARATOR))
    return (lines.where(has_fields(body, min_fields, FIELD_SEPARATOR))
            .select(format_day(nth_field(v, DATE_INDEX)).alias("day"),
                    nth_field(v, ALL_NAMES_INDEX).alias("all_names"))
            .where(F.col("day").isNotNull()))


# ---------------------------------------------------------------------------
# Record table derived from the driver tables.  There is no real record file
# among them, so one record per order is built from orders, lineitem and part:
# the order date is the record time and every line contributes the name of
# its part with the line number as the "offset" (``name,offset`` pairs joined
# by ``;``), the same shape as the AllNames column.
# ---------------------------------------------------------------------------

def gkg_like(spark: SparkSession, sf_dir: str) -> DataFrame:
    """record_id, record_time (timestamp_ntz), day (date), all_names."""
    orders = load_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    lineitem = load_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey",
                                                             "l_linenumber")
    part = load_table(spark, sf_dir, "part").select("p_partkey", "p_name")
    pieces = (lineitem.join(part, lineitem.l_partkey == part.p_partkey)
              .select("l_orderkey",
                      F.struct("l_linenumber",
                               F.concat(F.col("p_name"), F.lit(","),
                                        F.col("l_linenumber").cast("string")).alias("piece"))
                      .alias("p")))
    packed = (pieces.groupBy("l_orderkey")
              .agg(F.array_sort(F.collect_list(F.when(F.col("p.piece").isNotNull(), F.col("p"))))
                   .alias("ps"))
              .select("l_orderkey",
                      F.when(F.size("ps") > 0,
                             F.concat_ws(";", F.transform("ps", lambda s: s["piece"])))
                      .alias("all_names")))
    return (packed.join(orders, packed.l_orderkey == orders.o_orderkey)
            .select(F.concat(gkg_date_string("o_orderdate"), F.lit("-"),
                             F.col("o_orderkey").cast("string")).alias("record_id"),
                    F.col("o_orderdate").alias("record_time"),
                    F.col("o_orderdate").cast("date").alias("day"),
                    "all_names"))


def gkg_like_lines(like: DataFrame) -> DataFrame:
    """27-field tab-separated lines of the derived records (column ``value``)."""
    fields = []
    for i, _ in enumerate(GKG_COLUMNS):
        if i == 0:
            fields.append(F.col("record_id"))
        elif i == DATE_INDEX:
            fields.append(gkg_date_string("record_time"))
        elif i == 2:
            fields.append(F.lit("1"))
        elif i == ALL_NAMES_INDEX:
            fields.append(F.coalesce(F.col("all_names"), F.lit("")))
        else:
            fields.append(F.lit(""))
    return like.select(F.concat_ws(FIELD_SEPARATOR, *fields).alias("value"))


LIKE_FORMAT = "gkg-like-v1"
LINES_FORMAT = "gkg-lines-v1"
LIKE_SOURCES = ("orders", "lineitem", "part")
LIKE_SCHEMA = "record_id string, record_time timestamp_ntz, day date, all_names string"


def _source_stamp(spark: SparkSession, sf_dir: str, tables: Sequence[str]) -> str:
    """Sizes and modification times of the source tables (file-system metadata
    only), so a derived folder is rebuilt when its inputs change."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    parts = []
    for t in tables:
        p = jvm.org.apache.hadoop.fs.Path(f"{sf_dir.rstrip('/')}/{t}.parquet")
        fs = p.getFileSystem(conf)
        st = fs.getFileStatus(p)
        size = st.getLen() if st.isFile() else fs.getContentSummary(p).getLength()
        parts.append(f"{t}:{size}:{st.getModificationTime()}")
    return ",".join(parts)


def derived_path(spark: SparkSession, kind: str, fmt: str, sf_dir: str,
                 tables: Sequence[str], build, marker: str = "_SUCCESS") -> str:
    """A folder derived from the tables of ``sf_dir``, written once by
    ``build(path)`` (a distributed write) under the shared checkpoint folder
    and reused afterwards.  The folder name covers the input folder, the
    source tables' metadata and the format version.  Every build writes a
    folder of its own in there, so jobs that start together never overwrite
    what another one reads; one that did not finish has no ``marker`` file and
    is passed over."""
    key = f"{fmt}:{sf_dir.rstrip('/')}:{_source_stamp(spark, sf_dir, tables)}"
    path = scratch_path(spark, kind, hashlib.sha1(key.encode()).hexdigest()[:12])
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(hpath):
        for name in sorted(st.getPath().getName() for st in fs.listStatus(hpath)):
            if path_exists(spark, f"{path}/{name}/{marker}"):
                return f"{path}/{name}"
    own = f"{path}/{uuid.uuid4().hex}"
    build(own)
    return own


def gkg_like_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """:func:`gkg_like` written once as parquet and read back: the record
    table the topic queries scan, as a record file would be scanned."""
    path = derived_path(spark, "gkg_like", LIKE_FORMAT, sf_dir, LIKE_SOURCES,
                        lambda p: gkg_like(spark, sf_dir).write.mode("overwrite").parquet(p))
    return spark.read.schema(LIKE_SCHEMA).parquet(path)



def gkg_tsv_path(spark: SparkSession, sf_dir: str) -> str:
    """Record files for ``sf_dir`` in the shared checkpoint folder (27-field
    tab-separated lines of :func:`gkg_like_table`), written once."""
    return derived_path(
        spark, "gkg_tsv", LINES_FORMAT, sf_dir, LIKE_SOURCES,
        lambda p: gkg_like_lines(gkg_like_table(spark, sf_dir)).write.mode("overwrite").text(p))
