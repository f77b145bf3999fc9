"""Helpers that several operators share: shared tables, code shipping, batches, bounded filters."""

from __future__ import annotations

import io
import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PACKAGE = Path(__file__).resolve().parents[1]
#: Most bytes and rows of one Arrow batch, since whole texts travel in them.
BATCH_BYTES, BATCH_ROWS = 2 << 20, 4096
#: Bits of a filter for each of its keys, and the least and most bits: 32 MB at most, whatever the input holds.
FILTER_ROOM, LEAST_BITS, MOST_BITS = 16, 1 << 20, 1 << 28
PAGE_BITS = 1 << 15

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends this package's source to the Python workers, once for each application."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as z:
        for p in sorted(PACKAGE.rglob("*.py")):
            z.write(p, f"{PACKAGE.name}/{p.relative_to(PACKAGE)}")
    folder = tempfile.mkdtemp()
    path = os.path.join(folder, "tidegauge_code.zip")
    with open(path, "wb") as f:
        f.write(data.getvalue())
    spark.sparkContext.addPyFile(path)
    _shipped.add(app)


def text_batches(spark: SparkSession) -> None:
    """Bounds the Arrow batches of the session, since whole texts travel in them."""
    ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def together(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """The rows of the batches in batches of some `size` bytes: a batch beyond that goes on alone."""
    held, n = [], 0
    for b in batches:
        if held and n + b.nbytes > size:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, n = [], 0
        held.append(b)
        n += b.nbytes
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def ragged(raw: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """The bytes between the bounds, as binary values."""
    return pa.Array.from_buffers(
        pa.binary(),
        len(bounds) - 1,
        [None, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(raw).view(np.uint8))],
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or one of our own in local mode."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = f"file:///tmp/checkpoints/{spark.sparkContext.applicationId}"
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def table_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/tables-{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def drop_tables(spark: SparkSession) -> None:
    """Removes all tables that this application has saved; results that still read them must be written first."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{shared_folder(spark)}/tables-{spark.sparkContext.applicationId}")
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def saved(df: DataFrame, name: str) -> DataFrame:
    """Writes df as a table in the shared folder and reads it again: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = table_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@dataclass(frozen=True)
class BitFilter:
    """Pages (_page, _map) of a one-hash filter of so many bits."""

    pages: DataFrame
    bits: int


def bit_filter(keys: DataFrame, key: Column, name: str = "filter") -> BitFilter:
    """A one-hash filter over `key`, saved in pages of 4 KB, with FILTER_ROOM bits for each row of keys.

    It has MOST_BITS at most. Beyond, more rows that aren't in pass, which are joined as any others that may be in:
    results don't depend on it.
    """
    keys = saved(keys.select(F.xxhash64(key).alias("_h")), name)
    n = keys.count()
    bits = min(max(LEAST_BITS, 1 << (FILTER_ROOM * n).bit_length()), MOST_BITS)
    at = F.pmod(F.col("_h"), F.lit(bits))
    pages = keys.select(
        F.floor(at / PAGE_BITS).cast("int").alias("_page"),
        (at % PAGE_BITS).cast("long").alias("_bit"),
    ).groupBy("_page").agg(F.bitmap_construct_agg("_bit").alias("_map"))
    return BitFilter(saved(pages, "pages"), bits)


def probed(rows: DataFrame, key: Column, own: BitFilter) -> DataFrame:
    """Adds `_hit`: whether the key may be among the filter's. The pages have a fixed bound, so they are broadcast."""
    at = F.pmod(F.xxhash64(key), F.lit(own.bits))
    found = rows.withColumn("_at", at).withColumn(
        "_page",
        F.floor(F.col("_at") / PAGE_BITS).cast("int"),
    ).join(F.broadcast(own.pages), "_page", "left")
    byte = F.conv(F.hex(F.expr(f"substring(_map, cast((_at % {PAGE_BITS}) div 8 as int) + 1, 1)")), 16, 10).cast("int")
    hit = F.coalesce(F.getbit(byte, (F.col("_at") % 8).cast("int")), F.lit(0)) == 1
    return found.withColumn("_hit", hit).drop("_page", "_map", "_at")


def maybe_in(rows: DataFrame, key: Column, own: BitFilter) -> DataFrame:
    return probed(rows, key, own).filter("_hit").drop("_hit")


def crc_mod(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % n


def without_ids(docs: DataFrame, id_col: str, gone: DataFrame) -> DataFrame:
    """The rows of docs whose id isn't in gone (one column of distinct longs); rows with a null id stay.

    A bounded filter of the ids lets almost all rows that stay pass unmoved; only the others are joined.
    """
    gone = saved(gone.toDF("_gone"), "gone")
    own = bit_filter(gone, F.col("_gone"), "gone")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(id_col).cast("long").alias("id"))
    marked = probed(rows, F.coalesce("id", F.lit(0)), own)
    doubtful = marked.filter("_hit").join(gone, F.col("id") == F.col("_gone"), "left_anti")
    return marked.filter("not _hit").select("row.*").unionByName(doubtful.select("row.*"))
