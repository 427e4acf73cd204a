"""What the corpus operators share: table loading, cutting lineage, size-checked joins."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word everywhere in this subpackage: a run without ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

#: Rows up to which a small side is broadcast; beyond it the join shuffles.
BROADCAST_ROWS = 200_000
#: Bytes up to which a side of unequal rows is broadcast, and tasks that share a hot key beyond it.
BROADCAST_BYTES, SALTS = 32_000_000, 16
#: Rows whose texts are Python objects in a worker at once.
PART = 500


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share. Where the session names none, a local run gets one of its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        folder = f"file://{tempfile.mkdtemp(prefix='lumenframe-')}"
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Writes df to the shared folder and reads it back: cuts the lineage, and survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def join_small(left: DataFrame, right: DataFrame, on, how: str = "left") -> DataFrame:
    """Joins with a broadcast if right, which must be materialized, is proven small; else by a shuffle."""
    few = right.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    return left.join(F.broadcast(right) if few else right, on, how)


def join_hot(left: DataFrame, right: DataFrame, on: list[str], how: str = "left") -> DataFrame:
    """As join_small for a right side without repeated keys; by a shuffle, a key's rows on the left are dealt over SALTS tasks."""
    if right.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        return left.join(F.broadcast(right), on, how)
    salted = left.withColumn("_salt", F.pmod(F.xxhash64(*left.columns), F.lit(SALTS)))
    copies = right.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    return salted.join(copies, [*on, "_salt"], how).drop("_salt")


def join_by_host(left: DataFrame, right: DataFrame, size: Column) -> DataFrame:
    """Left join with right, which must be materialized and has one row a host, by host.

    right is broadcast if the sizes of its rows are proven small; else a host's rows are dealt over SALTS
    tasks, each with a copy of its one row on the right.
    """
    if (right.agg(F.sum(size)).first()[0] or 0) <= BROADCAST_BYTES:
        return left.join(F.broadcast(right), "host", "left")
    salted = left.withColumn("_salt", F.pmod(F.xxhash64(*left.columns), F.lit(SALTS)))
    copies = right.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    return salted.join(copies, ["host", "_salt"], "left").drop("_salt")


def n_words(text) -> "F.Column":
    """Number of words of a string column; null counts as empty."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def in_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All rows of the batches in order, at most PART at once: a worker keeps its largest size, so it should hold no whole batch as Python objects."""
    for batch in batches:
        for at in range(0, batch.num_rows, PART):
            yield batch.slice(at, PART)
