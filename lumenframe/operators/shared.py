"""What operators share: written intermediate tables, and joins that broadcast only what is counted first."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows up to which a written side is broadcast, and tasks that share a key's rows beyond it.
FEW, SALTS = 200_000, 16
#: Rows of a task that keeps them sorted or in a table.
HELD = 1_000_000


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that driver and executors share; in a local run without one, in a temporary folder."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        folder = f"file://{tempfile.mkdtemp(prefix='lumenframe-')}"
    return f"{folder}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """df, written to the shared folder and read again: a round's result survives lost executors, and the next plan begins there."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dealt(rows: DataFrame, *keys: str) -> DataFrame:
    """rows, dealt by keys into so many tasks that none holds many more than HELD rows, whatever their size once packed; few rows are left as they are."""
    n = -(-rows.count() // HELD)
    return rows.repartition(n, *keys) if n > 1 else rows


def is_few(df: DataFrame, most: int = FEW) -> bool:
    return df.limit(most + 1).count() <= most


def join_counted(left: DataFrame, right: DataFrame, on, how: str = "left", most: int = FEW) -> DataFrame:
    """Joins with a broadcast of right, which should be cheap to count, if it has few rows; else by a shuffle."""
    return left.join(F.broadcast(right) if is_few(right, most) else right, on, how)


def join_salted(left: DataFrame, right: DataFrame, on: list[str], how: str = "left", most: int = FEW) -> DataFrame:
    """As join_counted for keys of which the left side may hold very many rows: by a shuffle, they are dealt over SALTS tasks.

    Spark takes the copies for as small as one of them, and would broadcast them.
    """
    if is_few(right, most):
        return left.join(F.broadcast(right), on, how)
    salted = left.withColumn("_salt", F.pmod(F.xxhash64(*left.columns), F.lit(SALTS)))
    copies = right.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    return salted.join(copies.hint("merge"), [*on, "_salt"], how).drop("_salt")
