"""Results of a run: a folder of Parquet tables and a manifest, both written through Spark."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class Results:
    """Tables by name, read when asked for; only the manifest is read at first."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        text = "".join(r.value for r in spark.read.text(f"{path}/manifest").collect())
        self.manifest = json.loads(text)

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in self.manifest["tables"]:
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.path}/{name}")

    def columns(self, name: str, wanted: list[str], missing_ok: bool = False) -> DataFrame:
        """Some columns of a table, and no others are read; missing ones are null if that is allowed, else an error."""
        table = getattr(self, name)
        absent = [c for c in wanted if c not in table.columns]
        if absent and not missing_ok:
            raise KeyError(f"{name} has no {absent}")
        return table.select(*(F.col(c) if c in table.columns else F.lit(None).alias(c) for c in wanted))

    @staticmethod
    def write(spark: SparkSession, path: str, tables: dict[str, DataFrame], by: dict[str, str] | None = None, **params) -> "Results":
        """by: the column that a table's folders go by, such as field_i."""
        for name, df in tables.items():
            writer = df.write.mode("overwrite")
            (writer.partitionBy(by[name]) if by and name in by else writer).parquet(f"{path}/{name}")
        manifest = json.dumps({"tables": sorted(tables), "params": params})
        spark.createDataFrame([(manifest,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/manifest")
        return Results(spark, path)
