

from __future__ import annotations

from pyspark.sql import SparkSession

from .headed import HeadedSource
from .planes import PlaneSource
from .properties import PropertySource


def register(spark: SparkSession) -> None:
    """Makes the formats `planes`, `properties` and `headed` known to a session, and lets filters reach them."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    for source in (HeadedSource, PlaneSource, PropertySource):
        spark.dataSource.register(source)
