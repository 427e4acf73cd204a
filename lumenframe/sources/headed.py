"""A Spark sink of the text files that external classifiers read: rows in parts, under a head that counts them.

Tasks write parts; the commit, which alone knows all rows, writes the head and the manifest, which
names the parts in order. `cat head part-...` in the manifest's order is the classifier's file, and no
row passes through the driver or a single task. A failed job leaves no head and no manifest, and its
parts are removed.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from .stores import kept_only, made, opened, put, whole


@dataclass
class Written(WriterCommitMessage):
    name: str
    place: int
    rows: int
    size: int
    crc32: int


class HeadedWriter(DataSourceArrowWriter):
    def __init__(self, path: str, head: str):
        self.path, self.head, self.job = path, head, f"parts-{uuid.uuid4().hex}"
        made(f"{path}/{self.job}")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        name = f"{self.job}/{uuid.uuid4().hex}"
        store, inner = opened(f"{self.path}/{name}")
        rows = size = crc = 0
        with store.open_output_stream(inner) as out:
            for batch in iterator:
                data = "".join(f"{line}\n" for line in batch.column("line").to_pylist()).encode()
                out.write(data)
                rows, size, crc = rows + batch.num_rows, size + len(data), zlib.crc32(data, crc)
        return Written(name, TaskContext.get().partitionId(), rows, size, crc)

    def commit(self, messages: list[Written]) -> None:
        parts = sorted((m for m in messages if m is not None and m.rows), key=lambda m: m.place)
        put(f"{self.path}/head", self.head.replace("{rows}", str(sum(m.rows for m in parts))).encode())
        put(f"{self.path}/manifest.json", json.dumps([vars(m) for m in parts]).encode())
        kept_only(f"{self.path}/{self.job}", {m.name.split("/")[1] for m in parts})

    def abort(self, messages: list[Written]) -> None:
        kept_only(f"{self.path}/{self.job}", set())


class HeadedSource(DataSource):
    """options: path, head ({rows} in it becomes the number of rows). Rows: line string, in the order of partitions."""

    @classmethod
    def name(cls) -> str:
        return "headed"

    def schema(self) -> str:
        return "line string"

    def writer(self, schema, overwrite: bool) -> HeadedWriter:
        return HeadedWriter(self.options["path"], self.options.get("head", ""))


def write_lines(lines: DataFrame, path: str, head: str, order: str) -> None:
    """Lines (line, and the column `order` that they are put in) under a head: a range of the order is a part."""
    lines.sparkSession.dataSource.register(HeadedSource)
    parts = int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    lines.repartitionByRange(parts, order).sortWithinPartitions(order).select("line").write.format("headed").option("path", path).option("head", head).mode("append").save()


def read_lines(spark: SparkSession, path: str) -> tuple[str, DataFrame]:
    """The head, and (part, line) of the parts that the manifest names."""
    parts = json.loads(whole(f"{path}/manifest.json"))
    head = whole(f"{path}/head").decode()
    if not parts:
        return head, spark.createDataFrame([], "part int, line string")
    rows = spark.read.text([f"{path}/{p['name']}" for p in parts]).select(F.element_at(F.split(F.input_file_name(), "/"), -1).alias("_name"), F.col("value").alias("line"))
    places = F.create_map(*(x for i, p in enumerate(parts) for x in (F.lit(p["name"].split("/")[1]), F.lit(i))))
    return head, rows.select(F.element_at(places, F.col("_name")).alias("part"), "line")


def dye_sequence_lines(seqs: DataFrame) -> DataFrame:
    """(line, pep_i) of an external classifier's dye sequences: pattern, its peptides, and the first of them, tab-separated. seqs: (dyeseq, pep_i); empty patterns are left out."""
    rows = seqs.filter("dyeseq <> ''").groupBy("dyeseq").agg(F.count("*").alias("n"), F.min("pep_i").alias("pep_i"))
    return rows.select(F.concat_ws("\t", "dyeseq", F.col("n").cast("string"), F.col("pep_i").cast("string")).alias("line"), "pep_i")


def radmat_lines(radmats: DataFrame, values: str = "radmat") -> DataFrame:
    """(line, row_i) of rows of signals: tab-separated numbers, channels side by side."""
    return radmats.select(F.array_join(F.transform(values, lambda x: x.cast("string")), "\t", "nan").alias("line"), "row_i")


def write_classifier_input(seqs: DataFrame, radmats: DataFrame, path: str, n_channels: int, n_cycles: int) -> None:
    """All that the classifier needs, prepared end to end: dye-seqs under channels and rows, radmats under cycles, channels and rows."""
    write_lines(dye_sequence_lines(seqs), f"{path}/dye-seqs.tsv", f"{n_channels}\n{{rows}}\n", "pep_i")
    write_lines(radmat_lines(radmats), f"{path}/radiometries.tsv", f"{n_cycles}\n{n_channels}\n{{rows}}\n", "row_i")
