"""Image sources: which files are which field, channel and cycle, and their pixels."""

from __future__ import annotations

import io
import struct

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def scan(spark: SparkSession, path: str, pattern: str, names: tuple[str, ...] = ("field", "channel", "cycle")) -> DataFrame:
    """(path, field_i, channel_i, cycle_i): file names matched by the pattern's groups, in that order; names are numbered by size of number, then text.

    A name that doesn't match is an error.
    """
    files = spark.read.format("binaryFile").load(path).select("path")
    base = F.substring_index("path", "/", -1)
    checked = F.when(base.rlike(pattern), base).otherwise(F.raise_error(F.concat(F.lit("unexpected file name: "), base)).cast("string"))
    files = files.withColumn("_name", checked)
    for i, name in enumerate(names):
        files = files.withColumn(name, F.regexp_extract("_name", pattern, i + 1))
    for name in names:
        number = F.regexp_extract(name, r"(\d+)$", 1)
        order = Window.orderBy(F.when(number == "", F.lit(-1)).otherwise(number.cast("long")), name)
        files = files.withColumn(f"{name}_i", F.dense_rank().over(order) - 1)  # one row a file
    return files.select("path", *(f"{name}_i" for name in names))


def by_suffix(files: DataFrame) -> DataFrame:
    """Files in the order of the number that ends their names."""
    return files.orderBy(F.regexp_extract("path", r"(\d+)\.[^.]*$", 1).cast("long"), "path")


def read_arrays(spark: SparkSession, path: str) -> DataFrame:
    """(path, frame_i, height, pixels) of .npy files; a stack gives a row a frame."""

    def run(batches):
        for batch in batches:
            rows = []
            for p, content in zip(batch["path"], batch["content"], strict=True):
                image = np.load(io.BytesIO(content), allow_pickle=False)
                for i, frame in enumerate(image.reshape(-1, *image.shape[-2:])):
                    rows.append((p, i, frame.shape[0], frame.astype(np.float32).ravel()))
            yield pd.DataFrame(rows, columns=["path", "frame_i", "height", "pixels"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, "path string, frame_i int, height int, pixels array<float>")


def _numbers(frames: DataFrame) -> DataFrame:
    """(path, file_i): files in the order of the number that ends their names, then of their paths; one row a file, without pixels."""
    suffix = F.expr(r"try_cast(regexp_extract(path, '(\\d+)\\.[^.]*$', 1) as bigint)")
    return frames.select("path").distinct().withColumn("file_i", F.row_number().over(Window.orderBy(suffix.asc_nulls_first(), "path")) - 1)


def as_movie(frames: DataFrame) -> DataFrame:
    """A file is a field, its frames are cycles."""
    return frames.join(F.broadcast(_numbers(frames)), "path").withColumnsRenamed({"file_i": "field_i", "frame_i": "cycle_i"})


def as_z_stack(frames: DataFrame, n_slices: int) -> DataFrame:
    """Every n_slices frames of a file are a field; their number must divide evenly in every file, and fields count on from file to file."""
    sizes = frames.groupBy("path").agg(F.count("*").alias("n"))
    uneven = sizes.filter(F.col("n") % n_slices != 0).first()
    if uneven is not None:
        raise ValueError(f"{uneven['n']} frames of {uneven['path']} don't divide into stacks of {n_slices}")
    before = F.sum("n").over(Window.orderBy("file_i").rowsBetween(Window.unboundedPreceding, -1))
    begins = _numbers(frames).join(sizes, "path").withColumn("_begin", F.coalesce(before, F.lit(0)) / n_slices).select("path", F.col("_begin").cast("int").alias("_begin"))
    return frames.join(F.broadcast(begins), "path").withColumn("field_i", F.col("_begin") + F.floor(F.col("frame_i") / n_slices).cast("int")).withColumn("slice_i", F.col("frame_i") % n_slices).drop("_begin")


def by_field(frames: DataFrame, channels: dict[int, int] | None = None) -> DataFrame:
    """Frames that came cycle by cycle, gathered field by field: one shuffle. channels: numbers in the files to numbers wanted; others go."""
    if channels is not None:
        pairs = F.create_map(*(F.lit(x) for pair in channels.items() for x in pair))
        frames = frames.withColumn("channel_i", F.element_at(pairs, F.col("channel_i").cast("int"))).filter("channel_i is not null")
    return frames.repartition("field_i").sortWithinPartitions("field_i", "channel_i", "cycle_i")


def tif_pages(content: bytes) -> list[np.ndarray]:
    """The pages of an uncompressed grey TIFF file of 8, 16 or 32 bits."""
    order = {b"II": "<", b"MM": ">"}.get(content[:2])
    if order is None or struct.unpack_from(order + "H", content, 2)[0] != 42:
        raise ValueError("not a TIFF file")
    pages, at = [], struct.unpack_from(order + "I", content, 4)[0]
    while at:
        n = struct.unpack_from(order + "H", content, at)[0]
        tags = {}
        for k in range(n):
            tag, kind, count = struct.unpack_from(order + "HHI", content, at + 2 + 12 * k)
            letter = {1: "B", 3: "H", 4: "I"}.get(kind)
            if letter:
                size = struct.calcsize(letter) * count
                where = at + 10 + 12 * k if size <= 4 else struct.unpack_from(order + "I", content, at + 10 + 12 * k)[0]
                tags[tag] = struct.unpack_from(f"{order}{count}{letter}", content, where)
        # Width 256, height 257, bits 258, compression 259, strips 273 and 279, kind of number 339.
        width, height, bits = tags[256][0], tags[257][0], tags.get(258, (8,))[0]
        if tags.get(259, (1,))[0] != 1:
            raise ValueError("compressed TIFF files aren't read")
        data = b"".join(content[a : a + size] for a, size in zip(tags[273], tags[279], strict=True))
        form = "f" if tags.get(339, (1,))[0] == 3 else "u"
        pages.append(np.frombuffer(data, f"{order}{form}{bits // 8}")[: width * height].reshape(height, width))
        at = struct.unpack_from(order + "I", content, at + 2 + 12 * n)[0]
    return pages


def read_tifs(spark: SparkSession, path: str) -> DataFrame:
    """(path, frame_i, height, pixels) of TIFF files; each page gives a row."""

    def run(batches):
        for batch in batches:
            rows = [(p, i, page.shape[0], page.astype(np.float32).ravel()) for p, content in zip(batch["path"], batch["content"], strict=True) for i, page in enumerate(tif_pages(content))]
            yield pd.DataFrame(rows, columns=["path", "frame_i", "height", "pixels"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, "path string, frame_i int, height int, pixels array<float>")


def window(frames: DataFrame, start_field: int = 0, n_fields: int | None = None, start_cycle: int = 0, n_cycles: int | None = None) -> DataFrame:
    """Fields and cycles within limits; predicates on columns that tables are laid out by."""
    for name, start, n in (("field_i", start_field, n_fields), ("cycle_i", start_cycle, n_cycles)):
        frames = frames.filter(F.col(name) >= start)
        if n is not None:
            frames = frames.filter(F.col(name) < start + n)
    return frames


def chosen(fields: None | int | slice | list[int], table: DataFrame) -> DataFrame:
    """Rows of the chosen fields: all, one, a range or a list."""
    if fields is None:
        return table
    if isinstance(fields, int):
        return table.filter(F.col("field_i") == fields)
    if isinstance(fields, slice):
        out = table if fields.start is None else table.filter(F.col("field_i") >= fields.start)
        return out if fields.stop is None else out.filter(F.col("field_i") < fields.stop)
    return table.filter(F.col("field_i").isin(*fields))
