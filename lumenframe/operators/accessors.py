"""Accessors of signal-processing results: measures, fields, locations, fits, images, and reports over them.

Peaks are rows (field_i, field_peak_i, ...); measurements are rows (field_i, field_peak_i, channel_i, cycle_i,
signal, noise, ...); a field's metadata is a row a frame (field_i, channel_i, cycle_i, aln_y, aln_x, quality).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .relational import dense_ids
from .shared import join_counted

FRAME = ["field_i", "channel_i", "cycle_i"]
PEAK = ["field_i", "field_peak_i"]


def zero_for_nan(x: Column) -> Column:
    return F.when(x.isNull() | F.isnan(x), F.lit(0.0)).otherwise(x)


def measure(rows: DataFrame, name: str) -> DataFrame:
    """One measure of every peak, channel and cycle; 0 where it is missing."""
    return rows.select(*PEAK, "channel_i", "cycle_i", zero_for_nan(F.col(name)).alias(name))


def signal_to_noise(rows: DataFrame) -> DataFrame:
    """Adds snr; null where there is no noise."""
    noise = zero_for_nan(F.col("noise"))
    return rows.withColumn("snr", F.when(noise != 0, zero_for_nan(F.col("signal")) / noise))


def of_fields(table: DataFrame, fields: list[int] | None = None) -> DataFrame:
    """Rows of the chosen fields, whose folders alone are read if the table is laid out by field; an error if none has rows."""
    chosen = table if fields is None else table.filter(F.col("field_i").isin(fields))
    if chosen.isEmpty():
        raise ValueError(f"no rows in fields {fields}")
    return chosen


def first_fields(table: DataFrame, n: int | None) -> DataFrame:
    """Rows of fields below n; all without a limit."""
    return table if n is None else table.filter(F.col("field_i") < n)


def first_rows(table: DataFrame, n: int, row: str = "row_i") -> DataFrame:
    """The table without its tail: rows numbered below n."""
    return table.filter(F.col(row) < n)


def frame_counts(frames: DataFrame) -> DataFrame:
    """(field_i, n_channels, n_cycles, n_frames)."""
    return frames.groupBy("field_i").agg(F.countDistinct("channel_i").alias("n_channels"), F.countDistinct("cycle_i").alias("n_cycles"), F.countDistinct("channel_i", "cycle_i").alias("n_frames"))


def locations(peaks: DataFrame) -> DataFrame:
    """Aligned places of peaks with numbers over all fields: (peak_i, field_i, field_peak_i, aln_y, aln_x)."""
    return dense_ids(peaks.select(*PEAK, "aln_y", "aln_x"), "field_i", "field_peak_i", "peak_i").select("peak_i", *PEAK, "aln_y", "aln_x")


def nested_locations(peaks: DataFrame, by: list[str]) -> DataFrame:
    """(by, places): the places (y, x) of each field's frames, which may be of unequal number, in the order of field_peak_i."""
    rows = peaks.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("field_peak_i", "aln_y", "aln_x"))).alias("_p"))
    return rows.select(*by, F.transform("_p", lambda p: F.array(p["aln_y"], p["aln_x"])).alias("places"))


def with_fits(peaks: DataFrame, fits: DataFrame) -> DataFrame:
    """Peaks, numbered over all fields, with their fitted shapes; null where a peak has no fit."""
    return dense_ids(peaks, "field_i", "field_peak_i", "peak_i").join(fits, PEAK, "left")


def sampled_fits(fits: DataFrame, seed: int = 1) -> DataFrame:
    """As many fits as there are, drawn with replacement in each field: every place takes the fit of a hashed one."""
    sizes = fits.groupBy("field_i").agg(F.count("*").alias("_n"))
    place = F.row_number().over(Window.partitionBy("field_i").orderBy("field_peak_i")) - 1
    numbered = join_counted(fits, sizes, "field_i", "inner").withColumn("_at", place)
    pick = F.pmod(F.xxhash64(F.lit(seed), "field_i", "_at"), F.col("_n"))
    asked = numbered.select("field_i", pick.alias("_at"), F.col("_at").alias("draw_i"))
    return asked.join(numbered.drop("_n"), ["field_i", "_at"]).drop("_at")


def offsets(frames: DataFrame) -> DataFrame:
    """(field_i, offsets): each cycle's shift (y, x), channels averaged, in the order of cycles."""
    by = frames.groupBy("field_i", "cycle_i").agg(F.avg("aln_y").alias("y"), F.avg("aln_x").alias("x"))
    rows = by.groupBy("field_i").agg(F.array_sort(F.collect_list(F.struct("cycle_i", "y", "x"))).alias("_o"))
    return rows.select("field_i", F.transform("_o", lambda o: F.array(o["y"], o["x"])).alias("offsets"))


def neighbour_distance(peaks: DataFrame, cell: float) -> DataFrame:
    """(field_i, field_peak_i, nn): distance to the nearest other peak of the field if it is within a cell's width, else null.

    Peaks are dealt to cells of a grid and meet those of their own and the next cells only.
    """
    at = peaks.select(*PEAK, "aln_y", "aln_x", F.floor(F.col("aln_y") / cell).alias("cy"), F.floor(F.col("aln_x") / cell).alias("cx"))
    around = F.array(*(F.struct((F.col("cy") + dy).alias("cy"), (F.col("cx") + dx).alias("cx")) for dy in (-1, 0, 1) for dx in (-1, 0, 1)))
    spread = at.select("field_i", F.col("field_peak_i").alias("other"), F.col("aln_y").alias("oy"), F.col("aln_x").alias("ox"), F.explode(around).alias("c")).select("field_i", "other", "oy", "ox", "c.cy", "c.cx")
    d = F.hypot(F.col("aln_y") - F.col("oy"), F.col("aln_x") - F.col("ox"))
    near = at.join(spread, ["field_i", "cy", "cx"]).filter("field_peak_i <> other").withColumn("d", d).filter(F.col("d") <= cell)
    return at.select(*PEAK).join(near.groupBy(*PEAK).agg(F.min("d").alias("nn")), PEAK, "left")


def radmat_rows(rows: DataFrame, n_cycles: int, value: str = "signal") -> DataFrame:
    """(field_i, field_peak_i, flat): each peak's values, channels one after the other, 0 where one is missing."""
    at = F.col("channel_i") * n_cycles + F.col("cycle_i")
    pairs = rows.groupBy(*PEAK).agg(F.map_from_entries(F.collect_list(F.struct(at.alias("at"), zero_for_nan(F.col(value)).alias("v")))).alias("m"), (F.max("channel_i") + 1).alias("n"))
    return pairs.select(*PEAK, F.transform(F.sequence(F.lit(0), F.col("n") * n_cycles - 1), lambda i: F.coalesce(F.element_at("m", i), F.lit(0.0))).alias("flat"))


def images_of(images: DataFrame, field_i: int, channel_i: int | None = None, cycle_i: int | None = None) -> DataFrame:
    """A field's images, of one channel or cycle if named."""
    out = images.filter(F.col("field_i") == field_i)
    for name, value in (("channel_i", channel_i), ("cycle_i", cycle_i)):
        out = out if value is None else out.filter(F.col(name) == value)
    return out


def import_tables(frames: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Metadata a field (field_i, n_channels, n_cycles, height) and quality a frame, from frames (field_i, channel_i, cycle_i, height, quality)."""
    meta = frames.groupBy("field_i").agg(F.countDistinct("channel_i").alias("n_channels"), F.countDistinct("cycle_i").alias("n_cycles"), F.max("height").alias("height"))
    return meta, frames.select(*FRAME, "quality")


def write_fields(table: DataFrame, path: str) -> None:
    """A folder a field, so that readers of some fields open no others."""
    table.write.mode("overwrite").partitionBy("field_i").parquet(path)


def channel_pairs(rows: DataFrame, first: int, second: int) -> DataFrame:
    """(field_i, field_peak_i, cycle_i, x, y): signals of two channels side by side."""
    by = rows.groupBy(*PEAK, "cycle_i").agg(*(F.max(F.when(F.col("channel_i") == c, zero_for_nan(F.col("signal")))).alias(name) for name, c in (("x", first), ("y", second))))
    return by.filter("x is not null and y is not null")


def overview(frames: DataFrame, peaks: DataFrame) -> DataFrame:
    """(field_i, n_peaks, mean_quality, worst_alignment, place): fields from best to worst mean quality."""
    by = frames.groupBy("field_i").agg(F.avg("quality").alias("mean_quality"), F.max(F.greatest(F.abs("aln_y"), F.abs("aln_x"))).alias("worst_alignment"))
    counted = by.join(peaks.groupBy("field_i").agg(F.count("*").alias("n_peaks")), "field_i", "left").na.fill(0, ["n_peaks"])
    # One row a field.
    return counted.withColumn("place", F.row_number().over(Window.orderBy(F.col("mean_quality").desc(), "field_i")))


def with_metadata(rows: DataFrame, frames: DataFrame) -> DataFrame:
    """Measurements with their frame's quality and alignment."""
    return join_counted(rows, frames, FRAME)
