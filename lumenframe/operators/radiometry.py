"""Brightness of peaks over cycles: rows (peak_i, channel_i, cycle_i, signal, noise), or vectors by peak and channel."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.arrays import lifespan, max_rise
from .quantiles import exact_quantiles
from .shared import is_few, join_counted, written


def to_radmat(rows: DataFrame, n_channels: int, n_cycles: int, value: str = "signal") -> DataFrame:
    """(peak_i, radmat): channels by cycles in one flat array; means of repeats, 0 where nothing was measured.

    One aggregate with a cell each: no pivot job, no sort.
    """
    cell = lambda ch, cy: F.coalesce(F.avg(F.when((F.col("channel_i") == ch) & (F.col("cycle_i") == cy) & ~F.isnan(value), F.col(value))), F.lit(0.0))
    cells = [cell(ch, cy).alias(f"v{ch}_{cy}") for ch in range(n_channels) for cy in range(n_cycles)]
    wide = rows.groupBy("peak_i").agg(*cells)
    return wide.select("peak_i", F.array(*(F.col(f"v{ch}_{cy}") for ch in range(n_channels) for cy in range(n_cycles))).alias("radmat"))


def to_long(radmats: DataFrame, n_cycles: int) -> DataFrame:
    """(peak_i, channel_i, cycle_i, signal) of flat radmats."""
    return radmats.select("peak_i", F.posexplode("radmat").alias("at", "signal")).select("peak_i", F.floor(F.col("at") / n_cycles).cast("int").alias("channel_i"), (F.col("at") % n_cycles).cast("int").alias("cycle_i"), "signal")


def traces(rows: DataFrame, n_cycles: int, value: str = "signal") -> DataFrame:
    """(peak_i, channel_i, trace): one array of n_cycles by peak and channel."""
    cells = [F.coalesce(F.avg(F.when(F.col("cycle_i") == cy, F.col(value))), F.lit(0.0)).alias(f"v{cy}") for cy in range(n_cycles)]
    return rows.groupBy("peak_i", "channel_i").agg(*cells).select("peak_i", "channel_i", F.array(*(F.col(f"v{cy}") for cy in range(n_cycles))).alias("trace"))


def life_features(traced: DataFrame) -> DataFrame:
    """Per trace its lifespan, and statistics of the part within and after it (null where that is empty)."""
    with_life = traced.withColumn("life", lifespan(F.col("trace")))
    long = with_life.select("peak_i", "channel_i", "life", F.posexplode("trace").alias("cycle_i", "v"))
    alive = F.col("cycle_i") < F.col("life")
    out = []
    for name, part in (("lif", alive), ("afl", ~alive)):
        v = F.when(part, F.col("v"))
        out += [F.median(v).alias(f"{name}_med"), F.avg(v).alias(f"{name}_mean"), F.stddev_pop(v).alias(f"{name}_std"), (F.percentile(v, F.lit(0.75)) - F.percentile(v, F.lit(0.25))).alias(f"{name}_iqr"), F.max(v).alias(f"{name}_max"), F.min(v).alias(f"{name}_min")]
    return long.groupBy("peak_i", "channel_i", "life").agg(*out)


def monotonic(traced: DataFrame, beta: float, most: float = 1.0) -> DataFrame:
    """Adds rise, in dyes, and good: false where a trace that starts bright and lives on rises by more than `most`."""
    out = traced.withColumn("life", lifespan(F.col("trace"))).withColumn("rise", max_rise(F.col("trace"), F.col("life")) / beta)
    return out.withColumn("good", ~((F.col("rise") > most) & (F.col("life") > 1) & (F.get("trace", F.lit(0)) > 0.8 * beta)))


def half_std(value: Column, center: Column | float, above: bool = False) -> Column:
    """Aggregate: spread of the values on one side of the center, mirrored; 0 if there are none."""
    center = center if isinstance(center, Column) else F.lit(center)
    side = value >= center if above else value <= center
    return F.coalesce(F.sqrt(F.avg(F.when(side, (value - center) * (value - center)))), F.lit(0.0))


def dark_thresholds(rows: DataFrame, k: float, last_only: bool = False) -> DataFrame:
    """(channel_i, threshold): k mirrored spreads of the signals below 0 around their mode at 0."""
    if last_only:
        rows = rows.join(rows.agg(F.max("cycle_i").alias("_last")), F.col("cycle_i") == F.col("_last")).drop("_last")
    return rows.groupBy("channel_i").agg((half_std(F.col("signal"), 0.0) * k).alias("threshold"))


def in_float_range(rows: DataFrame) -> DataFrame:
    """(peak_i, in_range): whether all signals of a peak fit a 32-bit float."""
    most = 3.4028234663852886e38
    return rows.groupBy("peak_i").agg(((F.min("signal") > -most) & (F.max("signal") < most)).alias("in_range"))


def max_noise(rows: DataFrame) -> DataFrame:
    return rows.groupBy("peak_i").agg(F.max(F.when(~F.isnan("noise"), F.col("noise"))).alias("max_noise"))


def build_filter(peaks: DataFrame, fields: DataFrame, noise_limit: float) -> DataFrame:
    """(peak_i, pass_quality, flags): peaks has (peak_i, field_i, max_noise, good, in_range), fields (field_i, aligned, in_focus)."""
    flags = peaks.join(fields.groupBy("field_i").agg(F.bool_and("aligned").alias("aligned"), F.bool_and("in_focus").alias("in_focus")), "field_i")
    flags = flags.withColumn("low_noise", F.coalesce(F.col("max_noise") < noise_limit, F.lit(False)))
    return flags.select("peak_i", "aligned", "in_focus", "low_noise", "in_range", (F.col("aligned") & F.col("in_focus") & F.col("low_noise") & F.col("in_range")).alias("pass_quality"))


def filter_peaks(
    rows: DataFrame, channel_i: int, dark: float, *, on_through: int | None = None, off_at: int | None = None, monotonic_rise: float | None = None, min_first: float | None = None,
    max_first: float | None = None, max_any: float | None = None, fields: list[int] | None = None, reject_fields: list[int] | None = None, roi: tuple[float, float, float, float] | None = None,
) -> DataFrame:
    """All rows of the peaks that meet every condition given.

    Conditions on fields and place choose peaks by any row; those on the trace look at channel_i:
    bright in cycles 0..on_through, dark from off_at on, no rise above monotonic_rise, first or any
    signal within bounds. The peaks' whole rows come back.
    """
    chosen = rows
    if fields is not None:
        chosen = chosen.filter(F.col("field_i").isin(fields))
    if reject_fields is not None:
        chosen = chosen.filter(~F.col("field_i").isin(reject_fields))
    if roi is not None:
        y0, x0, y1, x1 = roi
        chosen = chosen.filter((F.col("aln_y") >= y0) & (F.col("aln_y") < y1) & (F.col("aln_x") >= x0) & (F.col("aln_x") < x1))
    own, s, c = chosen.filter(F.col("channel_i") == channel_i), F.col("signal"), F.col("cycle_i")
    tests = [F.count("*") > 0]
    if on_through is not None:
        tests.append(F.coalesce(F.bool_and(F.when(c <= on_through, s > dark)), F.lit(True)))
    if off_at is not None:
        tests.append(F.coalesce(F.bool_and(F.when(c >= off_at, s <= dark)), F.lit(True)))
    if min_first is not None:
        tests.append(F.coalesce(F.bool_and(F.when(c == 0, s >= min_first)), F.lit(True)))
    if max_first is not None:
        tests.append(F.coalesce(F.bool_and(F.when(c == 0, s <= max_first)), F.lit(True)))
    if max_any is not None:
        tests.append(F.max(s) <= max_any)
    if monotonic_rise is not None:
        own = own.withColumn("_rise", s - F.lag(s).over(Window.partitionBy("peak_i").orderBy("cycle_i")))
        tests.append(F.coalesce(F.max("_rise"), F.lit(0.0)) <= monotonic_rise)
    passed = tests[0]
    for t in tests[1:]:
        passed &= t
    kept = own.groupBy("peak_i").agg(passed.alias("_ok")).filter("_ok").select("peak_i")
    return rows.join(kept, "peak_i", "left_semi")


def histogram(rows: DataFrame, value: str, low: float, high: float, n_bins: int, by: tuple[str, ...] = ()) -> DataFrame:
    """(by, bin, n): equal bins from low to high, the last one closed; values outside are left out."""
    v = F.col(value)
    number = F.least(F.floor((v - low) / ((high - low) / n_bins)), F.lit(n_bins - 1)).cast("int")
    return rows.filter((v >= low) & (v <= high)).groupBy(*by, number.alias("bin")).agg(F.count("*").alias("n"))


def histogram_2d(rows: DataFrame, x: str, y: str, x_range: tuple[float, float], y_range: tuple[float, float], n_bins: int) -> DataFrame:
    """(x_bin, y_bin, n); NaN and null count as 0."""
    out = rows
    for name, value, (low, high) in (("x_bin", x, x_range), ("y_bin", y, y_range)):
        v = F.coalesce(F.when(~F.isnan(value), F.col(value)), F.lit(0.0))
        out = out.filter((v >= low) & (v <= high)).withColumn(name, F.least(F.floor((v - low) / ((high - low) / n_bins)), F.lit(n_bins - 1)).cast("int"))
    return out.groupBy("x_bin", "y_bin").agg(F.count("*").alias("n"))


def box_plot(rows: DataFrame, by: str, value: str) -> DataFrame:
    """(by, q0, q1, q2, q3, q4, low_fence, high_fence, n_outliers) of each group, exactly at any size of a group."""
    q = exact_quantiles(rows, [by], value, [0.0, 0.25, 0.5, 0.75, 1.0]).drop("n")
    q = q.withColumn("low_fence", F.col("q1") - 1.5 * (F.col("q3") - F.col("q1"))).withColumn("high_fence", F.col("q3") + 1.5 * (F.col("q3") - F.col("q1")))
    q = written(q, "box-plots")
    fences = q.select(F.col(by).alias("_by"), "low_fence", "high_fence")
    near = rows.select(by, value).join(F.broadcast(fences) if is_few(fences) else fences, F.col(by).eqNullSafe(F.col("_by")))
    outside = near.groupBy("_by").agg(F.count_if((F.col(value) < F.col("low_fence")) | (F.col(value) > F.col("high_fence"))).alias("n_outliers"))
    return q.join(outside, F.col(by).eqNullSafe(F.col("_by"))).drop("_by")


def signal_levels(rows: DataFrame, n_bins: int = 100) -> DataFrame:
    """(channel_i, cycle_i, p99, peak_bin): the 99th percentile and the fullest bin from 0 to it; the lowest of equals."""
    top = written(exact_quantiles(rows, ["channel_i", "cycle_i"], "signal", [0.99]).select("channel_i", "cycle_i", F.col("q0").alias("p99")), "signal-levels")
    binned = join_counted(rows, top, ["channel_i", "cycle_i"], "inner").filter((F.col("signal") >= 0) & (F.col("signal") <= F.col("p99")) & (F.col("p99") > 0)).withColumn("bin", F.least(F.floor(F.col("signal") / (F.col("p99") / n_bins)), F.lit(n_bins - 1)).cast("int"))
    counts = binned.groupBy("channel_i", "cycle_i", "bin").agg(F.count("*").alias("n"))
    peak = counts.groupBy("channel_i", "cycle_i").agg(F.max_by("bin", F.struct("n", -F.col("bin"))).alias("peak_bin"))
    return top.join(peak, ["channel_i", "cycle_i"], "left")
