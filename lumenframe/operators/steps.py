"""Regions of steady brightness in traces.

A trace is split where it changes most, and its parts again, as long as the two sides' medians are
apart. How much it changes at a place is the spread (median absolute deviation) of the WINDOW cycles
around it; only places where that peaks are candidates.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Cycles in the moving window, and the shortest region, half of it.
WINDOW, SHORTEST = 6, 3
FIELDS = "peak_i long, channel_i int, region_i int, start int, stop int, min double, max double, rng double, mean double, std double, var double, med double, mad double"


def spread(x: np.ndarray, axis: int = -1) -> np.ndarray:
    """Median absolute deviation."""
    return np.median(np.abs(x - np.median(x, axis=axis, keepdims=True)), axis=axis)


def peaks(trace: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places where the spread of the window around them peaks, and the spreads; the first of equal neighbours."""
    if len(trace) < WINDOW:
        return np.zeros(0, int), np.zeros(0)
    change = spread(np.lib.stride_tricks.sliding_window_view(trace, WINDOW))
    beside = np.pad(change, 1)
    at = np.flatnonzero((change > beside[:-2]) & (change >= beside[2:]))
    return at + SHORTEST, change[at]


def borders(trace: np.ndarray, closeness: float = 0.1, floor: float = 500.0) -> list[int]:
    """Where regions begin, and the end. Medians are apart if they differ by more than `closeness` of the larger, and than `floor`."""
    places, change = peaks(trace)
    found, open_ = [0, len(trace)], [(0, len(trace))]
    while open_:
        begin, end = open_.pop()
        inside = (places >= begin + SHORTEST) & (places <= end - SHORTEST)
        if not inside.any():
            continue
        cut = int(places[inside][np.argmax(change[inside])])
        left, right = np.median(trace[begin:cut]), np.median(trace[cut:end])
        if abs(left - right) > max(closeness * max(abs(left), abs(right)), floor):
            found.append(cut)
            open_ += [(begin, cut), (cut, end)]
    return sorted(found)


def step_regions(traces: DataFrame, closeness: float = 0.1, floor: float = 500.0) -> DataFrame:
    """One row a region of each trace of (peak_i, channel_i, trace), with its statistics; the last cycle counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for peak, channel, trace in zip(*(batch.column(c).to_pylist() for c in ("peak_i", "channel_i", "trace")), strict=True):
                if not trace:
                    continue
                x = np.nan_to_num(np.array([np.nan if v is None else v for v in trace], float))
                cut = borders(x, closeness, floor)
                for i, (a, b) in enumerate(zip(cut, cut[1:], strict=False)):
                    part = x[a:b]
                    rows.append((peak, channel, i, a, b, part.min(), part.max(), np.ptp(part), part.mean(), part.std(), part.var(), np.median(part), float(spread(part))))
            names = [f.split()[0] for f in FIELDS.split(", ")]
            kinds = [pa.int64(), *[pa.int32()] * 4, *[pa.float64()] * 8]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names=names)

    return traces.select("peak_i", "channel_i", "trace").mapInArrow(run, FIELDS)


def region_of_cycle(regions: DataFrame) -> DataFrame:
    """(peak_i, channel_i, cycle_i, region_i): the mask of regions, a row a cycle."""
    cycles = F.sequence(F.col("start"), F.col("stop") - 1)
    return regions.select("peak_i", "channel_i", F.explode(cycles).alias("cycle_i"), "region_i")


def region_matrix(regions: DataFrame, value: str = "mean") -> DataFrame:
    """(peak_i, channel_i, values): a statistic of each trace's regions, in their order."""
    rows = regions.groupBy("peak_i", "channel_i").agg(F.array_sort(F.collect_list(F.struct("region_i", value))).alias("_r"))
    return rows.select("peak_i", "channel_i", F.transform("_r", lambda r: r[value]).alias("values"))


def region_report(regions: DataFrame, closeness: float = 0.1) -> DataFrame:
    """Per channel: traces, regions, mean length, and how many regions rise from the one before by more than `closeness`."""
    ordered = regions.groupBy("peak_i", "channel_i").agg(F.array_sort(F.collect_list(F.struct("region_i", "med", "start", "stop"))).alias("r"))
    rises = F.size(F.filter(F.sequence(F.lit(1), F.greatest(F.size("r") - 1, F.lit(1))), lambda i: (i < F.size("r")) & (F.get("r", i)["med"] > F.get("r", i - 1)["med"] * (1 + closeness))))
    length = F.aggregate("r", F.lit(0), lambda a, x: a + x["stop"] - x["start"])
    by = ordered.select("channel_i", F.size("r").alias("n"), rises.alias("rises"), length.alias("cycles"))
    return by.groupBy("channel_i").agg(F.count("*").alias("n_traces"), F.sum("n").alias("n_regions"), (F.sum("cycles") / F.sum("n")).alias("mean_length"), F.sum("rises").alias("n_rises"))
