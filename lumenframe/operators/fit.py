"""Parameter estimation: searches on the driver whose candidates are judged in one Spark job a generation."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def non_negative(a: np.ndarray, b: np.ndarray, rounds: int = 300) -> tuple[np.ndarray, float]:
    """Least squares of a x = b with x >= 0, by active sets; x and the length of the rest."""
    n = a.shape[1]
    x, free = np.zeros(n), np.zeros(n, bool)
    slope = a.T @ b
    for _ in range(rounds):
        if free.all() or slope[~free].max(initial=-1) <= 1e-10:
            break
        free[np.flatnonzero(~free)[np.argmax(slope[~free])]] = True
        while True:
            trial = np.zeros(n)
            trial[free] = np.linalg.lstsq(a[:, free], b, rcond=None)[0]
            if trial[free].min() > 0:
                break
            low = free & (trial <= 0)
            t = np.min(x[low] / np.maximum(x[low] - trial[low], 1e-300))
            x = x + t * (trial - x)
            free &= x > 1e-12
            if not free.any():
                break
        x = trial
        slope = a.T @ (b - a @ x)
    return x, float(np.linalg.norm(b - a @ x))


def unmixed(transition: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Shares of peptides whose tracks, by the transition matrix (track, peptide), best explain the counts."""
    x, _ = non_negative(transition, counts / max(counts.sum(), 1e-12))
    return x / max(x.sum(), 1e-12)


def line_search(f: Callable[[np.ndarray], float], x: np.ndarray, way: np.ndarray, low: np.ndarray, high: np.ndarray, rounds: int = 40) -> tuple[np.ndarray, float]:
    """The least of f on the line through x within bounds, by golden sections."""
    with np.errstate(divide="ignore", invalid="ignore"):
        a, b = (low - x) / way, (high - x) / way
    lo, hi = np.nanmax(np.where(way != 0, np.minimum(a, b), -np.inf)), np.nanmin(np.where(way != 0, np.maximum(a, b), np.inf))
    g = (np.sqrt(5) - 1) / 2
    c, d = hi - g * (hi - lo), lo + g * (hi - lo)
    fc, fd = f(x + c * way), f(x + d * way)
    for _ in range(rounds):
        if fc < fd:
            hi, d, fd = d, c, fc
            c = hi - g * (hi - lo)
            fc = f(x + c * way)
        else:
            lo, c, fc = c, d, fd
            d = lo + g * (hi - lo)
            fd = f(x + d * way)
    t = (lo + hi) / 2
    return np.clip(x + t * way, low, high), f(np.clip(x + t * way, low, high))


def local_search(f: Callable[[np.ndarray], float], x: np.ndarray, low: np.ndarray, high: np.ndarray, rounds: int = 8) -> tuple[np.ndarray, float]:
    """Conjugate directions without slopes, within bounds."""
    ways, value = list(np.eye(len(x))), f(x)
    for _ in range(rounds):
        begin, drops = x.copy(), []
        for way in ways:
            new, v = line_search(f, x, way, low, high)
            drops.append(value - min(v, value))
            if v < value:
                x, value = new, v
        if max(drops) < 1e-9:
            break
        if np.any(x != begin):
            new, v = line_search(f, x, x - begin, low, high)
            ways[int(np.argmax(drops))] = x - begin
            if v < value:
                x, value = new, v
    return x, value


def grid_search(spark: SparkSession, f: Callable[[np.ndarray], float], low: np.ndarray, high: np.ndarray, n_start: int = 64, generations: int = 4, keep: int = 8, seed: int = 1) -> tuple[np.ndarray, float]:
    """A global search: each generation's candidates are one distributed job; the best ones' boxes are searched finer."""
    rng = np.random.default_rng(seed)
    candidates, width, best = low + rng.random((n_start, len(low))) * (high - low), (high - low) / 4, None
    for _ in range(generations):
        scored = evaluated(spark, f, candidates)
        order = np.argsort(scored, kind="stable")
        if best is None or scored[order[0]] < best[1]:
            best = candidates[order[0]], float(scored[order[0]])
        top = candidates[order[:keep]]
        candidates = np.clip(np.repeat(top, max(1, n_start // keep), axis=0) + rng.uniform(-1, 1, (keep * max(1, n_start // keep), len(low)))[: len(top) * max(1, n_start // keep)] * width, low, high)
        width = width / 3
    return best


def evaluated(spark: SparkSession, f: Callable[[np.ndarray], float], candidates: np.ndarray) -> np.ndarray:
    frame = spark.createDataFrame(pd.DataFrame({"i": range(len(candidates)), "x": [c.tolist() for c in candidates]})).repartition(min(len(candidates), 64))

    def run(batches):
        for batch in batches:
            yield pd.DataFrame({"i": batch["i"], "v": [float(f(np.asarray(x))) for x in batch["x"]]})

    rows = frame.mapInPandas(run, "i long, v double").collect()
    out = np.empty(len(candidates))
    for r in rows:
        out[r["i"]] = r["v"]
    return out


def resampled(counts: DataFrame, n_replicates: int, statistic: Callable[[np.ndarray], list[float]], seed: int = 1) -> DataFrame:
    """(replicate, value): the statistic of multinomial redraws of a histogram (key, n) of bounded size."""
    rows = counts.orderBy("key").collect()
    n = np.array([r["n"] for r in rows], float)
    numbers = counts.sparkSession.range(n_replicates)

    def run(batches):
        for batch in batches:
            out = []
            for i in batch["id"]:
                drawn = np.random.default_rng([seed, int(i)]).multinomial(int(n.sum()), n / n.sum()) if n.sum() else n
                out.append((int(i), statistic(drawn.astype(float))))
            yield pd.DataFrame(out, columns=["replicate", "value"])

    return numbers.mapInPandas(run, "replicate long, value array<double>")


def scan(spark: SparkSession, f: Callable[[np.ndarray], float], x: np.ndarray, low: np.ndarray, high: np.ndarray, axes: list[tuple[int, ...]], n: int = 21) -> DataFrame:
    """(axes, x, value): the objective on grids of n points a side over the named axes, the others held at x; one job for all grids.

    Axes may be single (lines), pairs or more; the number of points is n to the power of their number.
    """
    rows = []
    for group in axes:
        sides = [np.linspace(low[k], high[k], n) for k in group]
        for point in np.stack(np.meshgrid(*sides, indexing="ij"), axis=-1).reshape(-1, len(group)):
            at = np.array(x, float)
            at[list(group)] = point
            rows.append((",".join(map(str, group)), at.tolist()))
    frame = spark.createDataFrame(rows, "axes string, x array<double>").repartition(min(len(rows), 64))

    def run(batches):
        for batch in batches:
            yield pd.DataFrame({"axes": batch["axes"], "x": batch["x"], "value": [float(f(np.asarray(v))) for v in batch["x"]]})

    return frame.mapInPandas(run, "axes string, x array<double>, value double")


def share_below(scores: DataFrame, value: float) -> float:
    """The share of random scores (score) that are below a value; 0 of none."""
    return scores.agg(F.coalesce(F.avg((F.col("score") < value).cast("double")), F.lit(0.0)).alias("p")).first()["p"]


def trials(spark: SparkSession, draw: Callable[[np.random.Generator], list[float]], trial: Callable[[list[float]], float], n: int, seed: int = 1) -> DataFrame:
    """(trial_i, params, score): n trials of parameters drawn at random; each depends on seed and its number alone."""

    def run(batches):
        for batch in batches:
            params = [list(map(float, draw(np.random.default_rng([seed, int(i)])))) for i in batch["id"]]
            yield pd.DataFrame({"trial_i": batch["id"], "params": params, "score": [float(trial(p)) for p in params]})

    return spark.range(n).mapInPandas(run, "trial_i long, params array<double>, score double")


def many_starts(spark: SparkSession, f: Callable[[np.ndarray], float], low: np.ndarray, high: np.ndarray, n: int, seed: int = 1) -> DataFrame:
    """(start_i, x, value): local searches from n random starts within bounds, one a row."""

    def run(batches):
        for batch in batches:
            found = [local_search(f, low + np.random.default_rng([seed, int(i)]).random(len(low)) * (high - low), low, high) for i in batch["id"]]
            yield pd.DataFrame({"start_i": batch["id"], "x": [x.tolist() for x, _ in found], "value": [v for _, v in found]})

    return spark.range(n).repartition(min(n, 64)).mapInPandas(run, "start_i long, x array<double>, value double")
