"""Pixel kernels in numpy, boxes in an image, and statistics of frames as maps over them.

Frames are rows (field_i, channel_i, cycle_i, height, pixels: array of rows one after the other).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FRAME = ("field_i", "channel_i", "cycle_i")


@dataclass(frozen=True)
class Box:
    """A rectangle of pixels: its first row and column, height and width."""

    y: int
    x: int
    h: int
    w: int

    @classmethod
    def around(cls, y: float, x: float, size: int) -> "Box":
        return cls(int(round(y)) - size // 2, int(round(x)) - size // 2, size, size)

    def moved(self, dy: int, dx: int) -> "Box":
        return Box(self.y + dy, self.x + dx, self.h, self.w)

    def clipped(self, shape: tuple[int, int]) -> "Box":
        """The part that lies in an image; empty if none does."""
        top, left = min(max(self.y, 0), shape[0]), min(max(self.x, 0), shape[1])
        return Box(top, left, max(0, min(self.y + self.h, shape[0]) - top), max(0, min(self.x + self.w, shape[1]) - left))

    def slices(self) -> tuple[slice, slice]:
        return slice(self.y, self.y + self.h), slice(self.x, self.x + self.w)


def cut_out(image: np.ndarray, box: Box, fill: float = 0.0) -> np.ndarray:
    """The box's pixels; what lies outside of the image gets the fill value."""
    out, there = np.full((box.h, box.w), fill, float), box.clipped(image.shape)
    out[there.moved(-box.y, -box.x).slices()] = image[there.slices()]
    return out


def paste(image: np.ndarray, part: np.ndarray, y: int, x: int, add: bool = True) -> None:
    """Puts part into the image, or adds it; what lies outside is left out."""
    box = Box(y, x, *part.shape)
    there = box.clipped(image.shape)
    own = part[there.moved(-y, -x).slices()]
    image[there.slices()] = image[there.slices()] + own if add else own


def disc(shape: tuple[int, int], y: float, x: float, radius: float, inner: float = -1.0) -> np.ndarray:
    """Which pixels lie within a radius of a place, and beyond the inner one."""
    far = np.hypot(np.arange(shape[0])[:, None] - y, np.arange(shape[1])[None, :] - x)
    return (far <= radius) & (far > inner)


def convolved(image: np.ndarray, kernel: np.ndarray) -> np.ndarray:
    """Convolution of the image's size; the outside is zero."""
    shape = [a + b - 1 for a, b in zip(image.shape, kernel.shape, strict=True)]
    whole = np.fft.irfft2(np.fft.rfft2(image, shape) * np.fft.rfft2(kernel, shape), shape)
    return cut_out(whole, Box((kernel.shape[0] - 1) // 2, (kernel.shape[1] - 1) // 2, *image.shape))


def between_pixels(image: np.ndarray, y: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Values at places between pixels, linear in both directions; edges go on outwards."""
    y, x = np.clip(y, 0, image.shape[0] - 1), np.clip(x, 0, image.shape[1] - 1)
    top, left = np.minimum(y.astype(int), max(0, image.shape[0] - 2)), np.minimum(x.astype(int), max(0, image.shape[1] - 2))
    low, right = np.minimum(top + 1, image.shape[0] - 1), np.minimum(left + 1, image.shape[1] - 1)
    fy, fx = y - top, x - left
    return (image[top, left] * (1 - fx) + image[top, right] * fx) * (1 - fy) + (image[low, left] * (1 - fx) + image[low, right] * fx) * fy


def moments(image: np.ndarray) -> tuple[float, float, float, np.ndarray]:
    """Sum, centre of mass and covariance of an image's weights; the middle and zeros for an image without weight."""
    total = float(image.sum())
    if total == 0:
        return 0.0, (image.shape[0] - 1) / 2, (image.shape[1] - 1) / 2, np.zeros((2, 2))
    y, x = np.arange(image.shape[0])[:, None], np.arange(image.shape[1])[None, :]
    cy, cx = float((image * y).sum() / total), float((image * x).sum() / total)
    cross = ((y - cy) * (x - cx) * image).sum()
    return total, cy, cx, np.array([[((y - cy) ** 2 * image).sum(), cross], [cross, ((x - cx) ** 2 * image).sum()]]) / total


def aspect(image: np.ndarray) -> tuple[float, float]:
    """Ratio of the short to the long axis of an image's weights, and the long one's angle from the rows, in [0, pi)."""
    size, ways = np.linalg.eigh(moments(image)[3])
    return float(np.sqrt(max(size[0], 0) / size[1])) if size[1] > 0 else 1.0, float(np.arctan2(ways[0, 1], ways[1, 1]) % np.pi)


def commonest(image: np.ndarray, n_bins: int = 64) -> float:
    """The middle of the fullest of equal bins of brightness."""
    n, edges = np.histogram(image, n_bins)
    k = int(np.argmax(n))
    return float((edges[k] + edges[k + 1]) / 2)


def regions(image: np.ndarray, n: int, statistic: Callable[[np.ndarray], float] = np.mean) -> np.ndarray:
    """A statistic of each of n by n regions of nearly equal size."""
    rows, columns = (np.linspace(0, s, n + 1).astype(int) for s in image.shape)
    return np.array([[statistic(image[a:b, c:d]) for c, d in zip(columns, columns[1:], strict=False)] for a, b in zip(rows, rows[1:], strict=False)])


def rolling(image: np.ndarray, size: int, statistic: Callable = np.mean, step: int = 1) -> np.ndarray:
    """A statistic of every window of size by size pixels, `step` apart."""
    windows = np.lib.stride_tricks.sliding_window_view(image, (size, size))[::step, ::step]
    return statistic(windows, axis=(2, 3))


def _of_frames(frames: DataFrame, columns: list[tuple[str, pa.DataType]], measure: Callable[[np.ndarray], list[tuple]]) -> DataFrame:
    """A map over frames: each gives rows of the named columns behind its own numbers."""
    schema = ", ".join([*(f"{c} long" for c in FRAME), *(f"{n} {'double' if t == pa.float64() else 'int'}" for n, t in columns)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, rows = [], []
            for *key, height, pixels in zip(*(batch.column(c).to_pylist() for c in (*FRAME, "height", "pixels")), strict=True):
                found = measure(np.asarray(pixels, float).reshape(height, -1))
                keys += [key] * len(found)
                rows += found
            yield pa.RecordBatch.from_arrays([*(pa.array([k[i] for k in keys], pa.int64()) for i in range(3)), *(pa.array([r[i] for r in rows], t) for i, (_, t) in enumerate(columns))], names=[*FRAME, *(n for n, _ in columns)])

    return frames.select(*FRAME, "height", "pixels").mapInArrow(run, schema)


def frame_statistics(frames: DataFrame) -> DataFrame:
    """Sum, mean, commonest brightness, centre of mass, aspect ratio and angle of every frame."""
    names = ("total", "mean", "mode", "y", "x", "ratio", "angle")

    def measure(image: np.ndarray) -> list[tuple]:
        total, y, x, _ = moments(image)
        return [(total, float(image.mean()), commonest(image), y, x, *aspect(image))]

    return _of_frames(frames, [(n, pa.float64()) for n in names], measure)


def frame_regions(frames: DataFrame, n: int) -> DataFrame:
    """(frame, region_y, region_x, mean): means of n by n regions of every frame."""
    columns = [("region_y", pa.int32()), ("region_x", pa.int32()), ("mean", pa.float64())]
    return _of_frames(frames, columns, lambda image: [(i, j, float(v)) for (i, j), v in np.ndenumerate(regions(image, n))])


def stacked(frames: DataFrame, by: tuple[str, ...] = ("field_i", "channel_i")) -> DataFrame:
    """(by, n, height, total): pixel by pixel sums of the frames of a field and channel; sums of batches come first, so none gathers its frames."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, list] = {}
        for batch in batches:
            for *key, height, pixels in zip(*(batch.column(c).to_pylist() for c in (*by, "height", "pixels")), strict=True):
                own = held.setdefault(tuple(key), [0, height, np.zeros(len(pixels))])
                own[0] += 1
                own[2] += np.asarray(pixels, float)
        rows = [(*key, *own) for key, own in held.items()]
        kinds = [*(pa.int64() for _ in by), pa.int64(), pa.int32(), pa.list_(pa.float64())]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names=[*by, "n", "height", "total"])

    parts = frames.select(*by, "height", "pixels").mapInArrow(add, ", ".join([*(f"{c} long" for c in by), "n long, height int, total array<double>"]))
    cells = parts.select(*by, "n", "height", F.posexplode("total").alias("at", "v")).groupBy(*by, "at").agg(F.sum("v").alias("v"), F.sum("n").alias("n"), F.max("height").alias("height"))
    rows = cells.groupBy(*by).agg(F.max("n").alias("n"), F.max("height").alias("height"), F.array_sort(F.collect_list(F.struct("at", "v"))).alias("c"))
    return rows.select(*by, "n", "height", F.transform("c", lambda c: c["v"]).alias("total"))


def with_camera(image: np.ndarray, rng: np.random.Generator, gain: float = 1.0, bias: float = 100.0, read_noise: float = 5.0) -> np.ndarray:
    """What a camera shows of expected photons: counts at random, times the gain, with a bias and read noise."""
    return rng.poisson(np.maximum(image, 0)) * gain + rng.normal(bias, read_noise, image.shape)


def vignetted(image: np.ndarray, fall: float) -> np.ndarray:
    """Brightness that falls off with the squared distance from the middle, in sides."""
    y, x = (np.linspace(-0.5, 0.5, n) for n in image.shape)
    return image * np.exp(-fall * (y[:, None] ** 2 + x[None, :] ** 2))
