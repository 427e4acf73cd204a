"""Image kernels in numpy, and the field pipeline as one grouped map by field."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

PEAKS = "field_i long, field_peak_i long, channel_i int, cycle_i int, aln_y double, aln_x double, signal double, noise double, bg_med double, bg_std double"


def gaussian(size: int, sigma: float, dy: float = 0.0, dx: float = 0.0) -> np.ndarray:
    """A round point-spread function that sums to one."""
    at = np.arange(size) - (size - 1) / 2
    out = np.exp(-((at - dy)[:, None] ** 2 + (at - dx)[None, :] ** 2) / (2 * sigma * sigma))
    return out / out.sum()


def band_pass(image: np.ndarray, low: float, high: float) -> np.ndarray:
    """Keeps spatial frequencies between low and high, in shares of the image, with soft edges; less the median."""
    y, x = (np.fft.fftfreq(n) * 2 for n in image.shape)
    r = np.hypot(y[:, None], x[None, :])
    mask = (1 + np.tanh((r - low) / 0.01)) / 2 * (1 - np.tanh((r - high) / 0.01)) / 2
    out = np.fft.ifft2(np.fft.fft2(image) * mask).real
    return out - np.median(out)


def quality(image: np.ndarray) -> float:
    """Share of spectral power at high frequencies."""
    power = np.abs(np.fft.fft2(image - image.mean())) ** 2
    y, x = (np.fft.fftfreq(n) * 2 for n in image.shape)
    return float(power[np.hypot(y[:, None], x[None, :]) > 0.1].sum() / max(power.sum(), 1e-12))


def shift_between(fixed: np.ndarray, moved: np.ndarray) -> tuple[int, int]:
    """The whole-pixel shift of moved against fixed: the peak of their cross-correlation."""
    product = np.fft.fft2(moved - moved.mean()) * np.conj(np.fft.fft2(fixed - fixed.mean()))
    at = np.unravel_index(np.argmax(np.fft.ifft2(product).real), fixed.shape)
    return tuple(int(a) if a <= n // 2 else int(a) - n for a, n in zip(at, fixed.shape, strict=True))


def sub_pixel_shift(fixed: np.ndarray, moved: np.ndarray) -> tuple[float, float]:
    """The shift refined by a parabola through the correlation's peak on each axis."""
    product = np.fft.fft2(moved - moved.mean()) * np.conj(np.fft.fft2(fixed - fixed.mean()))
    c = np.fft.ifft2(product).real
    at = np.unravel_index(np.argmax(c), c.shape)
    out = []
    for axis in (0, 1):
        near = [c[tuple((p + (d if k == axis else 0)) % n for k, (p, n) in enumerate(zip(at, c.shape, strict=True)))] for d in (-1, 0, 1)]
        bend = near[0] - 2 * near[1] + near[2]
        step = 0.0 if bend == 0 else 0.5 * (near[0] - near[2]) / bend
        n = c.shape[axis]
        out.append((at[axis] if at[axis] <= n // 2 else at[axis] - n) + step)
    return tuple(out)


def moved(image: np.ndarray, dy: float, dx: float) -> np.ndarray:
    """The image shifted back by (dy, dx), by phase; edges wrap."""
    y, x = np.fft.fftfreq(image.shape[0]), np.fft.fftfreq(image.shape[1])
    return np.fft.ifft2(np.fft.fft2(image) * np.exp(2j * np.pi * (y[:, None] * dy + x[None, :] * dx))).real


def crop_power_of_two(image: np.ndarray) -> np.ndarray:
    """Square, cropped or padded with zeros to the nearest power of two; the upper one from 1.5 times the lower."""
    n = max(image.shape)
    low = 1 << (n.bit_length() - 1)
    side = low * 2 if n >= 1.5 * low else low
    out = np.zeros((side, side), image.dtype)
    h, w = min(side, image.shape[0]), min(side, image.shape[1])
    out[:h, :w] = image[:h, :w]
    return out


def half_std(values: np.ndarray) -> float:
    """Spread below zero, mirrored."""
    low = values[values < 0]
    return float(np.sqrt((low**2).mean())) if len(low) else 0.0


def find_peaks(image: np.ndarray, psf: np.ndarray, k: float = 2.0, distance: int = 2) -> np.ndarray:
    """(n, 2) centres: local maxima of the image correlated with the psf, above k mirrored spreads, moved to the centre of mass of squares."""
    size = psf.shape[0]
    kernel = np.zeros(image.shape)
    kernel[:size, :size] = psf - psf.mean()
    kernel = np.roll(kernel, (-(size // 2), -(size // 2)), (0, 1))
    score = np.fft.ifft2(np.fft.fft2(image) * np.conj(np.fft.fft2(kernel))).real
    score -= np.median(score)
    best = score.copy()
    for dy in range(-distance, distance + 1):
        for dx in range(-distance, distance + 1):
            best = np.maximum(best, np.roll(score, (dy, dx), (0, 1)))
    at = np.argwhere((score == best) & (score > k * half_std(score)))
    edge = size // 2 + 1
    at = at[((at >= edge) & (at < np.array(image.shape) - edge)).all(axis=1)]
    out = []
    for y, x in at:
        part = np.maximum(image[y - 2 : y + 3, x - 2 : x + 3] - np.median(image), 0) ** 2
        mass = part.sum()
        grid = np.arange(-2, 3)
        out.append((y, x) if mass <= 0 else (y + (part.sum(axis=1) @ grid) / mass, x + (part.sum(axis=0) @ grid) / mass))
    return np.array(out, float).reshape(-1, 2)


def radiometry(image: np.ndarray, at: np.ndarray, size: int, sigma: float) -> np.ndarray:
    """(signal, noise, bg_med, bg_std) of each place: least squares of the psf on the image less its background; NaN at edges."""
    out = np.full((len(at), 4), np.nan)
    for i, (y, x) in enumerate(at):
        if not (np.isfinite(y) and np.isfinite(x)):
            continue
        top, left = int(np.floor(y)) - size // 2, int(np.floor(x)) - size // 2
        if top < 0 or left < 0 or top + size > image.shape[0] or left + size > image.shape[1]:
            continue
        part = image[top : top + size, left : left + size]
        psf = gaussian(size, sigma, y - top - (size - 1) / 2, x - left - (size - 1) / 2)
        around = np.sort(part[psf < 0.001])
        background = around[len(around) // 2] if len(around) else 0.0
        power = (psf * psf).sum()
        signal = (psf * (part - background)).sum() / power
        rest = part - background - signal * psf
        out[i] = signal, np.sqrt(rest.var() / power), background, np.sqrt(((around - background) ** 2).sum()) if len(around) else 0.0
    return out


def fit_gaussian(part: np.ndarray, rounds: int = 30) -> np.ndarray:
    """(amplitude, y, x, sigma_y, sigma_x, correlation, offset) by damped least squares; NaN if it doesn't settle."""
    n, m = part.shape
    yy, xx = np.mgrid[:n, :m].astype(float)
    p = np.array([part.max() - np.median(part), (n - 1) / 2, (m - 1) / 2, 1.5, 1.5, 0.0, np.median(part)])

    def model(p: np.ndarray) -> np.ndarray:
        a, y, x, sy, sx, rho, off = p
        u, v = (yy - y) / sy, (xx - x) / sx
        return (a * np.exp(-(u * u - 2 * rho * u * v + v * v) / (2 * (1 - rho * rho))) + off).ravel()

    damp, target = 1e-2, part.ravel().astype(float)
    error = ((model(p) - target) ** 2).sum()
    for _ in range(rounds):
        base = model(p)
        step = 1e-4 * np.maximum(1, np.abs(p))
        slope = np.stack([(model(p + step[k] * np.eye(7)[k]) - base) / step[k] for k in range(7)], axis=1)
        square = slope.T @ slope
        try:
            new = p - np.linalg.solve(square + damp * np.diag(np.diag(square) + 1e-9), slope.T @ (base - target))
        except np.linalg.LinAlgError:
            return np.full(7, np.nan)
        new[3:5], new[5] = np.clip(np.abs(new[3:5]), 0.3, max(n, m)), np.clip(new[5], -0.95, 0.95)
        now = ((model(new) - target) ** 2).sum()
        p, error, damp = (new, now, damp / 3) if now < error else (p, error, damp * 4)
    return p if np.isfinite(p).all() else np.full(7, np.nan)


def mean_psf(image: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """The mean of the peaks' surroundings, less the median, summing to one; zeros without usable peaks."""
    parts = []
    for y, x in np.round(at).astype(int):
        part = image[y - size // 2 : y - size // 2 + size, x - size // 2 : x - size // 2 + size]
        if part.shape == (size, size) and part.sum() > 0:
            part = np.maximum(part - np.median(part), 0)
            parts.append(part / max(part.sum(), 1e-12))
    return np.mean(parts, axis=0) if parts else np.zeros((size, size))


def synthesize(field_i: int, n_peaks: int, side: int, n_channels: int, n_cycles: int, seed: int, brightness: float = 3000.0, drift: float = 2.0) -> np.ndarray:
    """Frames (channel, cycle, y, x): peaks that go dark at random cycles, a drift from cycle to cycle, camera noise."""
    rng = np.random.default_rng([seed, field_i])
    at = rng.uniform(16, side - 16, (n_peaks, 2))
    life = rng.integers(1, n_cycles + 1, (n_channels, n_peaks))
    frames = rng.normal(100, 5, (n_channels, n_cycles, side, side))
    for cy in range(n_cycles):
        dy, dx = np.round(rng.uniform(-drift, drift, 2)) if cy else (0.0, 0.0)
        for ch in range(n_channels):
            for (y, x), k in zip(at, life[ch], strict=True):
                if cy < k:
                    top, left = int(y + dy) - 5, int(x + dx) - 5
                    frames[ch, cy, top : top + 11, left : left + 11] += brightness * gaussian(11, 1.8, y + dy - top - 5, x + dx - left - 5)
    return frames


def analyse_field(frames: np.ndarray, size: int = 11, sigma: float = 1.8) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(shifts, peaks, radmat): aligns cycles on all channels, finds peaks in the first cycles' mean, measures every frame."""
    together = frames.mean(axis=0)
    filtered = np.stack([band_pass(f, 0.03, 0.9) for f in together])
    shifts = np.array([shift_between(filtered[0], f) for f in filtered])
    aligned = np.stack([[np.roll(frames[c, k], (-shifts[k][0], -shifts[k][1]), (0, 1)) for k in range(frames.shape[1])] for c in range(len(frames))])
    at = find_peaks(band_pass(aligned[:, 0].mean(axis=0), 0.03, 0.9), gaussian(size, sigma), k=3.0)
    radmat = np.stack([[radiometry(aligned[c, k], at, size, sigma) for k in range(frames.shape[1])] for c in range(len(frames))])
    return shifts, at, radmat


def fields(frames: DataFrame) -> DataFrame:
    """Peaks of all fields from frames (field_i, channel_i, cycle_i, height, pixels: array of rows one after the other).

    One group is one field: its frames fit in memory by the microscope's size, whatever their number.
    """

    def run(group: pd.DataFrame) -> pd.DataFrame:
        n_ch, n_cy = group["channel_i"].max() + 1, group["cycle_i"].max() + 1
        stack = None
        for row in group.itertuples():
            image = np.asarray(row.pixels, float).reshape(row.height, -1)
            stack = np.zeros((n_ch, n_cy, *image.shape)) if stack is None else stack
            stack[row.channel_i, row.cycle_i] = image
        _, at, radmat = analyse_field(stack)
        out = [(group["field_i"].iloc[0], i, c, k, *at[i], *radmat[c, k, i]) for c in range(n_ch) for k in range(n_cy) for i in range(len(at))]
        return pd.DataFrame(out, columns=[f.split()[0] for f in PEAKS.split(", ")])

    return frames.groupBy("field_i").applyInPandas(run, PEAKS)


def synthetic_frames(numbers: DataFrame, n_peaks: int = 25, side: int = 96, n_channels: int = 2, n_cycles: int = 3, seed: int = 5) -> DataFrame:
    """Frames of the fields in numbers (field_i)."""

    def run(batches):
        for batch in batches:
            rows = []
            for f in batch["field_i"]:
                stack = synthesize(int(f), n_peaks, side, n_channels, n_cycles, seed)
                rows += [(f, c, k, side, stack[c, k].astype(np.float32).ravel()) for c in range(n_channels) for k in range(n_cycles)]
            yield pd.DataFrame(rows, columns=["field_i", "channel_i", "cycle_i", "height", "pixels"])

    return numbers.select("field_i").mapInPandas(run, "field_i long, channel_i int, cycle_i int, height int, pixels array<float>")


def reconciled(places: list[np.ndarray], shape: tuple[int, int], radius: int = 2) -> tuple[np.ndarray, np.ndarray]:
    """(centres, by_channel) of peaks that channels agree on; by_channel has NaN where a channel has none.

    Discs around all channels' peaks are joined where they touch. A joined patch with two peaks of one
    channel is ambiguous and left out; the others' centres are means over channels.
    """
    every = [(c, i) for c, at in enumerate(places) for i in range(len(at))]
    up = list(range(len(every)))

    def root(x: int) -> int:
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    owner: dict[tuple[int, int], int] = {}
    disc = [(dy, dx) for dy in range(-radius, radius + 1) for dx in range(-radius, radius + 1) if dy * dy + dx * dx <= radius * radius]
    for k, (c, i) in enumerate(every):
        y, x = np.round(places[c][i]).astype(int)
        for dy, dx in disc:
            if 0 <= y + dy < shape[0] and 0 <= x + dx < shape[1]:
                for near in ((0, 0), (1, 0), (-1, 0), (0, 1), (0, -1)):
                    other = owner.get((y + dy + near[0], x + dx + near[1]))
                    if other is not None:
                        up[root(k)] = root(other)
                owner[y + dy, x + dx] = k
    groups: dict[int, list[int]] = {}
    for k in range(len(every)):
        groups.setdefault(root(k), []).append(k)
    centres, by_channel = [], []
    for members in groups.values():
        channels = [every[k][0] for k in members]
        if len(set(channels)) < len(channels):
            continue
        own = np.full((len(places), 2), np.nan)
        for k in members:
            own[every[k][0]] = places[every[k][0]][every[k][1]]
        centres.append(np.nanmean(own, axis=0))
        by_channel.append(own)
    return np.array(centres).reshape(-1, 2), np.array(by_channel).reshape(-1, len(places), 2)


def illumination(at: np.ndarray, signal: np.ndarray, shape: tuple[int, int]) -> np.ndarray:
    """(amplitude, centre y, centre x, fall): brightness that falls off with the squared distance from a centre, by least squares of its log."""
    ok = np.isfinite(signal) & (signal > 0)
    y, x = at[ok, 0] / shape[0], at[ok, 1] / shape[1]
    a = np.stack([np.ones_like(y), y, x, y * y + x * x], axis=1)
    c = np.linalg.lstsq(a, np.log(signal[ok]), rcond=None)[0]
    fall = -c[3]
    cy, cx = (c[1] / (2 * fall), c[2] / (2 * fall)) if abs(fall) > 1e-9 else (0.5, 0.5)
    return np.array([np.exp(c[0] + fall * (cy * cy + cx * cx)), cy * shape[0], cx * shape[1], fall])


def calibrated(frames: np.ndarray, size: int = 11, sigma: float = 1.8) -> dict[str, np.ndarray]:
    """Channel shifts, point-spread function and illumination of one field."""
    shifts = np.array([sub_pixel_shift(frames[0, 0], frames[c, 0]) for c in range(len(frames))])
    at = find_peaks(band_pass(frames[0, 0], 0.03, 0.9), gaussian(size, sigma), k=3.0)
    return {"shifts": shifts, "psf": mean_psf(frames[0, 0], at, size), "illumination": illumination(at, radiometry(frames[0, 0], at, size, sigma)[:, 0], frames.shape[2:]) if len(at) >= 4 else np.full(4, np.nan)}


def density_sweep(numbers: DataFrame, side: int = 96, seed: int = 9) -> DataFrame:
    """(field_i, n_drawn, n_found, median_signal): fields of known numbers of peaks (field_i, n_peaks), analysed."""

    def run(batches):
        for batch in batches:
            out = []
            for f, n in zip(batch["field_i"], batch["n_peaks"], strict=True):
                _, at, radmat = analyse_field(synthesize(int(f), int(n), side, 1, 1, seed))
                out.append((int(f), int(n), len(at), float(np.nanmedian(radmat[0, 0][:, 0])) if len(at) else float("nan")))
            yield pd.DataFrame(out, columns=["field_i", "n_drawn", "n_found", "median_signal"])

    return numbers.select("field_i", "n_peaks").mapInPandas(run, "field_i long, n_drawn long, n_found long, median_signal double")
