"""Monte-Carlo simulation of dye tracks, and the brightness they show."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .relational import numbered

PRE, MOCK, EDMAN = 0, 1, 2


@dataclass(frozen=True)
class Chemistry:
    """Failure rates of one experiment. p_bright and p_bleach are by channel."""

    n_channels: int = 2
    cycles: tuple[int, ...] = (PRE, *[EDMAN] * 8)
    p_bright: tuple[float, ...] = (0.82, 0.82)
    p_bleach: tuple[float, ...] = (0.06, 0.06)
    p_cyclic_block: float = 0.005
    p_initial_block: float = 0.2
    p_detach: float = 0.005
    p_edman_failure: float = 0.05
    p_mislabel: tuple[float, ...] = (0.0, 0.0)
    allow_last: bool = False
    seed: int = 1


@dataclass(frozen=True)
class Gains:
    """Brightness of one dye, and of none, by channel."""

    gain_mu: tuple[float, ...] = (8000.0, 8000.0)
    gain_sigma: tuple[float, ...] = (1200.0, 1200.0)
    bg_mu: tuple[float, ...] = (0.0, 0.0)
    bg_sigma: tuple[float, ...] = (150.0, 150.0)
    row_k_sigma: float = 0.16
    fret: tuple = field(default_factory=tuple)


def clipped(p: float) -> float:
    return min(1.0, max(0.0, p))


def simulate_peptide(channels: np.ndarray, n: int, chem: Chemistry, rng: np.random.Generator) -> np.ndarray:
    """n tracks (n, channel, cycle) of a peptide whose residues have these channels, -1 for none."""
    length, n_ch = len(channels), chem.n_channels
    realised = np.full((n, length), -1)
    for i, ch in enumerate(channels):
        left = np.full(n, ch >= 0)
        # A residue that its channel's label misses may be caught by the next channel's.
        for c in range(max(ch, 0), n_ch if ch >= 0 else 0):
            hit = left & (rng.random(n) >= (chem.p_mislabel[c] if c < len(chem.p_mislabel) else 0.0))
            realised[hit, i] = c
            left &= ~hit
            if not any(chem.p_mislabel):
                break
    bright = np.zeros((n, length), bool)
    for c in range(n_ch):
        at = realised == c
        bright |= at & (rng.random((n, length)) < clipped(chem.p_bright[c]))
    blocked = rng.random(n) < clipped(chem.p_initial_block)
    head, here = np.zeros(n, int), np.ones(n, bool)
    out = np.zeros((n, n_ch, len(chem.cycles)), np.int16)
    last = length if chem.allow_last else length - 1
    for k, kind in enumerate(chem.cycles):
        if kind == EDMAN:
            blocked |= rng.random(n) < clipped(chem.p_cyclic_block)
            step = here & ~blocked & (rng.random(n) >= clipped(chem.p_edman_failure)) & (head < last)
            bright[np.flatnonzero(step), head[step]] = False
            head += step
        if kind != PRE:
            here &= rng.random(n) >= clipped(chem.p_detach)
            bright &= here[:, None]
        for c in range(n_ch):
            out[:, c, k] = (bright & (realised == c)).sum(axis=1)
        for c in range(n_ch):
            bright &= ~((realised == c) & (rng.random((n, length)) < clipped(chem.p_bleach[c])))
    return out


def dye_tracks(peps: DataFrame, n_samples: int, chem: Chemistry) -> DataFrame:
    """(pep_i, dyt, n, recall): distinct tracks of each peptide (pep_i, channels: array<int>, null or -1 unlabelled).

    Draws go on until n_samples tracks aren't dark; a peptide of which over ten times as many are dark is
    given up with recall 0. Draws depend on seed and peptide alone, so a lost task gives the same rows.
    A peptide without a label has one dark track with n 0.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for pep, channels in zip(batch.column("pep_i").to_pylist(), batch.column("channels").to_pylist(), strict=True):
                ch = np.array([-1 if c is None else c for c in channels or []], int)
                size = chem.n_channels * len(chem.cycles)
                if not (ch >= 0).any():
                    out.append((pep, [0] * size, 0, 0.0))
                    continue
                rng = np.random.default_rng(int.from_bytes(hashlib.sha256(f"{chem.seed}|{pep}".encode()).digest()[:8], "little"))
                found, dark = [], 0
                while sum(map(len, found)) < n_samples and dark <= 10 * n_samples:
                    drawn = simulate_peptide(ch, n_samples, chem, rng).reshape(n_samples, -1)
                    lit = drawn.any(axis=1)
                    need = n_samples - sum(map(len, found))
                    stop = np.flatnonzero(lit)[need - 1] + 1 if lit.sum() >= need else n_samples
                    found.append(drawn[:stop][lit[:stop]])
                    dark += int((~lit[:stop]).sum())
                tracks, times = np.unique(np.concatenate(found), axis=0, return_counts=True)
                n = int(times.sum())
                recall = 0.0 if dark > 10 * n_samples else n / (n + dark)
                out += [(pep, t.tolist(), int(k), recall) for t, k in zip(tracks, times, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in out], pa.int64()), pa.array([r[1] for r in out], pa.list_(pa.int32())), pa.array([r[2] for r in out], pa.int64()), pa.array([r[3] for r in out], pa.float64())], names=["pep_i", "dyt", "n", "recall"])

    return peps.select("pep_i", "channels").mapInArrow(run, "pep_i long, dyt array<int>, n long, recall double")


def track_counts(found: DataFrame) -> DataFrame:
    """(dyt, n): reads of each track over all peptides."""
    return found.groupBy("dyt").agg(F.sum("n").alias("n"))


def numbered_tracks(found: DataFrame) -> DataFrame:
    """(dyt_i, dyt): distinct tracks in lexical order, so the dark one is 0; it is there even if no read was dark."""
    size = F.size("dyt")
    dark = found.select(F.array_repeat(F.lit(0), size).alias("dyt")).limit(1)
    return numbered(found.select("dyt").unionByName(dark.select(F.col("dyt").cast("array<int>").alias("dyt"))).distinct(), "dyt", "dyt_i")


def by_peptide(counts: DataFrame) -> DataFrame:
    """Counts (dyt_i, pep_i, n) in the order of peptides, most reads first."""
    return counts.orderBy("pep_i", F.col("n").desc(), "dyt_i")


def redrawn(counts: DataFrame, n: int, seed: int = 1) -> DataFrame:
    """(dyt_i, pep_i, n): exactly n reads of each peptide with any, drawn anew in proportion to its counts.

    One multinomial draw a peptide, which depends on seed and peptide alone; tracks without a read go.
    """

    def draw(group: pa.Table) -> pa.Table:
        group = group.sort_by("dyt_i")
        pep, times = group.column("pep_i")[0].as_py(), np.array(group.column("n").to_pylist(), float)
        if times.sum() <= 0:
            return group.slice(0, 0).select(["dyt_i", "pep_i", "n"])
        rng = np.random.default_rng(int.from_bytes(hashlib.sha256(f"{seed}|{pep}".encode()).digest()[:8], "little"))
        drawn = rng.multinomial(n, times / times.sum())
        kept = np.flatnonzero(drawn)
        return pa.table({"dyt_i": group.column("dyt_i").take(pa.array(kept)), "pep_i": pa.array([pep] * len(kept), pa.int64()), "n": pa.array(drawn[kept].astype(np.int64))})

    rows = counts.select(F.col("dyt_i").cast("long").alias("dyt_i"), F.col("pep_i").cast("long").alias("pep_i"), F.col("n").cast("long").alias("n"))
    return rows.groupBy("pep_i").applyInArrow(draw, "dyt_i long, pep_i long, n long")


def photobleach(n_cycles: int, p_bleach: float, seed: int = 1) -> Chemistry:
    """One channel whose dyes only bleach: no other failures, no Edman cycles."""
    return Chemistry(n_channels=1, cycles=(PRE, *[MOCK] * n_cycles), p_bright=(1.0,), p_bleach=(p_bleach,), p_cyclic_block=0.0, p_initial_block=0.0, p_detach=0.0, p_edman_failure=0.0, p_mislabel=(0.0,), seed=seed)


def one_each(tracks: DataFrame, n: int = 1) -> DataFrame:
    """(dyt_i, pep_i, n, recall): every track is its own peptide's, n times with recall 1; the dark one, number 0, not at all."""
    lit = F.col("dyt_i") != 0
    return tracks.select("dyt_i", F.col("dyt_i").alias("pep_i"), F.when(lit, n).otherwise(0).cast("long").alias("n"), F.when(lit, 1.0).otherwise(0.0).alias("recall"))


def fret(donor: Column, acceptors: Column, strength: float, by_count: bool, self_quench: bool = False) -> Column:
    """Donor brightness left beside acceptors, without noise: times (1 - strength), clipped, to the power of their number."""
    k = F.greatest(acceptors - (1 if self_quench else 0), F.lit(0))
    return donor * F.pow(F.lit(clipped(1 - strength)), k if by_count else (k > 0).cast("int"))


def noisy_fret(donor: Column, acceptors: Column, strength: float, spread: float, by_count: bool, seed: int, *keys: str) -> Column:
    """Donor brightness left beside acceptors, where the strength varies from read to read about its mean; it is clipped to [0, 1] in every read."""
    drawn = F.least(F.lit(1.0), F.greatest(F.lit(0.0), strength + spread * _normal(seed, *keys)))
    return donor * F.pow(1 - drawn, acceptors if by_count else (acceptors > 0).cast("int"))


def _normal(seed: int, *keys: str) -> Column:
    """A standard normal draw that depends on seed and keys alone."""
    uniform = lambda salt: (F.pmod(F.xxhash64(F.lit(seed), F.lit(salt), *keys), F.lit(1 << 52)) + 0.5) / float(1 << 52)
    return F.sqrt(-2 * F.log(uniform("r"))) * F.cos(2 * np.pi * uniform("a"))


def radmats(found: DataFrame, chem: Chemistry, gains: Gains, seed: int = 7) -> DataFrame:
    """(pep_i, dyt, read_i, row_k, radmat): a row a read, with noisy brightness of its track. Catalyst only."""
    reads = found.filter("n > 0").withColumn("read_i", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n")))).withColumn("row_k", 1 + gains.row_k_sigma * _normal(seed, "pep_i", "dyt", "read_i"))
    n_cy = len(chem.cycles)
    # Draws of a read come from its own number and the place in its track, so cells are made where the read is.
    reads = reads.withColumn("key", F.xxhash64(F.lit(seed + 1), "pep_i", "dyt", "read_i"))

    def cell(k: Column, at: Column) -> Column:
        pick = lambda values: F.get(F.array(*map(F.lit, values)), F.floor(at / n_cy).cast("int"))
        uniform = lambda salt: (F.pmod(F.xxhash64(F.col("key"), at, F.lit(salt)), F.lit(1 << 52)) + 0.5) / float(1 << 52)
        normal = F.sqrt(-2 * F.log(uniform("r"))) * F.cos(2 * np.pi * uniform("a"))
        spread = F.sqrt(k * F.pow(pick(gains.gain_sigma), 2) + F.pow(pick(gains.bg_sigma), 2))
        return (k * pick(gains.gain_mu) + pick(gains.bg_mu) + spread * normal) * F.col("row_k")

    return reads.select("pep_i", "dyt", "read_i", "row_k", F.transform("dyt", cell).alias("radmat"))
