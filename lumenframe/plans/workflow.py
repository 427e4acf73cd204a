"""Workflows as functions of DataFrames: digest, simulate, survey, train and test, classify; and their parameters."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import asdict, dataclass, field, fields as fields_of, is_dataclass
from typing import Any, get_type_hints

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions import seq
from ..operators import evaluate, forest, relational, simulate, survey
from ..sources import results


class Priors:
    """Named values looked up by exact name, then by dotted parents, then among defaults by the first part."""

    def __init__(self, values: dict[str, Any], defaults: dict[str, Any] | None = None):
        self.values, self.defaults = dict(values), dict(defaults or {})

    def get(self, name: str) -> Any:
        parts = name.split(".")
        for n in range(len(parts), 0, -1):
            if (key := ".".join(parts[:n])) in self.values:
                return self.values[key]
        if parts[0] in self.defaults:
            return self.defaults[parts[0]]
        raise KeyError(name)


@dataclass
class Job:
    """What a workflow needs. Limits below 0 are unset: a test set is then as large as the training set."""

    enzymes: list[str] = field(default_factory=lambda: ["lysc"])
    labels: list[str] = field(default_factory=lambda: ["DE", "Y"])
    n_cycles: int = 8
    n_samples: int = 100
    n_samples_test: int = -1
    decoys: bool = False
    seed: int = 1

    def __post_init__(self) -> None:
        unknown = [e for e in self.enzymes if e not in seq.ENZYMES]
        if unknown:
            raise ValueError(f"unknown enzymes: {unknown}")
        if not self.labels or self.n_cycles < 1 or self.n_samples < 1 or self.n_samples_test == 0:
            raise ValueError("a job needs labels, cycles and samples")


def parse_job(text: dict[str, Any], kind: type = Job) -> Any:
    """A dataclass from nested dicts; unknown names and wrong types are errors."""
    hints = get_type_hints(kind)
    known = {f.name for f in fields_of(kind)}
    extra = set(text) - known
    if extra:
        raise ValueError(f"{kind.__name__} has no {sorted(extra)}")
    values = {}
    for name, value in text.items():
        hint = hints[name]
        plain = getattr(hint, "__origin__", hint)
        if is_dataclass(hint) and isinstance(value, dict):
            value = parse_job(value, hint)
        elif isinstance(plain, type) and not (isinstance(value, plain) or plain is float and isinstance(value, int)) or plain is int and isinstance(value, bool):
            raise ValueError(f"{name} is {type(value).__name__}, not {plain.__name__}")
        values[name] = value
    return kind(**values)


def assert_schema(df: DataFrame, expected: StructType, allow_extra: bool = False) -> DataFrame:
    """The frame itself if its columns have the expected types; no job runs."""
    have, want = dict(df.dtypes), {f.name: f.dataType.simpleString() for f in expected}
    wrong = {n: (have.get(n), t) for n, t in want.items() if have.get(n) != t}
    extra = set() if allow_extra else set(have) - set(want)
    if wrong or extra:
        raise TypeError(f"wrong columns {wrong}, unexpected {sorted(extra)}")
    return df


def digested(proteins: DataFrame, job: Job) -> DataFrame:
    """Peptides of proteins (pro_i, tokens), numbered densely, with labelled patterns and channels."""
    peps = relational.peptides(proteins, seq.fragments(F.col("tokens"), *job.enzymes))
    numbered = relational.dense_ids(peps, "pro_i", "pep_in_pro", "pep_i")
    channel: Column = F.lit(-1)
    return numbered.withColumn("flustr", seq.flu(F.col("pep"), job.labels, job.n_cycles)).withColumn("channels", F.transform("pep", lambda t: F.coalesce(*[F.when(F.substring(t, 1, 1).isin(*r), F.lit(i)) for i, r in enumerate(job.labels)], channel)))


def simulated(peps: DataFrame, job: Job, test: bool = False) -> tuple[DataFrame, simulate.Chemistry]:
    """Tracks of all peptides; the test set is drawn by itself."""
    n = len(job.labels)
    chem = simulate.Chemistry(n_channels=n, cycles=(simulate.PRE, *[simulate.EDMAN] * job.n_cycles), p_bright=(0.82,) * n, p_bleach=(0.06,) * n, p_mislabel=(0.0,) * n, seed=job.seed + 1_000_003 * test)
    return simulate.dye_tracks(peps, job.n_samples_test if test and job.n_samples_test > 0 else job.n_samples, chem), chem


def surveyed(peps: DataFrame, job: Job, k: int = 10) -> DataFrame:
    """(pep_i, score): isolation of each peptide among all simulated tracks."""
    found, _ = simulated(peps, job)
    tracks = relational.numbered(found.filter("n > 0").select("dyt").distinct(), "dyt", "dyt_i").select("dyt_i", "dyt")
    counts = found.filter("n > 0").join(tracks, "dyt").select("dyt_i", "pep_i", "n")
    near = survey.nearest_tracks(tracks.select("dyt_i", F.col("dyt").cast("array<double>").alias("vec")), k)
    return survey.isolation(counts, near, relational.most_likely(counts))


def trained_and_tested(peps: DataFrame, job: Job, n_trees: int = 20, depth: int = 10) -> tuple[DataFrame, DataFrame]:
    """Calls of a test set by a forest of a training set, whose tracks and noise are drawn apart, and their precision and recall by class."""
    gains = simulate.Gains(*((v,) * len(job.labels) for v in (8000.0, 1200.0, 0.0, 150.0)))

    def rows(test: bool) -> DataFrame:
        found, chem = simulated(peps, job, test)
        return simulate.radmats(found, chem, gains, 23 if test else 11).select(F.xxhash64("pep_i", "dyt", "read_i").alias("row_i"), "radmat", F.col("pep_i").alias("class_i"))

    model, classes = forest.train(rows(False), n_trees, depth, seed=job.seed)
    calls = forest.classify(rows(True), model, classes, ("class_i",)).withColumnRenamed("class_i", "true_i")
    return calls, evaluate.precision_recall(evaluate.confusion(calls))


def drawn(priors: dict[str, Any], seed: int = 1) -> dict[str, float]:
    """A value of each prior: numbers stay, {"mean", "sd"} is normal, {"low", "high"} uniform; each depends on seed and name alone, and chances (names `p_...`) stay in [0, 1]."""
    out = {}
    for name, prior in priors.items():
        rng = np.random.default_rng([seed, *name.encode()])
        value = prior if not isinstance(prior, dict) else rng.normal(prior["mean"], prior["sd"]) if "mean" in prior else rng.uniform(prior["low"], prior["high"])
        out[name] = simulate.clipped(float(value)) if name.split(".")[-1].startswith("p_") else float(value)
    return out


def remapped(priors: dict[str, Any], channels: list[int]) -> dict[str, Any]:
    """Priors of chosen channels, numbered anew from 0: names end in `.ch_<i>`; shifts (`shift_y.`, `shift_x.`) are told from the new first channel."""
    out = {k: v for k, v in priors.items() if ".ch_" not in k}
    for new, old in enumerate(channels):
        for k, v in priors.items():
            name, _, ch = k.rpartition(".ch_")
            if name and ch == str(old):
                base = priors.get(f"{name}.ch_{channels[0]}", 0) if name.split(".")[-1] in ("shift_y", "shift_x") else 0
                out[f"{name}.ch_{new}"] = v - base if base else v
    return out


def described(kind: type = Job) -> list[tuple[str, str, Any]]:
    """Name, type and default of a job's fields, nested ones by dotted names."""
    hints, out = get_type_hints(kind), []
    blank = kind()
    for f in fields_of(kind):
        value = getattr(blank, f.name)
        if is_dataclass(value):
            out += [(f"{f.name}.{n}", t, v) for n, t, v in described(type(value))]
        else:
            out.append((f.name, getattr(hints[f.name], "__name__", str(hints[f.name])), value))
    return out


def filled(template: str, values: dict[str, Any]) -> str:
    """A text whose `{name}`s are replaced by dotted names among nested values; an unknown name is an error."""

    def value(match) -> str:
        at: Any = values
        for part in match.group(1).split("."):
            at = at[int(part)] if isinstance(at, list) else at[part]
        return str(at)

    return re.sub(r"\{([A-Za-z_][\w.]*)\}", value, template)


def write_job(spark, path: str, job: Any, tables: dict[str, DataFrame]) -> results.Results:
    """A job's folder: its parameters in the manifest, its tables beside it."""
    return results.Results.write(spark, path, tables, kind=type(job).__name__, **asdict(job))


def read_job(spark, path: str, kind: type = Job) -> tuple[Any, results.Results]:
    """The job that a folder was written for, and its results."""
    found = results.Results(spark, path)
    params = {k: v for k, v in found.manifest["params"].items() if k != "kind"}
    return parse_job(params, kind), found


#: Workflows by name: each takes peptides and a job, and returns tables by name.
GENERATORS: dict[str, Callable[[DataFrame, Job], dict[str, DataFrame]]] = {
    "simulate": lambda peps, job: {"tracks": simulated(peps, job)[0], "test_tracks": simulated(peps, job, True)[0]},
    "survey": lambda peps, job: {"isolation": surveyed(peps, job)},
    "classify": lambda peps, job: dict(zip(("calls", "by_class"), trained_and_tested(peps, job), strict=True)),
}


def run(name: str, proteins: DataFrame, job: Job) -> dict[str, DataFrame]:
    """A workflow over proteins (pro_i, tokens)."""
    if name not in GENERATORS:
        raise ValueError(f"unknown workflow {name}; there are {sorted(GENERATORS)}")
    return GENERATORS[name](digested(proteins, job), job)
