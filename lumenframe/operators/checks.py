"""Checks of data: rules over nested columns, compiled to expressions and counted in one pass."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Rule:
    """path: dotted names, `[]` after an array's for its elements; broken: whether a row breaks it."""

    path: str
    name: str
    broken: Column


def compiled(spec: dict[str, dict], schema: T.StructType) -> tuple[list[str], list[Rule]]:
    """All faults of a schema by itself, and the rules for its rows.

    spec: column to its description. Keys of a description: type (a simple type name, `struct` or
    `array`), required (no null), min, max, choices, pattern (all of the text), min_len and max_len (of texts and arrays),
    fields (of a struct), elems (of an array), unknown ("refuse" names columns that the spec lacks).
    """
    faults: list[str] = []
    rules: list[Rule] = []
    fields = {f.name: f.dataType for f in schema.fields}
    for name, says in spec.items():
        if name not in fields:
            if says.get("required"):
                faults.append(f"{name}: missing")
            continue
        _walk(says, fields[name], name, F.col(f"`{name}`"), lambda x: x, faults, rules)
    return faults, rules


def _walk(says: dict, kind: T.DataType, path: str, value: Column, lift, faults: list[str], rules: list[Rule]) -> None:
    """Adds the faults and rules of one description. lift makes a test of this value one of the row."""
    wanted = says.get("type")
    actual = kind.typeName() if isinstance(kind, (T.StructType, T.ArrayType)) else kind.simpleString()
    if wanted and actual != wanted:
        faults.append(f"{path}: {actual} in place of {wanted}")
        return

    def add(name: str, broken: Column) -> None:
        rules.append(Rule(path, name, F.coalesce(lift(broken), F.lit(False))))

    if says.get("required"):
        add("required", value.isNull())
    if says.get("min") is not None:
        add("min", value < says["min"])
    if says.get("max") is not None:
        add("max", value > says["max"])
    if says.get("choices") is not None:
        add("choices", ~value.isin(*says["choices"]))
    if says.get("pattern") is not None:
        add("pattern", ~value.rlike(f"\\A(?:{says['pattern']})\\z"))
    length = F.size(value) if isinstance(kind, T.ArrayType) else F.char_length(value) if isinstance(kind, T.StringType) else None
    if length is not None:
        if says.get("min_len") is not None:
            add("min_len", length < says["min_len"])
        if says.get("max_len") is not None:
            add("max_len", length > says["max_len"])
    if isinstance(kind, T.StructType):
        inner = {f.name: f.dataType for f in kind.fields}
        for name, more in says.get("fields", {}).items():
            if name in inner:
                _walk(more, inner[name], f"{path}.{name}", value[name], lift, faults, rules)
            elif more.get("required"):
                faults.append(f"{path}.{name}: missing")
        if says.get("unknown") == "refuse":
            faults.extend(f"{path}.{name}: unknown" for name in inner if name not in says.get("fields", {}))
    if isinstance(kind, T.ArrayType) and "elems" in says:
        _inside(says["elems"], kind.elementType, f"{path}[]", value, lift, faults, rules)


def _inside(says: dict, kind: T.DataType, path: str, array: Column, lift, faults: list[str], rules: list[Rule]) -> None:
    """Descriptions of elements: a row breaks such a rule if any element does. Each rule gets a lambda of its own."""
    names: list[Rule] = []
    _walk(says, kind, path, F.lit(None).cast(kind), lambda x: x, faults, names)

    def test_of(k: int):
        def test(element: Column) -> Column:
            own: list[Rule] = []
            _walk(says, kind, path, element, lambda x: x, [], own)
            return own[k].broken

        return test

    rules.extend(Rule(r.path, r.name, F.coalesce(lift(F.exists(array, test_of(k))), F.lit(False))) for k, r in enumerate(names))


def _counts(rules: list[Rule], key: str) -> list[Column]:
    """A count and the first and last key of each rule: partial in every task, of bounded size."""
    out = []
    for i, rule in enumerate(rules):
        sample = F.when(rule.broken, F.col(key).cast("string"))
        out += [F.count_if(rule.broken).alias(f"n{i}"), F.min(sample).alias(f"first{i}"), F.max(sample).alias(f"last{i}")]
    return out


def violations(rows: DataFrame, rules: list[Rule], key: str) -> DataFrame:
    """(path, rule, n, first_key, last_key): a row a rule, with how many rows break it and two of their keys; one scan for all rules."""
    one = rows.agg(*(_counts(rules, key) or [F.count("*").alias("n")]))
    found = [F.struct(F.lit(r.path).alias("path"), F.lit(r.name).alias("rule"), F.col(f"n{i}").alias("n"), F.col(f"first{i}").alias("first_key"), F.col(f"last{i}").alias("last_key")) for i, r in enumerate(rules)]
    empty = F.array().cast("array<struct<path:string,rule:string,n:bigint,first_key:string,last_key:string>>")
    return one.select(F.inline(F.array(*found) if found else empty))


def observed(rows: DataFrame, rules: list[Rule], key: str) -> tuple[DataFrame, Observation]:
    """rows unchanged, and an observation that the pass which reads them fills: no scan is added. `told` reads it afterwards."""
    watch = Observation("checks")
    return rows.observe(watch, *_counts(rules, key)), watch


def told(watch: Observation, rules: list[Rule]) -> list[tuple[str, str, int, str | None, str | None]]:
    """(path, rule, n, first_key, last_key) of the rules that rows broke."""
    found = watch.get
    return [(r.path, r.name, found[f"n{i}"], found[f"first{i}"], found[f"last{i}"]) for i, r in enumerate(rules) if found[f"n{i}"]]


def required(rows: DataFrame, spec: dict[str, dict]) -> list[Rule]:
    """The rules of a spec; an error that names all faults of the schema if there are any."""
    faults, rules = compiled(spec, rows.schema)
    if faults:
        raise ValueError("; ".join(faults))
    return rules


def with_broken(rows: DataFrame, rules: list[Rule]) -> DataFrame:
    """Adds broken: the names (`path rule`) of the rules that a row breaks."""
    marks = F.array(*(F.when(r.broken, F.lit(f"{r.path} {r.name}")) for r in rules))
    return rows.withColumn("broken", F.filter(marks, lambda x: x.isNotNull()))
