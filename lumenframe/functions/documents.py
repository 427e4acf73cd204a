"""Search and update of nested values by wild-card paths, on VARIANT columns."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A step: a name, `*` (every member of an object), `[*]` (every element), `[3]` (one element), `**` (any depth, from none).
STEP = re.compile(r"\*\*|\*|\[\*\]|\[\d+\]|[^.\[\]*]+")
DEPTH = 8


def steps_of(path: str) -> list[str]:
    found = STEP.findall(path)
    if "".join(found) != path.replace(".", ""):
        raise ValueError(f"not a path: {path}")
    return found


def _name(step: str) -> str:
    return "$" + (step if step.startswith("[") else f"['{step}']" if not re.fullmatch(r"\w+", step) else f".{step}")


def _exploded(rows: DataFrame, objects: bool) -> DataFrame:
    """A row a member or element of the column _value, with its place added to _path."""
    spark = rows.sparkSession
    inner = spark.tvf.variant_explode(F.col("_value").outer()).select(F.col("pos").alias("_pos"), F.col("key").alias("_key"), F.col("value").alias("_inner"))
    joined = rows.lateralJoin(inner)
    joined = joined.filter("_key is not null" if objects else "_key is null")
    place = F.concat("_path", F.lit("."), F.col("_key")) if objects else F.concat("_path", F.lit("["), F.col("_pos").cast("string"), F.lit("]"))
    return joined.withColumn("_path", place).drop("_value", "_pos", "_key").withColumnRenamed("_inner", "_value")


def found(rows: DataFrame, value: str, path: str, depth: int = DEPTH) -> DataFrame:
    """The other columns with path and value (a VARIANT) of all places that match a path: a row a place.

    A name is one lookup, a wild card explodes one level, and `**` looks at every level down to `depth`.
    """
    out = rows.withColumnRenamed(value, "_value").withColumn("_path", F.lit("$"))
    for step in steps_of(path):
        if step == "**":
            level, every = out, out
            for _ in range(depth):
                level = _exploded(level, True).unionByName(_exploded(level, False))
                every = every.unionByName(level)
            out = every
        elif step in ("*", "[*]"):
            out = _exploded(out, step == "*")
        else:
            name = step if step.startswith("[") else f".{step}"
            out = out.withColumn("_value", F.try_variant_get("_value", _name(step), "variant")).withColumn("_path", F.concat("_path", F.lit(name))).filter("_value is not null")
    return out.withColumnsRenamed({"_path": "path", "_value": "value"})


def updated(value: Column, path: str, change) -> Column:
    """The variant with what is at a path's places changed: change takes the old value (null where a named member is missing) to the new one, a VARIANT.

    Only objects and arrays on the path are rewritten. A member that is missing is added; arrays aren't made longer.
    """
    return _updated(value, steps_of(path), change)


def _updated(value: Column, steps: list[str], change) -> Column:
    if not steps:
        return change(value)
    step, rest = steps[0], steps[1:]
    if step == "**":
        raise ValueError("an update names its levels")
    kind = F.schema_of_variant(value)
    members, elements = F.try_variant_get(value, "$", "map<string,variant>"), F.try_variant_get(value, "$", "array<variant>")
    if step == "*":
        new = F.to_variant_object(F.transform_values(members, lambda k, v: _updated(v, rest, change)))
        return F.when(kind.startswith("OBJECT"), new).otherwise(value)
    if step.startswith("["):
        at = None if step == "[*]" else int(step[1:-1])
        new = F.to_variant_object(F.transform(elements, (lambda v: _updated(v, rest, change)) if at is None else (lambda v, i: F.when(i == at, _updated(v, rest, change)).otherwise(v))))
        return F.when(kind.startswith("ARRAY"), new).otherwise(value)
    # A missing value (null, unlike a JSON null) becomes an object if a name is wanted in it.
    old = F.element_at(members, F.lit(step))
    inner = _updated(old, rest, change)
    one = F.to_variant_object(F.create_map(F.lit(step), inner))
    new = F.to_variant_object(F.map_concat(F.map_filter(members, lambda k, v: k != step), F.create_map(F.lit(step), inner)))
    return F.when(value.isNull() & inner.isNotNull(), one).when(kind.startswith("OBJECT") & inner.isNotNull(), new).otherwise(value)
