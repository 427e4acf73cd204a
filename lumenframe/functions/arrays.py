"""Numeric vectors as array columns, and scalar helpers. All in Catalyst."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_divide(a: Column, b: Column, default: float = 0.0) -> Column:
    """a / b; default where b is 0, null or NaN."""
    return F.when(b.isNull() | F.isnan(b.cast("double")) | (b == 0), F.lit(default)).otherwise(F.try_divide(a.cast("double"), b.cast("double")))


def clip(x: Column, low: float, high: float) -> Column:
    return F.least(F.greatest(x, F.lit(low)), F.lit(high))


def sum_of(a: Column) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda s, x: s + x)


def prefix_sums(a: Column) -> Column:
    """Running sums; quadratic in the array's length, which is a number of cycles."""
    return F.transform(a, lambda _, i: sum_of(F.slice(a, 1, i + 1)))


def lifespan(a: Column) -> Column:
    """Cycles that a trace stays bright: the k whose template of k ones is nearest by cosine, so most of sum(k) / sqrt(k); the least such k."""
    scored = F.transform(prefix_sums(a), lambda s, i: F.struct((-s / F.sqrt(i + 1.0)).alias("s"), (i + 1).alias("k")))
    return F.array_min(scored)["k"]


def max_rise(a: Column, life: Column) -> Column:
    """The most that a trace rises from cycle to cycle within its life, with a zero after its last cycle."""
    alive = F.slice(a, 1, life)
    ends = F.when(F.size(a) == life, F.concat(alive, F.array(F.lit(0.0)))).otherwise(alive)
    return F.array_max(F.zip_with(F.slice(ends, 1, F.greatest(F.lit(0), F.size(ends) - 1)), F.slice(ends, 2, F.greatest(F.lit(1), F.size(ends))), lambda x, y: y - x))


def run_of_true(a: Column) -> Column:
    """How many leading entries are true."""
    first = F.array_position(a, F.lit(False))
    return F.when(first == 0, F.size(a)).otherwise(first - 1).cast("int")


def nearest_index(sorted_values: Column, x: Column) -> Column:
    """Index of the nearest entry; the later of two as near wins."""
    return F.array_min(F.transform(sorted_values, lambda v, i: F.struct(F.abs(v - x).alias("d"), (-i).alias("i"))))["i"] * -1


def pad_end(a: Column, n: int, fill: Column) -> Column:
    return F.concat(a, F.array_repeat(fill, F.greatest(F.lit(0), F.lit(n) - F.size(a))))


def flatten_channels(radmat: Column) -> Column:
    return F.flatten(radmat)


def unflatten_channels(a: Column, n_channels: int, n_cycles: int) -> Column:
    return F.array(*(F.slice(a, c * n_cycles + 1, n_cycles) for c in range(n_channels)))


def is_power_of_two(n: Column) -> Column:
    return (n > 0) & (n.bitwiseAND(n - 1) == 0)


def next_power_of_two(n: Column) -> Column:
    return F.when(n <= 1, F.lit(1).cast("long")).otherwise(F.expr("1L") * F.pow(F.lit(2.0), F.ceil(F.log2(n.cast("double")))).cast("long"))


def numbers(a: Column) -> Column:
    """The entries that are numbers."""
    return F.filter(a, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")))


def nan_mean(a: Column) -> Column:
    """The mean of the entries that are numbers; NaN if none is."""
    held = numbers(a)
    return F.when(F.size(held) == 0, F.lit(float("nan"))).otherwise(sum_of(F.transform(held, lambda x: x.cast("double"))) / F.size(held))


def nan_median(a: Column) -> Column:
    """The median of the entries that are numbers; NaN if none is."""
    held = F.array_sort(numbers(a))
    n = F.size(held)
    middle = F.slice(held, F.floor((n + 1) / 2).cast("int"), F.when(n % 2 == 0, 2).otherwise(1))
    return F.when(n == 0, F.lit(float("nan"))).otherwise(sum_of(F.transform(middle, lambda x: x.cast("double"))) / F.size(middle))


def int_linspace(low: Column, high: Column, n: int) -> Column:
    """n whole numbers, evenly spread from low to high, both included; low alone if n is 1."""
    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: (low + F.floor((high - low) * i / max(1, n - 1))).cast("long"))


def sorted_rows(matrix: Column) -> Column:
    return F.transform(matrix, lambda row: F.array_sort(row))


def plucked(rows: Column, name: str) -> Column:
    """One field of an array of structs."""
    return F.transform(rows, lambda r: r[name])


def padded_rows(matrix: Column, fill: Column) -> Column:
    """Rows of equal length: shorter ones get the fill value at their ends."""
    n = F.array_max(F.transform(matrix, lambda r: F.size(r)))
    return F.transform(matrix, lambda r: F.concat(r, F.array_repeat(fill, n - F.size(r))))


def index_where(a: Column, true, last: bool = False) -> Column:
    """Index of the first entry that the predicate holds for, or of the last; null if there is none."""
    at = F.filter(F.transform(a, lambda x, i: F.when(true(x), i)), lambda i: i.isNotNull())
    return F.when(F.size(at) > 0, F.element_at(at, -1 if last else 1))


def entry_where(a: Column, true, last: bool = False) -> Column:
    """That entry itself."""
    return F.get(a, index_where(a, true, last))


def shifted(a: Column, n: int, fill: Column) -> Column:
    """Entries n places later, earlier for negative n; the fill value where none comes."""
    return F.transform(a, lambda _, i: F.when((i - n >= 0) & (i - n < F.size(a)), F.get(a, i - n)).otherwise(fill))


def rotated(a: Column, n: int) -> Column:
    """Entries n places earlier, those before the first at the end."""
    return F.transform(a, lambda _, i: F.get(a, F.pmod(i + n, F.size(a))))


def repeated(a: Column, n: int) -> Column:
    """Each entry n times."""
    return F.flatten(F.transform(a, lambda x: F.array_repeat(x, n)))


def times_rows(matrix: Column, by: Column) -> Column:
    """Each row of a matrix times its own factor."""
    return F.zip_with(matrix, by, lambda row, k: F.transform(row, lambda x: x * k))


def times_columns(matrix: Column, by: Column) -> Column:
    """Each column of a matrix times its own factor."""
    return F.transform(matrix, lambda row: F.zip_with(row, by, lambda x, k: x * k))


def same(a: Column, b: Column) -> Column:
    """Equal entry by entry, NaN and null each equal to itself."""
    return (F.size(a) == F.size(b)) & F.forall(F.zip_with(a, b, lambda x, y: x.eqNullSafe(y)), lambda x: x)


def magnitude(a: Column) -> Column:
    return F.sqrt(sum_of(F.transform(a, lambda x: x.cast("double") * x)))


def scaled_to_one(a: Column) -> Column:
    """Entries over the largest; unchanged if that is 0."""
    top = F.array_max(a)
    return F.transform(a, lambda x: F.when(top != 0, x / top).otherwise(x.cast("double")))


def region_of(at: Column, size: Column, n: int) -> Column:
    """In which of n equal regions of a side a place lies; an error outside of it."""
    inside = (at >= 0) & (at < size)
    return F.when(inside, F.floor(at * n / size).cast("int")).otherwise(F.raise_error(F.concat(F.lit("outside: "), at.cast("string"))).cast("int"))


def fourier(a: Column) -> Column:
    """The discrete Fourier transform as structs (re, im); quadratic, for traces over cycles."""
    n = F.size(a)

    def term(k: Column) -> Column:
        turn = lambda i: -2 * 3.141592653589793 * k * i / n
        return F.struct(sum_of(F.transform(a, lambda x, i: x * F.cos(turn(i)))).alias("re"), sum_of(F.transform(a, lambda x, i: x * F.sin(turn(i)))).alias("im"))

    return F.when(n > 0, F.transform(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))), term)).otherwise(F.array().cast("array<struct<re:double,im:double>>"))


def at_path(json: Column, path: str) -> Column:
    """The value at a dotted path, whose parts may be list indices, of a JSON text; null if it isn't there."""
    steps = "".join(f"[{p}]" if p.isdigit() else f".{p}" for p in path.split("."))
    return F.get_json_object(json, f"${steps}")


def masked(a: Column, mask: Column) -> Column:
    """Entries whose place in the mask is true; parallel arrays keep the same ones."""
    return F.filter(a, lambda _, i: F.coalesce(F.get(mask, i), F.lit(False)))
