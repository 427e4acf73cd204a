"""Document fingerprints by one-permutation MinHash. DataFrame functions only.

A text is lower-cased and split at ASCII white space; its set holds the hashes of its runs of five
words, or of all its words if it has fewer. The top bits of a hash name one of BINS bins, and a bin
keeps its smallest hash: every shingle is hashed once. An empty bin borrows from the first filled one
among bins that hashes of its own number name one after the other (optimal densification), at last
from one of the filled bins by its number. The low BITS bits of each bin, packed, are the
fingerprint; as unequal bins agree in so many bits by chance, the share of agreeing bins is
corrected for that: (share - c) / (1 - c), c = 2^-BITS.

Cases: null and empty texts, and texts of white space only, have the empty fingerprint, alike to
each other (1) and to nothing else (0); equal texts have equal fingerprints; extra columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import join_small, materialize

#: Words in a shingle, bins and bits kept of each, tries of an empty bin before it takes any filled one.
WORDS, BIN_BITS, BITS, TRIES = 5, 7, 8, 24
BINS = 1 << BIN_BITS
WHITE = " \t\n\x0b\f\r"
#: Documents in a bucket of the order by doc_id on average, and slices of that order by its quantiles.
PER_BUCKET, SLICES = 2000, 64


def _probe(number: Column, attempt: int) -> Column:
    """The bin that an empty bin tries at its attempt: a universal hash of its number."""
    prime = 8191
    return (number * (2 * attempt * attempt + 1237 * attempt + 611) + 7919 * attempt) % prime % BINS


def fingerprint(df: DataFrame, text: str, name: str) -> DataFrame:
    """Adds column name: the kept bits of each bin as an array of bytes, empty for a text without words."""
    words, hashes, sets, mins, bins, bytes_ = (f"_{name}_{x}" for x in ("words", "hashes", "set", "mins", "bins", "bytes"))
    trimmed = F.btrim(F.lower(F.coalesce(F.col(text), F.lit(""))), F.lit(WHITE))
    df = df.withColumn(words, F.split(trimmed, r"[\x20\x09-\x0D]+"))
    df = df.withColumn(hashes, F.when((F.size(words) == 1) & (F.element_at(words, 1) == ""), F.array().cast("array<bigint>")).otherwise(F.transform(words, lambda w: F.xxhash64(w))))
    starts = F.sequence(F.lit(0), F.greatest(F.lit(0), F.size(hashes) - WORDS))
    shingles = F.transform(starts, lambda i: F.xxhash64(*(F.get(F.col(hashes), i + k) for k in range(WORDS))))
    df = df.withColumn(sets, F.when(F.size(hashes) == 0, F.array().cast("array<bigint>")).otherwise(F.sort_array(shingles)))
    number = lambda x: F.shiftrightunsigned(x, 64 - BIN_BITS)
    # Sorted, the bins' hashes follow each other: the first of each bin is its smallest.
    df = df.withColumn(mins, F.filter(sets, lambda x, i: (i == 0) | (number(x) != number(F.get(F.col(sets), i - 1)))))
    df = df.withColumn(bins, F.transform(mins, lambda x: number(x).cast("int"))).withColumn(bytes_, F.transform(mins, lambda x: x.bitwiseAND((1 << BITS) - 1).cast("short")))
    held = lambda b: F.get(F.col(bytes_), (F.array_position(F.col(bins), b.cast("int")) - 1).cast("int"))
    filled = F.transform(F.sequence(F.lit(0), F.lit(BINS - 1)), lambda b: F.coalesce(held(b), *(held(_probe(b, t)) for t in range(1, TRIES + 1)), F.get(F.col(bytes_), b % F.size(bytes_))))
    df = df.withColumn(name, F.when(F.size(bins) == 0, F.array().cast("array<smallint>")).otherwise(filled))
    return df.drop(words, hashes, sets, mins, bins, bytes_)


def packed(bits: str) -> Column:
    """A fingerprint as text: two hex digits a bin."""
    return F.array_join(F.transform(bits, lambda v: F.lpad(F.hex(v), BITS // 4, "0")), "")


def likeness(left: str, right: str) -> Column:
    """The estimated Jaccard likeness of two fingerprints' sets, corrected for chance agreement."""
    chance = 2.0**-BITS
    share = F.aggregate(F.zip_with(left, right, lambda x, y: (x == y).cast("int")), F.lit(0), lambda a, x: a + x) / BINS
    both = (F.size(left) == 0) & (F.size(right) == 0)
    either = (F.size(left) == 0) | (F.size(right) == 0)
    return F.when(both, 1.0).when(either, 0.0).otherwise(F.greatest(F.lit(0.0), (share - chance) / (1 - chance)))


def with_next(docs: DataFrame, per_bucket: int = PER_BUCKET) -> DataFrame:
    """Adds next_<column> for every column: the row that follows by descending doc_id, the first after the last.

    Equal ids are ordered by text, null ids come last. The order is cut into buckets by its quantiles,
    and evenly between these. Each bucket's first row also goes, as a mark that isn't returned, to the
    bucket before; so a window a bucket finds every next row, and no task holds the whole order.
    """
    columns = docs.columns
    few = docs.agg(F.count("*").alias("n"), F.percentile_approx("doc_id", [i / SLICES for i in range(1, SLICES)], 10000).alias("cuts"), F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).first()
    if few["n"] == 0 or few["low"] is None:
        edges = [0, 1]
    else:
        edges = sorted({few["low"], *few["cuts"], few["high"] + 1})
    fine = max(1, few["n"] // (per_bucket * max(1, len(edges) - 1)))
    lows = F.array(*(F.lit(x).cast("long") for x in edges))
    low, high = F.get(lows, F.col("_slot")), F.get(lows, F.col("_slot") + 1)
    within = F.floor((F.col("doc_id") - low) / F.greatest(F.lit(1.0), (high - low) / fine))
    bucket = F.when(F.col("doc_id").isNull(), F.lit(-1)).otherwise(F.col("_slot") * fine + F.least(F.lit(fine - 1), within)).cast("long")
    placed = docs.withColumn("_slot", F.size(F.filter(lows, lambda e: e <= F.col("doc_id"))) - 1).withColumn("_bucket", bucket).drop("_slot")
    heads = materialize(placed.select("_bucket", "doc_id").groupBy("_bucket").agg(F.max("doc_id").alias("_head")), "order-heads")
    # One row a bucket: a window over all of them is small.
    whole = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    above = F.coalesce(F.lead("_bucket").over(Window.orderBy("_bucket")), F.first("_bucket").over(whole))
    heads = materialize(heads.select(F.col("_bucket").alias("_of"), "_head", above.alias("_above")), "order-marks")
    marked = join_small(placed, heads, F.col("_bucket") == F.col("_of"))
    is_head = F.col("doc_id").eqNullSafe(F.col("_head"))
    copy = lambda b, mark: F.struct(F.col(b).alias("b"), F.lit(mark).alias("mark"))
    copies = F.when(is_head, F.array(copy("_bucket", False), copy("_above", True))).otherwise(F.array(copy("_bucket", False)))
    dealt = marked.withColumn("_copy", F.explode(copies)).select(*columns, "_copy.b", "_copy.mark")
    order = Window.partitionBy("b").orderBy("mark", F.col("doc_id").desc_nulls_last(), "text")
    following = F.lead(F.struct(*columns)).over(order)
    return dealt.withColumn("_next", following).filter(~F.col("mark")).select(*columns, *(F.col(f"_next.{c}").alias(f"next_{c}") for c in columns))


def fingerprints_of_edits(docs: DataFrame) -> DataFrame:
    """Fingerprints of texts and of their edits: the last floor(n / 2) code points replaced by the next text's first."""
    own = fingerprint(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")), "text", "bits")
    both = with_next(own).withColumn("n_chars", F.char_length("text").cast("long")).withColumn("half", F.floor(F.col("n_chars") / 2).cast("int"))
    edited = F.concat(F.substring("text", F.lit(1), F.char_length("text") - F.col("half")), F.substring("next_text", F.lit(1), F.col("half")))
    both = both.select("doc_id", "n_chars", "bits", "next_bits", edited.alias("edited"))
    both = fingerprint(both, "edited", "edited_bits")
    return both.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), packed("bits").alias("fingerprint"), packed("edited_bits").alias("edited_fingerprint"), likeness("bits", "edited_bits").alias("near_edited"), likeness("bits", "next_bits").alias("near_next"))
