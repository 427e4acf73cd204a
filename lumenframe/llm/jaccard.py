"""Exact Jaccard join of documents on word n-grams, with skipping by relations between sets.

1. Every text becomes its set of hashed n-grams. Equal sets, found by 128-bit digests, are one class.
2. Routing. Sets are put in bands of sizes, each 10/9 of the one before. The hash order of all n-grams
   is cut into m position blocks, m above the most elements in which two linked sets of a band can
   differ; so linked sets agree in at least one whole block. Lists of classes by (band, block, digest
   of the block) are the distributed index; a probe reads one list a block and skips all others.
   T more blocks than needed let empty blocks go unlisted, but for sets with over T of them.
   Where links take less likeness, blocks get small and unlike texts that share a passage agree in
   one: then lists are by single elements of rare prefixes. All elements have one order, in which those that
   several texts of a half of all texts hold come last; linked sets share one of their first
   n - ceil(t n) + 1 elements, and passages that many texts hold make no list.
3. Classes that meet in a list make clusters (connected components of the lists' stars). Each
   cluster's texts are gathered once, in units of bounded total size: of a large cluster, whole stars go
   to units; a star too large for a unit is compared within parts first, then across parts of different components.
4. In a unit, `skip_join` keeps an index of the sets' rare prefixes, whose lists lie in blocks by
   position, and skips blocks whose positions and sizes leave too little overlap. A set's overlaps
   with all others are derived from those of a similar set that has been answered, by adding and
   taking away the few lists in which the two differ. Sets known to be connected aren't compared.
5. Links give components; each document gets its class's.

The result is exact up to equal 64-bit hashes of unequal n-grams. No pairs within a class or list are
emitted; a unit returns a spanning forest of its links.

Cases: null and empty texts have the empty set and link with nothing; ids that repeat are one
document with several texts; rows with a null id take no part in links and have a null component;
extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import bisect
import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import join_hot, join_small, materialize
from .components import connected_components
from .wordhash import U, chunks, mix, shingle_sets

#: Words in a shingle, and the least intersection of linked sets in percent of their union: of the join, and of near copies.
WORDS, PERCENT = 3, 90
NEAR_WORDS, NEAR_PERCENT = 5, 80
#: Blocks beyond those that linked sets can spoil.
SPARE = 1
#: One text in so many counts for the order of n-grams, texts that hold a common one, and common ones that are told apart at most.
EVERY, OFTEN, COMMON = 2, 2, 4_000_000
#: Shingles that a unit of a cluster holds at most, but for a band's two parts.
UNIT = 1_000_000
#: Width of a position block in a unit's index.
BLOCK = 8
#: Keys of lists that a partition holds before it sends them on, and that a range of keys has on average.
LISTED = 1_000_000
#: Parts by first document in which a range's pairs are sent on.
DEALT = 64


def bands(percent: int, most: int = 1 << 40) -> list[int]:
    """The least size of every band: linked sets lie in one band or in neighbours."""
    least = [1]
    while least[-1] < most:
        least.append(max(least[-1] + 1, -(-least[-1] * 100 // percent)))
    return least


def spoiled(size: int, other: int, percent: int) -> int:
    """The most elements that linked sets of these sizes don't share: 100 i >= p u, with i + u the sum of the sizes."""
    return (size + other) * (100 - percent) // (100 + percent)


def signatures(items: np.ndarray, percent: int, least: list[int]) -> np.ndarray:
    """The list keys of a set in its own band and the next."""
    if not len(items):
        return np.zeros(0, U)
    own = bisect.bisect_right(least, len(items)) - 1
    out = []
    for band in (own, own + 1):
        top = least[band + 1] - 1
        bad = spoiled(top, top, percent)
        m = bad + 1 + (SPARE if bad else 0)
        block = ((items >> U(32)) * U(m) >> U(32)).astype(np.int64)
        begins = np.flatnonzero(np.diff(block, prepend=-1))
        digest = np.add.reduceat(mix(items + U(0x632BE59BD9B4E019)), begins)
        filled = block[begins]
        if m - len(begins) > SPARE:  # too many empty blocks to do without them
            empty = np.setdiff1d(np.arange(m), filled)
            filled, digest = np.concatenate((filled, empty)), np.concatenate((digest, np.zeros(len(empty), U)))
        out.append(mix(digest ^ mix(filled.astype(U) + U(band << 40))))
    return np.concatenate(out)


def rare_signatures(items: np.ndarray, percent: int, least: list[int], common: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """List keys of a set's rarest elements, as many as a linked set can't miss all of, in its own band and the next.

    common: the upper 48 bits of hashes that several texts of a sample hold, sorted, and how many do. They come
    last in the one order of all elements, the most frequent ones at its end; others go by their hashes.
    """
    n = len(items)
    if not n:
        return np.zeros(0, U)
    known, times = common
    often = np.zeros(n, np.int64)
    if len(known):
        own = items >> U(16)
        at = np.minimum(np.searchsorted(known, own), len(known) - 1)
        often = np.where(known[at] == own, times[at], 0)
    rare = items[np.lexsort((items, often))[: n - -(-n * percent // 100) + 1]]
    own = bisect.bisect_right(least, n) - 1
    return np.concatenate([mix(mix(rare + U(0x632BE59BD9B4E019)) + U(band << 40)) for band in (own, own + 1)])


def common_items(docs: DataFrame, words: int, percent: int, total: int) -> tuple[np.ndarray, np.ndarray]:
    """The upper 48 bits of hashes of n-grams that OFTEN different texts of one in EVERY hold, sorted, with their number of texts.

    Only hashes of the lower part of their range are counted, from which rare prefixes mostly come. The
    counts only order elements, and any order gives the same links: of more than COMMON hashes the most frequent ones are kept.
    """
    buckets = 1 << max(4, (total // EVERY // LISTED).bit_length())
    low = U(int(min(1.0, 2.5 * (100 - percent) / 100) * ((1 << 48) - 1)))
    shift = U(48 - buckets.bit_length() + 1)
    chosen = docs.filter(F.pmod(F.xxhash64("text"), F.lit(EVERY)) == 0).select("text").distinct()

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, texts in chunks(batch.column("text").to_pylist()):
                found = [s >> U(16) for s in shingle_sets(texts, words)]
                keys, n = np.unique(np.concatenate(found), return_counts=True) if found else (np.zeros(0, U), np.zeros(0, np.int64))
                keys, n = keys[keys <= low], n[keys <= low]
                cuts = np.searchsorted(keys, np.arange(buckets + 1).astype(U) << shift)
                spans = [(k, x, y) for k, (x, y) in enumerate(zip(cuts.tolist(), cuts[1:].tolist(), strict=False)) if x < y]
                yield pa.RecordBatch.from_arrays([pa.array([k for k, *_ in spans], pa.int32()), pa.array([_packed(keys[x:y], n[x:y]) for _, x, y in spans], pa.binary())], names=["bucket", "blob"])

    def count(group: pa.Table) -> pa.Table:
        keys, n = (np.concatenate(x) for x in zip(*map(_unpacked, group.column("blob").to_pylist()), strict=True))
        order = np.argsort(keys, kind="stable")
        keys, n = keys[order], n[order]
        begins = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        sums = np.add.reduceat(n, begins)
        often = sums >= OFTEN
        return pa.table({"item": pa.array(keys[begins][often].astype(np.int64)), "n": pa.array(sums[often], pa.int64())})

    counts = materialize(chosen.mapInArrow(send, "bucket int, blob binary").groupBy("bucket").applyInArrow(count, "item long, n long"), "common-grams")
    found = (counts if counts.count() <= COMMON else counts.orderBy(F.col("n").desc(), "item").limit(COMMON)).toArrow()
    items = found.column("item").to_numpy().astype(U)
    order = np.argsort(items)
    return items[order], found.column("n").to_numpy()[order]


def _described(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, n, d1 and d2 (the set's digest) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, texts in chunks(batch.column("text").to_pylist()):
                sets = shingle_sets(texts, words)
                n = np.array([len(s) for s in sets], np.int64)
                digests = [np.array([mix(s ^ U(k)).sum(dtype=U) for s in sets], U).astype(np.int64) for k in (0x2545F4914F6CDD1D, 0x5851F42D4C957F2D)]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(begin, len(texts)), pa.array(n), *map(pa.array, digests)], names=["doc_id", "n", "d1", "d2"])

    return docs.mapInArrow(run, "doc_id long, n long, d1 long, d2 long")


def skip_join(ids: np.ndarray, sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """A spanning forest, as pairs of ids, of the links between sets (sorted arrays, none empty)."""
    order = sorted(range(len(sets)), key=lambda i: (len(sets[i]), ids[i]))
    ids, sets = ids[order], [sets[i] for i in order]
    sizes = np.array([len(s) for s in sets])
    of = np.repeat(np.arange(len(sets)), sizes)
    _, item, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    rank = np.empty(len(count), np.int64)
    rank[np.argsort(count, kind="stable")] = np.arange(len(count))  # rare first
    begins = np.concatenate(([0], np.cumsum(sizes)))
    item = rank[item.ravel()]
    item = item[np.lexsort((item, of))]
    ranked = [item[a:b] for a, b in zip(begins, begins[1:], strict=False)]
    frequency = np.sort(count)
    position = np.arange(len(item)) - begins[of]
    # All lists, for overlaps: the sets that hold an item.
    by_item = np.argsort(item, kind="stable")
    holders, list_at = of[by_item], np.concatenate(([0], np.cumsum(frequency)))
    # The index: prefixes only, in blocks by position, sets by size within a block.
    prefix = sizes - -(-sizes * percent // 100) + 1
    inside = np.flatnonzero((position < prefix[of]) & (frequency[item] > 1))
    inside = inside[np.lexsort((of[inside], position[inside] // BLOCK, item[inside]))]
    cut = np.flatnonzero(np.diff(item[inside], prepend=-1) | np.diff(position[inside] // BLOCK, prepend=-1))
    index: dict[int, list[tuple[int, np.ndarray]]] = {}
    for a, b in zip(cut, np.append(cut, len(inside))[1:], strict=True):
        index.setdefault(int(item[inside[a]]), []).append((int(position[inside[a]]) // BLOCK * BLOCK, of[inside[a:b]]))
    root = np.arange(len(sets))

    def overlaps(items: np.ndarray) -> np.ndarray:
        return np.bincount(np.concatenate([holders[list_at[t] : list_at[t + 1]] for t in items]), minlength=len(sets)) if len(items) else np.zeros(len(sets), np.int64)

    answered: list[tuple[int, np.ndarray]] = []  # sets with their overlaps with all sets
    forest = []
    p, q = percent, 100 + percent  # linked: overlap * q >= p * (sum of sizes)
    for x in range(len(sets)):
        n, own = int(sizes[x]), ranked[x]
        near = []
        for i in range(int(prefix[x])):
            for begin, members in index.get(int(own[i]), ()):
                # What is left after position i of x, and after the block's first position of the other, must hold the overlap.
                low, high = max(-(-n * p // 100), -(-(p * n + q * begin) // 100)), min(n * 100 // p, (100 * n - q * i) // p)
                a, b = np.searchsorted(sizes[members], (low, high + 1)) if len(members) > 4 else (0, len(members))
                if a < b:
                    near.append(members[a:b])
        if not near:
            continue
        found = np.unique(np.concatenate(near))
        found = found[(root[found] != root[x]) & (sizes[found] * 100 >= p * n) & (sizes[found] * p <= 100 * n)]
        if not len(found):
            continue
        leader = max(answered, key=lambda r: r[1][x], default=None)
        if leader and sizes[leader[0]] + n - 2 * leader[1][x] < n // 2:
            other = ranked[leader[0]]
            overlap = leader[1] + overlaps(np.setdiff1d(own, other, assume_unique=True)) - overlaps(np.setdiff1d(other, own, assume_unique=True))
        else:
            overlap = overlaps(own)
            answered = [*answered[-7:], (x, overlap)]
        for y in found[overlap[found] * q >= p * (n + sizes[found])]:
            if root[y] != root[x]:
                forest.append((int(ids[x]), int(ids[y])))
                root[root == root[y]] = root[x]
    return forest


def _packed(keys: np.ndarray, ids: np.ndarray) -> bytes:
    """Keys, of which six bytes are kept, and ids; ids take four bytes where they lie close enough. Keys that are cut to one only make more candidates."""
    low = int(ids.min())
    near = int(ids.max()) - low < 1 << 32
    return low.to_bytes(8, "little", signed=True) + bytes([near]) + np.ascontiguousarray(keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]).tobytes() + (ids - low).astype("<u4" if near else "<i8").tobytes()


def _unpacked(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    low, near = int.from_bytes(blob[:8], "little", signed=True), blob[8]
    n = (len(blob) - 9) // (10 if near else 14)
    keys = np.zeros((n, 8), np.uint8)
    keys[:, :6] = np.frombuffer(blob, np.uint8, 6 * n, 9).reshape(n, 6)
    return keys.view("<u8").ravel(), low + np.frombuffer(blob, "<u4" if near else "<i8", n, 9 + 6 * n).astype(np.int64)


def _stars(keys: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Of each distinct key, pairs of its least id and every other one; each pair once."""
    order = np.lexsort((ids, keys))
    keys, ids = keys[order], ids[order]
    begins = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    first = np.repeat(ids[begins], np.diff(np.append(begins, len(keys))))
    return np.unique(np.stack([first, ids], axis=1)[first != ids], axis=0)


def _spread(pairs: np.ndarray, n: int) -> list[tuple[int, bytes]]:
    """Pairs packed into up to n parts by a hash of their first column, with the part's number."""
    part = (mix(pairs[:, 0].astype(U)) % U(n)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    cuts = np.searchsorted(part[order], np.arange(n + 1)).tolist()
    return [(k, pairs[order[x:y]].tobytes()) for k, (x, y) in enumerate(zip(cuts, cuts[1:], strict=False)) if x < y]


def _candidates(docs: DataFrame, total: int, words: int, percent: int, common: tuple[np.ndarray, np.ndarray] | None = None) -> DataFrame:
    """Distinct pairs (a, b) of each list's least document and its others. total: shingles of all documents.

    Of equal sets that a partition holds at once only the first sends its keys, so that a list of very many
    copies is no large group; the others are paired with it. Keys are packed by their ranges. Near copies meet in
    very many lists, so pairs leave a range packed by a hash of their first document, and become rows only where each is left once.
    """
    buckets = 1 << max(4, (total // LISTED).bit_length())
    shift = U(48 - buckets.bit_length() + 1)
    shared = docs.sparkSession.sparkContext.broadcast(common)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least, held, waiting = bands(percent), [], 0
        first: dict[bytes, int] = {}
        copies: list[tuple[int, int]] = []

        def out() -> pa.RecordBatch:
            keys, ids = (np.concatenate(x) for x in zip(*held, strict=True))
            pairs = np.array(copies, np.int64).reshape(-1, 2)
            for x in (held, first, copies):
                x.clear()
            # The upper six bytes of a key; its range comes first in their order.
            order = np.argsort(keys, kind="stable")
            keys, ids = keys[order] >> U(16), ids[order]
            cuts = np.searchsorted(keys, np.arange(buckets + 1).astype(U) << shift)
            spans = [(k, x, y) for k, (x, y) in enumerate(zip(cuts.tolist(), cuts[1:].tolist(), strict=False)) if x < y]
            rows = [(k, _packed(keys[x:y], ids[x:y])) for k, x, y in spans]
            # Copies found here go to groups below zero, by a hash of their first document.
            rows += [(-1 - k, x) for k, x in _spread(pairs, buckets)]
            return pa.RecordBatch.from_arrays([pa.array([k for k, _ in rows], pa.int32()), pa.array([x for _, x in rows], pa.binary())], names=["bucket", "blob"])

        for batch in batches:
            for begin, texts in chunks(batch.column("text").to_pylist()):
                for i, s in zip(batch.column("doc_id").slice(begin, len(texts)).to_pylist(), shingle_sets(texts, words), strict=True):
                    if i is None or not len(s):
                        continue
                    known = first.setdefault(hashlib.blake2b(s.tobytes(), digest_size=16).digest(), i)
                    if known != i:
                        copies.append((known, i))
                        waiting += 1
                        continue
                    keys = signatures(s, percent, least) if shared.value is None else rare_signatures(s, percent, least, shared.value)
                    held.append((keys, np.full(len(keys), i, np.int64)))
                    waiting += len(keys)
                if waiting > LISTED:
                    yield out()
                    waiting = 0
        if held:
            yield out()

    def link(group: pa.Table) -> pa.Table:
        blobs = group.column("blob").to_pylist()
        if group.column("bucket")[0].as_py() < 0:
            pairs = np.concatenate([np.frombuffer(x, np.int64).reshape(-1, 2) for x in blobs])
        else:
            pairs = _stars(*(np.concatenate(x) for x in zip(*map(_unpacked, blobs), strict=True)))
        rows = _spread(pairs, DEALT)
        return pa.table({"dealt": pa.array([k for k, _ in rows], pa.int32()), "pairs": pa.array([x for _, x in rows], pa.binary())})

    def each(group: pa.Table) -> pa.Table:
        pairs = np.unique(np.concatenate([np.frombuffer(x, np.int64).reshape(-1, 2) for x in group.column("pairs").to_pylist()]), axis=0)
        return pa.table({"a": pa.array(pairs[:, 0], pa.int64()), "b": pa.array(pairs[:, 1], pa.int64())})

    sent = docs.mapInArrow(send, "bucket int, blob binary")
    return sent.groupBy("bucket").applyInArrow(link, "dealt int, pairs binary").groupBy("dealt").applyInArrow(each, "a long, b long")


def _zipped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        bodies = [zlib.compress((t or "").encode("utf-8", "surrogatepass"), 1) for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(bodies, pa.binary())], names=["doc_id", "body"])


def _links(docs: DataFrame, stars: DataFrame, clusters: DataFrame, sizes: DataFrame, words: int, percent: int) -> DataFrame:
    """Links (a, b) between classes of a cluster: spanning forests of its units. stars: the pairs (a, b) of a list's least class and its others.

    Linked classes lie in one star, a class with all that it is the least of. A cluster of up to UNIT shingles is
    a unit. Of larger ones, light stars are dealt to units by a hash, so a text is sent once a star at most.
    A heavy star is first compared within parts, dealt twice in different ways, which connects what are near
    copies of each other; then only pairs are left that don't both lie in its largest component.
    """
    least = F.array(*(F.lit(x).cast("long") for x in bands(percent, 1 << 31)))
    placed = materialize(clusters.join(sizes, clusters["node"] == sizes["doc_id"]).select("node", F.col("component").alias("cluster"), "n"), "clusters")
    large = materialize(placed.groupBy("cluster").agg(F.sum("n").alias("weight")).filter(F.col("weight") > UNIT).select("cluster"), "large-clusters")
    zero = F.lit(0).cast("long")
    units = placed.join(large, "cluster", "left_anti").select("node", F.col("cluster").alias("center"), F.lit("cluster").alias("kind"), zero.alias("i"), zero.alias("j"))
    if large.isEmpty():
        return _compared(docs, materialize(units, "units"), words, percent)
    inside = placed.join(large, "cluster").select("node", "n")
    both = stars.join(inside.select(F.col("node").alias("a")), "a", "left_semi")
    members = both.select(F.col("a").alias("center"), F.explode(F.array("a", "b")).alias("node")).distinct()
    members = materialize(members.join(inside, "node"), "members")
    weights = materialize(members.groupBy("center").agg(F.sum("n").alias("weight")), "star-weights")
    light = weights.filter(F.col("weight") <= UNIT)
    dealt = max(1, -(-2 * (light.agg(F.sum("weight")).first()[0] or 0) // UNIT))
    few = members.join(light.select("center"), "center", "left_semi").select("node", F.pmod(F.xxhash64("center"), F.lit(dealt)).alias("center"), F.lit("light").alias("kind"), zero.alias("i"), zero.alias("j")).distinct()
    heavy = materialize(members.join(weights.filter(F.col("weight") > UNIT), "center"), "heavy")
    ways = [heavy.select("node", "center", F.lit("heavy").alias("kind"), F.lit(w).cast("long").alias("i"), F.pmod(F.xxhash64("node", F.lit(w)), F.ceil(F.col("weight") / UNIT)).alias("j")) for w in (1, 2)]
    found = materialize(_compared(docs, materialize(units.unionByName(few).unionByName(ways[0]).unionByName(ways[1]), "units"), words, percent), "unit-links")
    if heavy.isEmpty():
        return found
    known = connected_components(found)
    heavy = heavy.join(known, "node", "left").select("node", "center", "n", F.coalesce("component", "node").alias("component"))
    heavy = materialize(heavy.withColumn("band", F.size(F.filter(least, lambda e: e <= F.col("n")))), "heavy-components")
    most = heavy.groupBy("center", "component").agg(F.sum("n").alias("weight")).groupBy("center").agg(F.max_by("component", F.struct("weight", "component")).alias("most"))
    # A unit is a band with the next one, in pairs of parts: those of the largest component come first, and only meet others.
    twice = heavy.join(most, "center").withColumn("most", F.col("component") == F.col("most")).withColumn("unit", F.explode(F.array(F.col("band"), F.col("band") - 1)))
    weight = lambda c: F.ceil(F.coalesce(F.sum(F.when(c, F.col("n"))), zero) / UNIT)
    parts = twice.groupBy("center", "unit").agg(weight(F.col("most")).alias("firsts"), weight(~F.col("most")).alias("rest")).filter("rest > 0")
    twice = twice.join(parts, ["center", "unit"])
    part = F.when(F.col("most"), F.pmod(F.xxhash64("node"), F.col("firsts"))).otherwise(F.col("firsts") + F.pmod(F.xxhash64("node"), F.col("rest")))
    others = F.sequence(F.when(F.col("most"), F.col("firsts")).otherwise(zero), F.col("firsts") + F.col("rest") - 1)
    twice = twice.withColumn("part", part).withColumn("other", F.explode(others))
    split = twice.select("node", "center", F.col("unit").cast("string").alias("kind"), F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"))
    return found.unionByName(_compared(docs, materialize(split, "units"), words, percent))


def _compared(docs: DataFrame, units: DataFrame, words: int, percent: int) -> DataFrame:
    """Spanning forests (a, b) of the links in each unit; units: materialized rows (node, center, kind, i, j), of which the last four name the unit."""
    # Packed texts travel, as they take less room than sets of hashes.
    rows = join_small(docs.select("doc_id", "text").mapInArrow(_zipped, "doc_id long, body binary"), units.withColumnRenamed("node", "doc_id"), "doc_id", "inner")

    def join(group: pa.Table) -> pa.Table:
        ids, sets = group.column("doc_id").to_numpy(), []
        for _, texts in chunks([zlib.decompress(x).decode("utf-8", "surrogatepass") for x in group.column("body").to_pylist()]):
            sets += shingle_sets(texts, words)
        filled = [k for k, s in enumerate(sets) if len(s)]
        forest = skip_join(ids[filled], [sets[k] for k in filled], percent) if filled else []
        return pa.table({"a": pa.array([a for a, _ in forest], pa.int64()), "b": pa.array([b for _, b in forest], pa.int64())})

    return rows.select("center", "kind", "i", "j", "doc_id", "body").groupBy("center", "kind", "i", "j").applyInArrow(join, "a long, b long")


def components(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, rare: bool = False) -> DataFrame:
    """doc_id, n_shingles, component_id of every row of docs (doc_id, text). rare: route by rare prefixes in place of position blocks."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    slim = materialize(_described(docs, words), "shingle-sets")
    # Classes of one row need no class: they are the row's own.
    classes = materialize(slim.filter("n > 0").groupBy("d1", "d2").agg(F.min("doc_id").alias("class"), F.count("*").alias("rows")).filter("rows > 1 or class is null").drop("rows"), "classes")
    # Documents all of whose texts are one class's stand for it.
    stands = join_hot(slim.filter("n > 0 and doc_id is not null"), classes, ["d1", "d2"]).withColumn("class", F.coalesce("class", "doc_id")).groupBy("doc_id").agg(F.min("class").alias("class"), F.max("class").alias("most"))
    copies = materialize(stands.filter("class = most and doc_id <> class").drop("most"), "copies")
    total = slim.agg(F.sum("n")).first()[0] or 0
    met = _candidates(docs, total, words, percent, common_items(docs, words, percent, total) if rare else None)
    # A list's documents stand for their classes; those with several texts for themselves.
    for end in ("a", "b"):
        met = join_small(met, copies.withColumnsRenamed({"doc_id": end, "class": f"of_{end}"}), end)
    stars = materialize(met.select(F.coalesce("of_a", "a").alias("a"), F.coalesce("of_b", "b").alias("b")).filter("a <> b").distinct(), "candidates")
    clusters = connected_components(stars)
    sizes = slim.filter("n > 0").groupBy("doc_id").agg(F.max("n").alias("n"))
    links = materialize(_links(docs, stars, clusters, sizes, words, percent), "links")
    reached = materialize(connected_components(links).withColumnRenamed("node", "class"), "reached")
    # Rows of several-row classes get their class's component, others their own.
    named = join_hot(slim, classes, ["d1", "d2"]).withColumn("class", F.when(F.col("n") > 0, F.coalesce("class", "doc_id")).otherwise(F.col("doc_id")))
    found = join_hot(named, reached, ["class"])
    return found.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "class").alias("component_id"))


def one_of_each(docs: DataFrame, words: int = NEAR_WORDS, percent: int = NEAR_PERCENT) -> DataFrame:
    """The documents that stay when near copies go: of each component the one with the least id, once if its row repeats; and rows without an id."""
    found = components(docs, words, percent, rare=True).select(F.col("doc_id").alias("_id"), "component_id").filter("_id = component_id").select("_id").distinct()
    kept = docs.join(found, docs["doc_id"] == found["_id"], "left_semi").dropDuplicates(["doc_id", "text"])
    return kept.unionByName(docs.filter("doc_id is null"))


#: DuckDB SQL for op1, over the same rows.
SQL = r"""
WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 3 THEN list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i+2], ' '))
                                      WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s
  FROM worded
), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS o FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * o >= 90 * (x.n + y.n - o)
), reach AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, least(d.doc_id, coalesce(m, d.doc_id)) AS component_id
FROM documents d LEFT JOIN sizes USING (doc_id) LEFT JOIN (SELECT a AS doc_id, min(b) AS m FROM reach GROUP BY a) USING (doc_id)
"""
