"""Approximate nearest neighbours by cosine: a navigable small-world graph per shard.

Equal vectors are one point that keeps its K + 1 smallest ids, enough for any answer. Points are dealt
to shards of about SHARD by a hash. Each shard builds a hierarchical navigable small-world graph,
stored as flat arrays of neighbours, one a level; walks of many queries go on together in array
operations. Every query is searched in every shard; a shard's EF best points are ranked again in
double precision, and shard results, which carry a query's number only, are merged by a window a
query. Queries and graphs meet by a shuffle, in blocks, so no task or driver holds all of them.

Cases: vectors that are null, zero or hold a null or non-finite component take no part, nor do rows
with a null id; vectors of another length than a query's aren't its candidates; a query's own id is no
candidate, even if it repeats; a query with fewer candidates gets all of them;
finite components of any size are scaled before they are squared; an empty table gives
no rows; extra columns are ignored.
"""

from __future__ import annotations

import heapq
import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

#: Neighbours returned; points in a shard and queries in a block on average.
K, SHARD, BLOCK = 5, 25_000, 20_000
#: Tasks a group, so that few of them get two, and tasks at most.
TASKS, MOST_TASKS = 6, 4_000
#: Links of a point above the ground level (twice as many there), and points kept while building and searching.
M, EF_BUILD, EF = 16, 64, 280
#: Points put in and queries walked at once, points that a walk leaves at once, and numbers in a table of likeness.
STEP, WALKS, LEAVES, TABLE = 512, 128, 16, 2_000_000


class Graph:
    """A hierarchical navigable small-world graph over rows of unit vectors.

    Points are put in by steps no larger than the graph so far; those of a step may link to each other.
    """

    def __init__(self, unit: np.ndarray, seed: int = 3):
        self.unit = unit
        n = len(unit)
        draws = np.random.default_rng(seed).random(n)
        self.level = np.minimum(12, (-np.log(np.maximum(draws, 1e-12)) / np.log(M)).astype(np.int64))
        self.level[:1] = self.level.max(initial=0)
        #: Where a point's neighbours lie at each level, and the flat arrays, -1 where there are none.
        self.slot = [np.cumsum(self.level >= h) - 1 for h in range(int(self.level.max(initial=0)) + 1)]
        self.links = [np.full((int((self.level >= h).sum()), 2 * M if h == 0 else M), -1, np.int32) for h in range(len(self.slot))]
        at = 1
        while at < n:
            upto = min(n, at + min(at, STEP))
            self._insert(np.arange(at, upto))
            at = upto

    def _layer(self, q: np.ndarray, start: np.ndarray, ef: int, h: int) -> tuple[np.ndarray, np.ndarray]:
        """The ef points of level h most like each row of q that greedy walks find, most like first, and their likeness; -1 beyond them."""
        found, unit, links, slot, n = [], self.unit, self.links[h], self.slot[h], len(self.unit)
        for low in range(0, len(q), WALKS):
            part = q[low : low + WALKS]
            ids, sims = np.full((len(part), ef), -1, np.int64), np.full((len(part), ef), -np.inf, np.float32)
            ids[:, 0] = start[low : low + WALKS]
            sims[:, 0] = np.einsum("ij,ij->i", unit[ids[:, 0]], part)
            left = sims == -np.inf
            mark = np.zeros(len(part) * n, np.int32)
            mark[np.arange(len(part)) * n + ids[:, 0]] = 1
            stamp, wide = 1, min(ef, LEAVES)
            while True:
                waiting = np.where(left, -np.inf, sims)
                rows = np.flatnonzero(waiting.max(axis=1) > -np.inf)
                if not len(rows):
                    break
                pick = np.argpartition(waiting[rows], ef - wide, axis=1)[:, ef - wide :]
                real = ~left[rows[:, None], pick]
                left[rows[:, None], pick] = True
                near = links[slot[ids[rows[:, None], pick]]]
                at = np.nonzero((near >= 0) & real[:, :, None])
                row, x = rows[at[0]], near[at].astype(np.int64)
                # Each point once a row: the last that marks it is the one.
                code = row * n + x
                fresh = mark[code] == 0
                row, x, code = row[fresh], x[fresh], code[fresh]
                turn = np.arange(stamp + 1, stamp + 1 + len(x), dtype=np.int32)
                mark[code] = turn
                stamp += len(x)
                once = mark[code] == turn
                row, x = row[once], x[once]
                s = np.einsum("ij,ij->i", unit[x], part[row])
                better = s > sims.min(axis=1)[row]
                row, x, s = row[better], x[better], s[better]
                if not len(row):
                    continue
                rows, first, count = np.unique(row, return_index=True, return_counts=True)
                place = np.repeat(np.arange(len(rows)), count), ef + np.arange(len(row)) - np.repeat(first, count)
                width = ef + int(count.max())
                both = [np.full((len(rows), width), fill, kind) for fill, kind in ((-1, np.int64), (-np.inf, np.float32), (True, bool))]
                for table, old, more in zip(both, (ids, sims, left), (x, s, False), strict=True):
                    table[:, :ef] = old[rows]
                    table[place] = more
                keep = np.argpartition(both[1], width - ef, axis=1)[:, width - ef :]
                ids[rows], sims[rows], left[rows] = (np.take_along_axis(table, keep, axis=1) for table in both)
            order = np.argsort(-sims, axis=1, kind="stable")
            found.append((np.take_along_axis(ids, order, axis=1), np.take_along_axis(sims, order, axis=1)))
        return np.concatenate([i for i, _ in found]), np.concatenate([s for _, s in found])

    def _choose(self, points: np.ndarray, sims: np.ndarray, most: int) -> np.ndarray:
        """For each row neighbours in different directions: each nearer to the point than to those chosen before; then the nearest others; -1 beyond them."""
        many = points.shape[1]
        out = np.full((len(points), most), -1, np.int64)
        step = max(1, TABLE // (many * many))
        for low in range(0, len(points), step):
            order = np.argsort(-sims[low : low + step], axis=1, kind="stable")
            some, like = np.take_along_axis(points[low : low + step], order, axis=1), np.take_along_axis(sims[low : low + step], order, axis=1)
            vectors = self.unit[some]
            between = vectors @ vectors.transpose(0, 2, 1)
            chosen, closest = np.zeros(some.shape, bool), np.full(some.shape, -2.0, np.float32)
            count = np.zeros(len(some), np.int64)
            for i in range(many):
                new = (some[:, i] >= 0) & (closest[:, i] < like[:, i]) & (count < most)
                chosen[:, i] = new
                count += new
                closest[new] = np.maximum(closest[new], between[new, i])
            best = np.argsort(np.where(chosen, 0, np.where(some >= 0, 1, 2)), axis=1, kind="stable")[:, :most]
            out[low : low + step, : best.shape[1]] = np.take_along_axis(some, best, axis=1)
        return out

    def _insert(self, new: np.ndarray) -> None:
        q, start = self.unit[new], np.zeros(len(new), np.int64)
        for h in range(len(self.links) - 1, -1, -1):
            into = self.level[new] >= h
            if not into.all():
                start[~into] = self._layer(q[~into], start[~into], 1, h)[0][:, 0]
            if not into.any():
                continue
            points, sims = self._layer(q[into], start[into], EF_BUILD, h)
            start[into] = points[:, 0]
            own = new[into]
            among = q[into] @ q[into].T
            np.fill_diagonal(among, -np.inf)
            few = np.argsort(-among, axis=1, kind="stable")[:, : min(2 * M, len(own) - 1)]
            chosen = self._choose(np.concatenate([points, own[few]], axis=1), np.concatenate([sims, np.take_along_axis(among, few, axis=1)], axis=1), M)
            self.links[h][self.slot[h][own], :M] = chosen
            self._link_back(np.repeat(own, M), chosen.ravel(), h)

    def _link_back(self, new: np.ndarray, points: np.ndarray, h: int) -> None:
        """Gives points the new ones as neighbours; of more than there is room for, those that _choose takes stay."""
        links, slot = self.links[h], self.slot[h]
        new, points = new[points >= 0], points[points >= 0]
        missing = ~(links[slot[points]] == new[:, None]).any(axis=1)
        order = np.argsort(points[missing], kind="stable")
        new, points = new[missing][order], points[missing][order]
        targets, first, count = np.unique(points, return_index=True, return_counts=True)
        # Targets with equally many new neighbours are widened alike.
        size = np.ceil(np.log2(count)).astype(np.int64)
        room = links.shape[1]
        for k in np.unique(size).tolist():
            some = np.flatnonzero(size == k)
            more = np.full((len(some), 1 << k), -1, np.int64)
            for j in range(1 << k):
                has = count[some] > j
                more[has, j] = new[first[some[has]] + j]
            wide = np.concatenate([links[slot[targets[some]]], more], axis=1)
            full = (wide >= 0).sum(axis=1) > room
            packed = np.take_along_axis(wide[~full], np.argsort(wide[~full] < 0, axis=1, kind="stable"), axis=1)
            links[slot[targets[some[~full]]]] = packed[:, :room]
            at, rest = targets[some[full]], wide[full]
            for low in range(0, len(at), STEP):
                points_, own = rest[low : low + STEP], self.unit[at[low : low + STEP]]
                sims = np.where(points_ >= 0, (self.unit[points_] @ own[:, :, None])[:, :, 0], -np.inf)
                links[slot[at[low : low + STEP]]] = self._choose(points_, sims, room)

    def search(self, q: np.ndarray, ef: int) -> np.ndarray:
        """The points that walks for each row of q find, most like first; -1 beyond them."""
        start = np.zeros(len(q), np.int64)
        for h in range(len(self.links) - 1, 0, -1):
            start = self._layer(q, start, 1, h)[0][:, 0]
        return self._layer(q, start, min(ef, len(self.unit)), 0)[0]


def _saved(graph: Graph, **more: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.savez(out, level=graph.level, **{f"links{h}": x for h, x in enumerate(graph.links)}, **more)
    return out.getvalue()


def _loaded(blob: bytes) -> tuple[Graph, dict[str, np.ndarray]]:
    data = dict(np.load(io.BytesIO(blob)))
    graph = Graph.__new__(Graph)
    vectors = data["vectors"] = data["vectors"].astype(np.float64)
    graph.unit = _unit(vectors)
    graph.level = data["level"]
    graph.links = [data[f"links{h}"] for h in range(int(graph.level.max()) + 1)]
    graph.slot = [np.cumsum(graph.level >= h) - 1 for h in range(len(graph.links))]
    return graph, data


def _scaled(vectors: np.ndarray) -> np.ndarray:
    """Each vector times the power of two that brings its largest component near one: exact, and no sum of squares overflows or vanishes."""
    return np.ldexp(vectors, -np.frexp(np.abs(vectors).max(axis=-1, keepdims=True))[1])


def _unit(scaled: np.ndarray) -> np.ndarray:
    return (scaled / np.linalg.norm(scaled, axis=-1, keepdims=True)).astype(np.float32)


def _narrow(scaled: np.ndarray) -> np.ndarray:
    """The same numbers in half the bytes, where nothing is lost."""
    half = scaled.astype(np.float32)
    return half if (half == scaled).all() else scaled


def points(vectors: DataFrame, k: int) -> DataFrame:
    """(embedding, ids): each distinct vector that takes part, with its k + 1 smallest ids."""
    wide = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")).filter("vec_id is not null and embedding is not null and size(embedding) > 0")
    fine = wide.filter(F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("embedding", lambda x: x != 0))

    def least(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held: dict[bytes, list[int]] = {}
            for vec_id, vector in zip(batch.column("vec_id").to_pylist(), batch.column("embedding"), strict=True):
                # Adding zero makes minus zero plus zero.
                held.setdefault((vector.values.to_numpy(zero_copy_only=False) + 0.0).tobytes(), []).append(vec_id)
            yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.binary()), pa.array([heapq.nsmallest(k + 1, set(x)) for x in held.values()], pa.list_(pa.int64()))], names=["vector", "ids"])

    some = fine.mapInArrow(least, "vector binary, ids array<long>")
    return some.groupBy("vector").agg(F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list("ids")))), 1, k + 1).alias("ids"))


def nearest(vectors: DataFrame, queries: str = "vec_id % 50 = 0", k: int = K) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of every row of vectors that the condition chooses."""
    known = materialize(points(vectors, k), "points")
    # Written, so that a query's number stays; results carry it in place of the vector.
    asked = materialize(points(vectors.filter(queries).select("vec_id", "embedding"), 0).select("vector").distinct().withColumn("number", F.monotonically_increasing_id()), "queries")
    shards, blocks = max(1, -(-known.count() // SHARD)), max(1, -(-asked.count() // BLOCK))
    dealt = known.withColumn("size", F.length("vector")).withColumn("shard", F.pmod(F.xxhash64("vector"), F.lit(shards)))

    def build(group: pa.Table) -> pa.Table:
        vectors = _scaled(np.stack([np.frombuffer(x) for x in group.column("vector").to_pylist()]))
        ids = group.column("ids").combine_chunks()
        blob = _saved(Graph(_unit(vectors)), vectors=_narrow(vectors), ids=ids.flatten().to_numpy(), at=np.asarray(ids.offsets) - ids.offsets[0].as_py())
        return pa.table({"size": group.column("size")[:1], "shard": group.column("shard")[:1], "index": pa.array([blob], pa.binary())})

    def tasks(groups: int) -> int:
        """A group is long work over few bytes: a number by bytes would put many in one task."""
        return min(TASKS * groups, MOST_TASKS)

    indexes = materialize(dealt.repartition(tasks(shards), "size", "shard").groupBy("size", "shard").applyInArrow(build, "size int, shard long, index binary"), "graphs")

    def each(column: str, many: int) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(many - 1).cast("long"))).alias(column)

    keys = ["size", "shard", "block"]
    graphs = indexes.select("*", each("block", blocks)).repartition(tasks(shards * blocks), *keys)
    walks = asked.select(F.length("vector").alias("size"), F.pmod(F.xxhash64("vector", F.lit(1)), F.lit(blocks)).alias("block"), "number", "vector").select("*", each("shard", shards)).repartition(tasks(shards * blocks), *keys)

    def search(graphs: pa.Table, walks: pa.Table) -> pa.Table:
        out: list[list[np.ndarray]] = [[np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)]]
        if graphs.num_rows and walks.num_rows:
            graph, data = _loaded(graphs.column("index")[0].as_py())
            numbers = walks.column("number").to_numpy()
            vectors, ids, at = data["vectors"], data["ids"], data["at"]
            norms = np.linalg.norm(vectors, axis=1)
            for low in range(0, len(numbers), WALKS):
                scaled = _scaled(np.stack([np.frombuffer(x) for x in walks.column("vector").slice(low, WALKS).to_pylist()]))
                for number, q, found in zip(numbers[low : low + WALKS].tolist(), scaled, graph.search(_unit(scaled), EF), strict=True):
                    found = found[found >= 0]
                    score = np.clip((vectors[found] * q).sum(axis=1) / (norms[found] * np.linalg.norm(q)), -1, 1)
                    # Each point has an id, so no other can come before these.
                    near = score >= np.partition(score, max(0, len(score) - k - 1))[max(0, len(score) - k - 1)]
                    best = heapq.nsmallest(k + 1, ((-s, i) for s, f in zip(score[near].tolist(), found[near].tolist(), strict=True) for i in ids[at[f] : at[f + 1]].tolist()))
                    out[0].append(np.full(len(best), number))
                    out[1].append(np.array([i for _, i in best], np.int64))
                    out[2].append(np.array([-s for s, _ in best]))
        return pa.table({name: np.concatenate(x) for name, x in zip(("number", "vec_id", "score"), out, strict=True)})

    # Queries meet graphs by a shuffle alone: a join whose one side is taken for small would send a copy a shard through the driver.
    found = graphs.groupBy(*keys).cogroup(walks.groupBy(*keys)).applyInArrow(search, "number long, vec_id long, score double")
    order = Window.partitionBy("number").orderBy(F.col("score").desc(), "vec_id")
    best = found.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k + 1).drop("place")
    # Each query has its vector's answers but for itself; queries with equal vectors share one search.
    answers = materialize(best.groupBy("number").agg(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("order"), "vec_id", "score"))).alias("found")), "answers")
    rows = _asking(vectors.filter(queries)).join(asked, "vector").select("query_id", "number").join(answers, "number")
    others = F.slice(F.filter("found", lambda x: x["vec_id"] != F.col("query_id")), 1, k)
    return rows.select("query_id", F.posexplode(others).alias("place", "hit")).select("query_id", (F.col("place") + 1).cast("int").alias("rank"), "hit.vec_id", "hit.score")


def _asking(vectors: DataFrame) -> DataFrame:
    """(query_id, vector) of every row that takes part; vector as in points()."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, blobs = [], []
            for vec_id, vector in zip(batch.column("vec_id").to_pylist(), batch.column("embedding"), strict=True):
                values = None if not vector.is_valid or vector.values.null_count else vector.values.to_numpy(zero_copy_only=False) + 0.0
                if vec_id is not None and values is not None and len(values) and np.isfinite(values).all() and values.any():
                    ids.append(vec_id)
                    blobs.append(values.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(blobs, pa.binary())], names=["query_id", "vector"])

    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")).mapInArrow(run, "query_id long, vector binary").distinct()
