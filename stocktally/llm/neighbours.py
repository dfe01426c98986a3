"""Approximate nearest neighbours: multiprobe p-stable hashing with exact reranking."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from stocktally.llm.common import Shared, collected, mix64
from stocktally.session import cut_lineage


@dataclass(frozen=True)
class Hashing:
    """tables x keys projections on Gaussian (2-stable) directions, cut into slots of `width`."""

    directions: np.ndarray  # dims x (tables * keys)
    shifts: np.ndarray
    width: float
    tables: int
    keys: int
    probes: int

    def places(self, unit: np.ndarray) -> np.ndarray:
        return (unit @ self.directions + self.shifts) / self.width

    def buckets(self, slots: np.ndarray) -> np.ndarray:
        """One 64-bit id of each (row, table) from integer slots (rows x tables x keys)."""
        out = np.broadcast_to(mix64(np.arange(self.tables, dtype=np.uint64) + np.uint64(1)), slots.shape[:2]).copy()
        for k in range(self.keys):
            out = mix64(out ^ mix64(slots[:, :, k].astype(np.int64).view(np.uint64) + np.uint64(k << 56)))
        return out.view(np.int64)

    def probed(self, unit: np.ndarray) -> np.ndarray:
        """rows x (tables * probes) buckets: per table the own bucket and the perturbed ones in estimated success order.

        A perturbation moves some keys by one slot up or down. Its score is the sum of squared distances to the
        borders crossed; a smaller sum is likelier to hold a neighbour. The sets are drawn by increasing score
        from the 2 x keys borders, sorted by distance, by shifting and expanding (each key moved at most once).
        """
        places = self.places(unit).reshape(len(unit), self.tables, self.keys)
        slots = np.floor(places).astype(np.int64)
        inside = places - slots
        borders = np.concatenate([inside, 1 - inside], axis=2) ** 2  # down, up
        order = np.argsort(borders, axis=2, kind="stable")
        cost = np.take_along_axis(borders, order, 2)
        sets = self._templates()
        # Scores of all templates for all rows; the best `probes - 1` of them.
        member = np.zeros((len(sets), 2 * self.keys))
        for i, s in enumerate(sets):
            member[i, list(s)] = 1
        score = cost @ member.T
        key = order % self.keys
        for i, s in enumerate(sets):
            if len(s) > 1:
                picked = np.sort(key[:, :, list(s)], axis=2)
                score[:, :, i][(picked[:, :, 1:] == picked[:, :, :-1]).any(axis=2)] = np.inf
        best = np.argsort(score, axis=2, kind="stable")[:, :, : self.probes - 1]
        found = [self.buckets(slots)]
        rows, tables = np.indices(slots.shape[:2])
        for p in range(best.shape[2]):
            moved = slots.copy()
            for i, s in enumerate(sets):
                hit = best[:, :, p] == i
                if hit.any():
                    r, t = rows[hit], tables[hit]
                    for j in s:
                        b = order[r, t, j]
                        np.add.at(moved, (r, t, b % self.keys), np.where(b < self.keys, -1, 1))
            found.append(self.buckets(moved))
        return np.stack(found, axis=2).reshape(len(unit), -1)

    def _templates(self) -> list[tuple[int, ...]]:
        """Sets of ranks of borders whose expected score is among the smallest, by shift and expand from {0}."""
        import heapq

        m, n = self.keys, 2 * self.keys
        # Expected squared distance of the j-th nearest of 2m borders.
        expected = [(j + 1) * (j + 2) / (4 * (m + 1) * (m + 2)) if j < m else 1 - (n - j) / (m + 1) + (n - j) * (n - j + 1) / (4 * (m + 1) * (m + 2)) for j in range(n)]
        heap, out = [(expected[0], (0,))], []
        while heap and len(out) < 4 * self.probes:
            score, s = heapq.heappop(heap)
            if not any(n - 1 - j in s for j in s):
                out.append(s)
            last = s[-1]
            if last + 1 < n:
                heapq.heappush(heap, (score - expected[last] + expected[last + 1], (*s[:-1], last + 1)))
                heapq.heappush(heap, (score + expected[last + 1], (*s, last + 1)))
        return out


def hashing(dims: int, tables: int, keys: int, width: float, probes: int, seed: int = 0) -> Hashing:
    rng = np.random.default_rng(seed)
    return Hashing(rng.normal(size=(dims, tables * keys)), rng.uniform(0, width, tables * keys), width, tables, keys, probes)


def valid(column: str):
    """Neither null nor zero, and without null or non-finite parts."""
    v = F.col(column)
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return v.isNotNull() & (F.size(v) > 0) & ~bad & F.exists(v, lambda x: x != 0)


def matrix(column: pa.Array, dims: int) -> np.ndarray:
    """Rows of list cells as doubles."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), dims)


def _exact_top(queries: np.ndarray, query_ids: np.ndarray, rows: np.ndarray, row_ids: np.ndarray, k: int):
    """(query_id, vec_id, score) of the k best rows of each query, ties to smaller ids, from one block.

    A matrix product finds who can be among the best; their cosines are then computed pair by pair, so that equal
    vectors get equal scores wherever they stand in a block.
    """
    length = lambda x: np.sqrt((x * x).sum(axis=1))
    q_len, r_len = length(queries), length(rows)
    near = (queries / q_len[:, None]) @ (rows / r_len[:, None]).T
    near[query_ids[:, None] == row_ids[None, :]] = -np.inf
    m = min(k, near.shape[1])
    floor = np.partition(near, near.shape[1] - m, axis=1)[:, near.shape[1] - m] - 1e-9
    q, r = np.nonzero((near >= floor[:, None]) & np.isfinite(near))
    score = (queries[q] * rows[r]).sum(axis=1) / (q_len[q] * r_len[r])
    order = np.lexsort((row_ids[r], -score, q))
    q, r, score = q[order], r[order], score[order]
    first = np.searchsorted(q, q, side="left")
    best = np.arange(len(q)) - first < k
    return query_ids[q[best]], row_ids[r[best]], score[best]


def _placed(vectors: DataFrame, shared: Shared | None, query: bool, dims: int) -> DataFrame:
    """(__bucket, __id, __vector) with a row for each table, or for each probe of a query."""

    def run(batches):
        for batch in batches:
            for a in range(0, batch.num_rows, 1024):
                part = batch.slice(a, 1024)
                x = matrix(part.column(1), dims)
                ids = part.column(0).to_numpy(zero_copy_only=False)
                if shared is None:
                    buckets = np.zeros((len(x), 1), np.int64)
                else:
                    # A common factor first: squares of very large or small parts would leave the range of doubles.
                    unit = x / np.abs(x).max(axis=1, keepdims=True)
                    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
                    h = shared.value
                    buckets = h.probed(unit) if query else h.buckets(np.floor(h.places(unit)).astype(np.int64).reshape(len(x), h.tables, h.keys))
                n = buckets.shape[1]
                cells = [row.tobytes() for row in x]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(buckets.reshape(-1)), pa.array(np.repeat(ids, n)), pa.array([c for c in cells for _ in range(n)], pa.binary())],
                    ["__bucket", "__id", "__vector"],
                )

    return vectors.select("__id", "__vector").mapInArrow(run, "__bucket long, __id long, __vector binary")


def _searched(queries: DataFrame, rows: DataFrame, shared: Shared | None, k: int, block: int, asked_block: int, dims: int) -> DataFrame:
    """(query_id, vec_id, score): the best of each block of each bucket that a query probes.

    The queries of a bucket are cut into turns of about `asked_block`, each with its own copy of the bucket's blocks, so
    that a task holds a bounded number of rows and of queries.
    """
    placed = _placed(rows, shared, False, dims)
    sizes = cut_lineage(placed.groupBy("__bucket").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("__parts")), "buckets")
    if shared is None or sizes.count() <= 100_000:
        sizes = F.broadcast(sizes)
    # A bucket is cut into blocks; a query visits each block of its buckets.
    index = placed.join(sizes, "__bucket").withColumn("__part", F.pmod(F.xxhash64(F.lit(5), "__id"), F.col("__parts")).cast("int"))
    asked = _placed(queries, shared, True, dims).join(sizes, "__bucket").withColumn("__part", F.explode(F.sequence(F.lit(0), F.col("__parts") - 1)))
    turns = _placed(queries, shared, True, dims).groupBy("__bucket").agg(F.ceil(F.count(F.lit(1)) / asked_block).cast("int").alias("__turns"))
    turns = cut_lineage(turns.filter(F.col("__turns") > 1), "turns")
    if shared is None or turns.count() <= 100_000:
        turns = F.broadcast(turns)
    several = F.coalesce("__turns", F.lit(1))
    index = index.join(turns, "__bucket", "left").withColumn("__turn", F.explode(F.sequence(F.lit(0), several - 1)))
    asked = asked.join(turns, "__bucket", "left").withColumn("__turn", F.pmod(F.xxhash64(F.lit(6), "__id"), several).cast("int"))
    columns = ["__bucket", "__part", "__turn", "__id", "__vector"]
    both = index.select(*columns, F.lit(False).alias("__asked")).unionByName(asked.select(*columns, F.lit(True).alias("__asked")))

    def best(group: pa.Table) -> pa.Table:
        asked = group.column("__asked").to_numpy()
        ids = group.column("__id").to_numpy()
        x = np.frombuffer(b"".join(group.column("__vector").to_pylist()), np.float64).reshape(len(ids), dims)
        found = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
        if asked.any() and not asked.all():
            q, q_ids = x[asked], ids[asked]
            parts = [_exact_top(q[a : a + 512], q_ids[a : a + 512], x[~asked], ids[~asked], k) for a in range(0, len(q), 512)]
            found = [np.concatenate(c) for c in zip(*parts, strict=True)]
        return pa.table({"query_id": found[0], "vec_id": found[1], "score": found[2]})

    return both.groupBy("__bucket", "__part", "__turn").applyInArrow(best, "query_id long, vec_id long, score double")


def nearest(
    vectors: DataFrame, is_query, *, vector: str = "embedding", key: str = "vec_id", k: int = 5, tables: int = 6, keys: int = 3,
    width: float = 1.0, probes: int = 16, block: int = 1024, asked_block: int = 8192, seed: int = 0,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k rows with the largest cosine that multiprobe hashing finds.

    Vectors are scaled to length 1 and hashed on Gaussian projections into `tables` tables; a query visits `probes`
    buckets of each, its own and those behind the borders it is closest to, in estimated success order. Every row
    met is compared exactly, on the original vectors in double precision. Buckets of any size are searched whole, in
    blocks of about `block` rows, for `asked_block` queries at a time. A query that has met fewer than k rows is compared with all rows.

    Rows without an id and vectors that are null, empty, zero, of another length than most, or that hold null or non-finite parts take no
    part. Of several rows with one id the best counts; a query's own id is never its neighbour. Ties go to smaller
    ids. An empty table gives an empty result. Other columns are ignored.
    """
    good = vectors.filter(valid(vector) & F.col(key).isNotNull()).withColumn("__asks", is_query)
    lengths = good.groupBy(F.size(vector).alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    dims = lengths[0]["n"] if lengths else 1
    good = good.filter(F.size(vector) == dims).select(
        F.col(key).cast("long").alias("__id"), F.col(vector).cast("array<double>").alias("__vector"), "__asks"
    )
    queries = good.filter("__asks")
    shared = Shared(vectors.sparkSession, hashing(dims, tables, keys, width, probes, seed))

    def ranked(found: DataFrame) -> DataFrame:
        once = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
        rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
        return once.withColumn("rank", rank).filter(F.col("rank") <= k)

    result = cut_lineage(ranked(_searched(queries, good, shared, k, block, asked_block, dims)), "nearest")
    full = result.groupBy("query_id").agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") >= k)
    short = queries.join(full, F.col("__id") == F.col("query_id"), "left_anti").select("__id", "__vector")
    if short.isEmpty():
        return result.select("query_id", "rank", "vec_id", "score")
    rest = ranked(_searched(short, good, None, k, block, asked_block, dims))
    return result.join(full.select("query_id"), "query_id", "left_semi").unionByName(rest).select("query_id", "rank", "vec_id", "score")
