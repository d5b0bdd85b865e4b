"""Approximate nearest neighbours with an inverted multi-index."""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerloom.llm.columns import quoted

SAMPLE = 20_000
TRIAL_QUERIES = 256
RECALL = 0.97
BLOCK_ROWS = 4096
ROW = "block int, part int, kind int, id long, cell int, wanted binary, vector array<double>"


@dataclass(frozen=True)
class Index:
    """Centroids of both halves, rows per cell, and the share of rows that a search has to see."""

    first: np.ndarray
    second: np.ndarray
    rows: np.ndarray
    share: float

    def cell(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        half = self.first.shape[1]
        return nearest_centroid(vectors[:, :half], self.first), nearest_centroid(vectors[:, half:], self.second)

    def parts(self) -> np.ndarray:
        """Into how many parts the rows of each first-half centroid are split, so that a part stays small."""
        return np.maximum(1, -(-self.rows.sum(axis=1) // BLOCK_ROWS))

    def traverse(self, vector: np.ndarray) -> Iterator[tuple[int, int]]:
        """Cells in the order of the summed squared distances of their two centroids."""
        half = self.first.shape[1]
        one = ((self.first - vector[:half]) ** 2).sum(axis=1)
        two = ((self.second - vector[half:]) ** 2).sum(axis=1)
        order_one, order_two = np.argsort(one, kind="stable"), np.argsort(two, kind="stable")
        heap = [(one[order_one[0]] + two[order_two[0]], 0, 0)]
        while heap:
            _, i, j = heapq.heappop(heap)
            yield int(order_one[i]), int(order_two[j])
            if j + 1 < len(order_two):
                heapq.heappush(heap, (one[order_one[i]] + two[order_two[j + 1]], i, j + 1))
            if j == 0 and i + 1 < len(order_one):
                heapq.heappush(heap, (one[order_one[i + 1]] + two[order_two[0]], i + 1, 0))

    def wanted(self, vector: np.ndarray, share: float | None = None) -> dict[int, bytes]:
        """First-half centroid to a bit map of second-half centroids: cells until the share of rows is reached."""
        enough = (self.share if share is None else share) * self.rows.sum()
        cells: dict[int, list[int]] = {}
        seen = 0
        for i, j in self.traverse(vector):
            if self.rows[i, j]:
                cells.setdefault(i, []).append(j)
                seen += self.rows[i, j]
                if seen >= enough:
                    break
        maps = np.zeros((len(cells), self.rows.shape[1]), np.uint8)
        for row, chosen in zip(maps, cells.values()):
            row[chosen] = 1
        return dict(zip(cells, (m.tobytes() for m in np.packbits(maps, axis=1, bitorder="little"))))


def centroids_for(rows: int) -> int:
    """Centroids per half. Their pairs, the cells, grow as the square root of the rows, and so does a cell."""
    return max(8, math.ceil(3 * rows**0.25))


def nearest_centroid(points: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return np.argmin((centroids**2).sum(axis=1)[None] - 2 * points @ centroids.T, axis=1)


def quantise(points: np.ndarray, centroids: int, rounds: int = 15, seed: int = 7) -> np.ndarray:
    """Lloyd's algorithm on a bounded sample; an empty centroid moves to a random point."""
    draw = np.random.default_rng(seed)
    distinct = np.unique(points, axis=0)
    found = distinct[draw.permutation(len(distinct))[:centroids]].copy()
    for _ in range(rounds):
        owner = nearest_centroid(points, found)
        for k in range(len(found)):
            mine = points[owner == k]
            found[k] = mine.mean(axis=0) if len(mine) else points[draw.integers(len(points))]
    return found


def trial_share(index: Index, sample: np.ndarray, k: int, recall: float, seed: int = 7) -> float:
    """The share of rows that reaches ``recall`` when the sample is searched for its own members.

    Neighbours in a sample are farther away than among all rows, so the share errs on the high side.
    """
    if len(sample) <= k + 1:
        return 1.0
    queries = np.random.default_rng(seed).permutation(len(sample))[:TRIAL_QUERIES]
    one, two = index.cell(sample)
    rows = np.zeros_like(index.rows)
    np.add.at(rows, (one, two), 1)
    needed = []
    for q in queries:
        distance = ((sample - sample[q]) ** 2).sum(axis=1)
        distance[q] = np.inf
        near = np.argpartition(distance, k)[:k]
        seen, reached = 0, {}
        for cell in index.traverse(sample[q]):
            seen += rows[cell]
            reached[cell] = seen
        needed += [reached[one[n], two[n]] / len(sample) for n in near]
    return float(min(1.0, np.quantile(needed, recall) + 0.01))


def usable(vector: Column, size: int) -> Column:
    """Has ``size`` finite components that are not null and not all zero."""
    number = F.transform(vector, lambda x: x.cast("double"))
    finite = F.forall(number, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return vector.isNotNull() & (F.size(vector) == size) & finite & F.exists(number, lambda x: x != 0)


def build_index(vectors: DataFrame, k: int, centroids: int | None = None, sample: int = SAMPLE, recall: float = RECALL) -> Index | None:
    """Fit on at most ``sample`` vectors (the start of a scattered order of the ids), then count all rows per cell.

    Ids far from the start are left out where they lie, so only about twice the sample is sorted and sent.
    """
    n = vectors.count()
    if not n:
        return None
    scatter = F.md5(F.col("id").cast("string"))
    early = F.substring(scatter, 1, 8) <= f"{min(0xFFFFFFFF, int(2.0 * sample / n * (1 << 32))):08x}"
    drawn = vectors.where(early).orderBy(scatter, "id").limit(sample).select("vector").toPandas()
    if drawn.empty:  # every row has one and the same late id
        drawn = vectors.limit(1).select("vector").toPandas()
    centroids = centroids or centroids_for(n)
    points = np.array(drawn["vector"].tolist(), np.float64)
    half = max(1, points.shape[1] // 2)
    first, second = quantise(points[:, :half], centroids), quantise(points[:, half:], centroids)
    shape = Index(first, second, np.zeros((len(first), len(second)), np.int64), 1.0)
    counted = with_cells(vectors, shape).groupBy("block", "cell").agg(F.count(F.lit(1)).alias("n"))
    for row in counted.collect():  # at most centroids squared
        shape.rows[row["block"], row["cell"]] = row["n"]
    return Index(first, second, shape.rows, trial_share(shape, points, k, recall))


def with_cells(vectors: DataFrame, index: Index) -> DataFrame:
    """Every vector as an entry of its cell; a crowded block is dealt over parts by the id."""
    shared = vectors.sparkSession.sparkContext.broadcast((index, index.parts()))

    def entries(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        index, parts = shared.value
        for batch in batches:
            if len(batch):
                one, two = index.cell(np.array(batch["vector"].tolist(), np.float64))
                part = batch["id"].to_numpy().astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)
                part = (part % parts[one].astype(np.uint64)).astype(np.int32)
                yield pd.DataFrame({"block": one, "part": part, "kind": 0, "id": batch["id"], "cell": two, "wanted": b"", "vector": batch["vector"]})

    return vectors.select("id", "vector").mapInPandas(entries, ROW)


def with_visits(queries: DataFrame, index: Index) -> DataFrame:
    """Every query once for each block (and part) that holds cells it visits."""
    shared = queries.sparkSession.sparkContext.broadcast((index, index.parts()))

    def visits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        index, parts = shared.value
        for batch in batches:
            rows = [
                (block, part, 1, name, 0, mask, vector)
                for name, vector in zip(batch["id"], batch["vector"])
                for block, mask in index.wanted(np.asarray(vector, np.float64)).items()
                for part in range(parts[block])
            ]
            yield pd.DataFrame(rows, columns=["block", "part", "kind", "id", "cell", "wanted", "vector"])

    return queries.select("id", "vector").mapInPandas(visits, ROW)


def _rerank(ids: np.ndarray, cells: np.ndarray, vectors: np.ndarray, squares: np.ndarray, queries: pd.DataFrame, k: int) -> Iterator[tuple]:
    """The ``k`` nearest entries of each query in the cells it visits, by the exact distance."""
    asked = np.array(queries["vector"].tolist(), np.float64)
    rough = (asked**2).sum(axis=1)[:, None] + squares[None] - 2 * asked @ vectors.T
    maps = np.frombuffer(b"".join(queries["wanted"]), np.uint8).reshape(len(queries), -1)
    visited = np.unpackbits(maps, axis=1, bitorder="little")[:, cells]
    names = queries["id"].to_numpy()
    rough[(visited == 0) | (ids[None] == names[:, None])] = np.inf
    for row, name, vector in zip(rough, names, asked):
        found = np.flatnonzero(np.isfinite(row))
        if len(found) > k:
            limit = np.partition(row[found], k - 1)[k - 1]
            # Rounding moves the rough value by far less than this.
            found = found[row[found] <= limit + 1e-9 * (1.0 + abs(limit) + (vector**2).sum())]
        exact = np.sqrt(((vectors[found] - vector) ** 2).sum(axis=1))
        for n in np.lexsort((ids[found], exact))[:k]:
            yield int(name), int(ids[found][n]), float(exact[n])


def search(vectors: DataFrame, is_query: Column, k: int = 10, vec_id: str = "vec_id", vector: str = "embedding", recall: float = RECALL) -> DataFrame:
    """``query_id``, ``rank`` from 1, ``vec_id`` and ``score`` (Euclidean distance) of the ``k`` nearest rows found.

    Queries are the rows of ``vectors`` for which ``is_query`` holds; candidates are all rows but those with the
    query's id. Vectors that are null, zero, of another length than most, or hold null or non-finite components take
    no part, nor do rows without an id. Rows that repeat an id are candidates of their own, but one query. Equal
    distances are ordered by the smaller id. With fewer candidates than ``k`` all visited ones are returned; an
    empty table gives no rows.

    Each half of a vector is quantised on its own; a cell is a pair of centroids. A query visits cells in the order
    of summed distance until it has seen a share of the rows that reached ``recall`` on a sample. Entries are
    shuffled once by block (first centroid) and part, queries once per block they visit; a task holds one part of a
    few thousand entries at a time.
    """
    number = F.transform(quoted(vector), lambda x: x.cast("double"))
    sized = vectors.where(quoted(vector).isNotNull()).groupBy(F.size(quoted(vector)).alias("size")).count()
    most = sized.orderBy(F.desc("count"), F.desc("size")).first()
    size = most["size"] if most else 0
    good = vectors.where(quoted(vec_id).isNotNull() & usable(quoted(vector), size))
    rows = good.select(quoted(vec_id).cast("long").alias("id"), number.alias("vector"), is_query.alias("asks"))
    index = build_index(rows, k, recall=recall)
    if index is None:
        return rows.select(F.col("id").alias("query_id"), F.lit(1).alias("rank"), F.col("id").alias("vec_id"), F.lit(0.0).alias("score")).limit(0)
    queries = rows.where("asks").groupBy("id").agg(F.min("vector").alias("vector"))
    dealt = with_cells(rows, index).unionByName(with_visits(queries, index)).repartition("block", "part")

    def found(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, entries, loaded = None, [], None
        for batch in batches:
            for (block, part, kind), rows in batch.groupby(["block", "part", "kind"], sort=True):
                if (block, part) != key:
                    key, entries, loaded = (block, part), [], None
                if kind == 0:
                    entries.append(rows)
                    continue
                if loaded is None and entries:
                    held = pd.concat(entries)
                    matrix = np.array(held["vector"].tolist(), np.float64)
                    loaded = held["id"].to_numpy(), held["cell"].to_numpy().astype(np.int64), matrix, (matrix**2).sum(axis=1)
                for at in range(0, len(rows) if loaded else 0, 512):
                    near = list(_rerank(*loaded, rows.iloc[at : at + 512], k))
                    yield pd.DataFrame(near, columns=["query_id", "vec_id", "score"])

    near = dealt.sortWithinPartitions("block", "part", "kind").mapInPandas(found, "query_id long, vec_id long, score double")
    nearest = Window.partitionBy("query_id").orderBy("score", "vec_id")
    ranked = near.withColumn("rank", F.row_number().over(nearest)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
