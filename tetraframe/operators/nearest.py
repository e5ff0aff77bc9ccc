"""Nearest neighbours of a whole cloud by a k-d partition.

A bounded sample gives the splits of a k-d tree whose leaves hold about equally many points, whatever the cloud's density; the tree has some
thousand leaves at most and goes to every task. A leaf's points meet in one task, which splits them on into blocks and finds
each point's nearest there. Only a point whose distance reaches over its leaf's box goes on, once, to the leaves it reaches.

Leaves with more points than a task should hold are split again by what lies in them: points of many equal places, which no split
parts, are nearest to each other and are counted first.

Queries and points of frames share one such tree, in which the frame is one more axis, whose steps are too long for the tolerance.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tetraframe.operators.filters import shuffle_key
from tetraframe.operators.tables import dropped, kept_table

#: Points the driver reads for the splits, points of a leaf on average and leaves at most, points of a block.
SAMPLE, LEAF, LEAVES, BLOCK = 50_000, 20_000, 4_096, 128


class Tree:
    """Splits of a cloud: inner nodes in the order of a heap, node k's children 2k + 1 and 2k + 2, leaves numbered from the left."""

    def __init__(self, sample: np.ndarray, depth: int):
        self.depth, n = depth, sample.shape[1]
        inner = (1 << depth) - 1
        self.axis, self.at = np.zeros(inner, np.int64), np.zeros(inner)
        self.low, self.high = np.full((2 * inner + 1, n), -np.inf), np.full((2 * inner + 1, n), np.inf)
        parts = {0: sample}
        for k in range(inner):
            p = parts.pop(k)
            if len(p):
                self.axis[k] = int(np.argmax(p.max(0) - p.min(0)))
                self.at[k] = np.median(p[:, self.axis[k]])
            left = p[:, self.axis[k]] < self.at[k]
            for child, own in ((2 * k + 1, p[left]), (2 * k + 2, p[~left])):
                parts[child] = own
                self.low[child], self.high[child] = self.low[k], self.high[k]
            self.high[2 * k + 1, self.axis[k]] = self.low[2 * k + 2, self.axis[k]] = self.at[k]

    def leaf(self, points: np.ndarray) -> np.ndarray:
        """The leaf of each point."""
        node = np.zeros(len(points), np.int64)
        for _ in range(self.depth):
            node = 2 * node + 1 + (points[np.arange(len(points)), self.axis[node]] >= self.at[node])
        return node - ((1 << self.depth) - 1)

    def reached(self, points: np.ndarray, radius: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(point, leaf) pairs of leaves whose boxes come nearer than the radius: the tree is gone down for all points together."""
        who, node = np.arange(len(points)), np.zeros(len(points), np.int64)
        for _ in range(self.depth):
            who, node = np.repeat(who, 2), np.stack([2 * node + 1, 2 * node + 2], 1).ravel()
            gap = np.maximum(np.maximum(self.low[node] - points[who], points[who] - self.high[node]), 0)
            near = (gap**2).sum(1) < radius[who] ** 2
            who, node = who[near], node[near]
        return who, node - ((1 << self.depth) - 1)


def _blocks(points: np.ndarray, most: int) -> list[np.ndarray]:
    """Places of the points, split at medians along the widest axis until at most `most` are together."""
    out, todo = [], [np.arange(len(points))]
    while todo:
        at = todo.pop()
        if len(at) <= most:
            out.append(at)
            continue
        p = points[at]
        axis = int(np.argmax(p.max(0) - p.min(0)))
        half = len(at) // 2
        order = np.argpartition(p[:, axis], half)
        todo += [at[order[:half]], at[order[half:]]]
    return out


def nearest_among(queries: np.ndarray, query_ids: np.ndarray, points: np.ndarray, ids: np.ndarray, bound: np.ndarray, block: int = BLOCK) -> np.ndarray:
    """Distance of each query to its nearest point of another id, where it is below its bound; else the bound.

    Queries and points are taken in blocks; a pair of blocks is compared only if their boxes are nearer than the block's largest bound.
    """
    if not len(queries) or not len(points):
        return bound
    best = bound.copy()
    own = _blocks(points, block)
    low, high = np.stack([points[b].min(0) for b in own]), np.stack([points[b].max(0) for b in own])
    for q in _blocks(queries, block):
        a, b = queries[q].min(0), queries[q].max(0)
        gap = np.sqrt((np.maximum(np.maximum(low - b, a - high), 0) ** 2).sum(1))
        for k in np.argsort(gap, kind="stable"):
            if gap[k] >= best[q].max():
                break
            d = np.sqrt(((queries[q][:, None] - points[own[k]][None]) ** 2).sum(2))
            d[query_ids[q][:, None] == ids[own[k]][None]] = np.inf
            best[q] = np.minimum(best[q], d.min(1))
    return best


def nearest_distance(points: DataFrame, names: list[str], leaf: int = LEAF, seed: int = 0) -> DataFrame:
    """(id, distance): distance of each point to its nearest other one. Ids are distinct; points without a place, or alone, have no row."""
    xs = [f"_x{k}" for k in range(len(names))]
    known = points.select("id", *(F.col(n).cast("double").alias(x) for n, x in zip(names, xs))).where(" AND ".join(f"abs({x}) < double('infinity')" for x in xs))
    places, _ = kept_table(known, "places")
    # Points that share a place are at distance 0; one of each place goes on.
    shared = places.groupBy(*xs).agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("_n"))
    once, _ = kept_table(shared, "once")
    n = once.count()
    depth = max(0, int(np.ceil(np.log2(max(1, min(n / leaf, LEAVES))))))
    some = once.orderBy(shuffle_key(F.col("id"), seed), "id").limit(SAMPLE).select(*xs).toArrow()
    tree = Tree(np.stack([some[x].to_numpy() for x in xs], 1) if len(some) else np.zeros((0, len(xs))), depth)

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = np.stack([batch.column(x).to_numpy() for x in xs], 1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(tree.leaf(p))], [*batch.schema.names, "leaf"])

    kinds = ", ".join(f"{x} double" for x in xs)
    leaves, _ = kept_table(once.select("id", *xs).mapInArrow(placed, f"id long, {kinds}, leaf long"), "leaves")

    def inside(pdf: pd.DataFrame) -> pd.DataFrame:
        p, ids = pdf[xs].to_numpy(), pdf["id"].to_numpy()
        return pdf.assign(distance=nearest_among(p, ids, p, ids, np.full(len(p), np.inf)))

    first, _ = kept_table(leaves.groupBy("leaf").applyInPandas(inside, f"id long, {kinds}, leaf long, distance double"), "first")

    def onward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = np.stack([batch.column(x).to_numpy() for x in xs], 1)
            who, at = tree.reached(p, batch.column("distance").to_numpy())
            other = at != batch.column("leaf").to_numpy()[who]
            rows = batch.take(pa.array(who[other]))
            yield pa.RecordBatch.from_arrays([*(rows.column(c) for c in ("id", *xs, "distance")), pa.array(at[other])], ["id", *xs, "distance", "leaf"])

    asked = first.mapInArrow(onward, f"id long, {kinds}, distance double, leaf long")

    def outside(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        found = nearest_among(left[xs].to_numpy(), left["id"].to_numpy(), right[xs].to_numpy(), right["id"].to_numpy(), left["distance"].to_numpy())
        return left[["id"]].assign(distance=found)

    more = asked.groupBy("leaf").cogroup(leaves.groupBy("leaf")).applyInPandas(outside, "id long, distance double")
    best = first.select("id", "distance").unionByName(more).groupBy("id").agg(F.min("distance").alias("distance"))
    zero = places.join(once.where("_n > 1").select(*xs), xs).select("id", F.lit(0.0).alias("distance"))
    single = best.join(once.where("_n = 1").select("id"), "id").where(F.col("distance") < float("inf"))
    return single.unionByName(zero)


def _length(parts: np.ndarray) -> np.ndarray:
    """Euclidean length of arrays, one a component, summed from the first on."""
    total = parts[0] * parts[0]
    for p in parts[1:]:
        total = total + p * p
    return np.sqrt(total)


def first_within(queries: np.ndarray, points: np.ndarray, bound: np.ndarray, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray]:
    """Distance and number of each query's nearest point, of equally near ones the first; the bound and len(points) where none is as near as that."""
    best, at = bound.copy(), np.full(len(queries), len(points))
    if not len(queries) or not len(points):
        return best, at
    own = [np.sort(b) for b in _blocks(points, block)]
    low, high = np.stack([points[b].min(0) for b in own]), np.stack([points[b].max(0) for b in own])
    for q in _blocks(queries, block):
        a, b = queries[q].min(0), queries[q].max(0)
        # The sums are those of distances, so rounding lets no gap exceed a distance.
        gap = _length(np.maximum(np.maximum(low - b, a - high), 0).T)
        near = np.flatnonzero(gap <= best[q].max())
        for k in near[np.argsort(gap[near], kind="stable")]:
            if gap[k] > best[q].max():
                break
            d = _length(queries[q].T[:, :, None] - points[own[k]].T[:, None, :])
            j = d.argmin(1)
            d, j = d[np.arange(len(q)), j], own[k][j]
            closer = (d < best[q]) | ((d == best[q]) & (j < at[q]))
            best[q], at[q] = np.where(closer, d, best[q]), np.where(closer, j, at[q])
    return best, at


def taken_within(queries: DataFrame, points: DataFrame, names: list[str], tolerance: float, leaf: int = LEAF) -> DataFrame:
    """(frame, id, track_id): points (frame, id) that are nearest, within the tolerance, to a query (frame, track_id) of their frame.

    Of equally near points the smaller id is taken; one that several queries take goes to the lowest track. Queries and points meet by
    leaves; a query goes on, once, to the other leaves that its distance reaches, or the tolerance where its leaf has no point as near.
    Frames are numbers. Rows without a frame or place don't count.
    """
    spark, xs = points.sparkSession, [f"_x{k}" for k in range(len(names))]

    def known(df: DataFrame, key: str) -> DataFrame:
        out = df.select("frame", key, *(F.col(n).cast("double").alias(x) for n, x in zip(names, xs)))
        return out.where(" AND ".join(["frame IS NOT NULL", *(f"abs({x}) < double('infinity')" for x in xs)]))

    points, points_at = kept_table(known(points, "id"), "points")
    queries, queries_at = kept_table(known(queries, "track_id"), "queries")
    n = points.count() + queries.count()
    depth = max(0, int(np.ceil(np.log2(max(1, min(n / leaf, LEAVES))))))
    step = 8 * tolerance + 1

    def places(t: pa.Table | pa.RecordBatch) -> np.ndarray:
        return np.stack([t.column("frame").to_numpy() * step, *(t.column(x).to_numpy() for x in xs)], 1)

    picked = [df.where(F.pmod(F.xxhash64("frame", key, *xs), F.lit(max(n, 1))) < SAMPLE).select("frame", *xs) for df, key in ((points, "id"), (queries, "track_id"))]
    some = places(picked[0].unionByName(picked[1]).limit(2 * SAMPLE if depth else 0).toArrow())
    tree = Tree(some, depth)
    # Where splits part no more, rows share few places: of a place's rows only the smallest point and the lowest track count.
    held = np.bincount(tree.leaf(some), minlength=1 << depth)
    full = np.flatnonzero(held > 4 * held.mean()).tolist()

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(tree.leaf(places(batch)), pa.int32())], [*batch.schema.names, "leaf"])

    def kinds(df: DataFrame, *columns: str) -> str:
        return ", ".join(f"{c} {df.schema[c].dataType.simpleString()}" for c in columns)

    def dealt(df: DataFrame, key: str) -> DataFrame:
        out = df.mapInArrow(placed, f"{kinds(df, 'frame', key, *xs)}, leaf int")
        if not full:
            return out
        once = out.where(F.col("leaf").isin(full)).groupBy("leaf", "frame", *xs).agg(F.min(key).alias(key))
        return out.where(~F.col("leaf").isin(full)).unionByName(once)

    def best(left: pa.Table, right: pa.Table, bound: np.ndarray) -> pa.Table:
        """The queries with their nearest point's id and distance; null where none is within the bound."""
        right = right.take(pc.sort_indices(right["id"], null_placement="at_end"))
        d, at = first_within(places(left), places(right), bound)
        none = at == right.num_rows
        return pa.table({"frame": left["frame"], "track_id": left["track_id"], "id": right["id"].take(pa.array(at, mask=none)), "_d": pa.array(d, mask=none)})

    def inside(left: pa.Table, right: pa.Table) -> pa.Table:
        """The best of each query, once if no other leaf is reached, else a row for each of those, with its place."""
        found, p = best(left, right, np.full(left.num_rows, float(tolerance))), places(left)
        # Leaves reach from a frame's step, or the middle between two: a quarter on, only its own come near.
        p[:, 0] += step / 4
        who, to = tree.reached(p, found["_d"].fill_null(float(tolerance)).to_numpy() * (1 + 1e-9) + 1e-150)
        other = to != left["leaf"].to_numpy()[who]
        who, to = who[other], to[other]
        stay = np.setdiff1d(np.arange(left.num_rows), who)
        rows = pa.array(np.concatenate([stay, who]))
        leaves = pa.array(np.concatenate([np.full(len(stay), -1), to]), pa.int32())
        return pa.table({**{c: found[c].take(rows) for c in found.column_names}, **{x: left[x].take(rows) for x in xs}, "leaf": leaves})

    def outside(left: pa.Table, right: pa.Table) -> pa.Table:
        return best(left, right, left["_d"].fill_null(float(tolerance)).to_numpy())

    there, own = dealt(points, "id").groupBy("leaf"), f"{kinds(queries, 'frame', 'track_id')}, {kinds(points, 'id')}, _d double"
    first = dealt(queries, "track_id").groupBy("leaf").cogroup(there).applyInArrow(inside, f"{own}, {kinds(points, *xs)}, leaf int")
    first, first_at = kept_table(first, "first")
    dropped(spark, queries_at)
    onward = first.where("leaf >= 0")
    more = onward.select("frame", "track_id", "id", "_d").unionByName(onward.groupBy("leaf").cogroup(there).applyInArrow(outside, own)).where("_d IS NOT NULL")
    least = more.groupBy("track_id", "frame").agg(F.min(F.struct("_d", F.col("id").isNull().alias("_n"), "id")).alias("_b")).select("frame", F.col("_b.id").alias("id"), "track_id")
    settled = first.where("leaf < 0 AND _d IS NOT NULL").select("frame", "id", "track_id")
    taken, _ = kept_table(settled.unionByName(least).groupBy("frame", "id").agg(F.min("track_id").alias("track_id")), "taken")
    dropped(spark, points_at, first_at)
    return taken
