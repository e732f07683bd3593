"""Approximate nearest neighbours with a vantage-point tree per shard.

Each inner node of a tree has a vantage point and halves the other points by their distance
to it. The triangle inequality bounds the distance of a query to all points of a half from
below; a half is skipped if that bound, times the relaxation factor, exceeds the distance of
the query's k-th best point so far. Factor one skips only what cannot matter, so the search
is exact; larger factors skip more. A whole block of queries walks the tree together: first
each query goes down to its nearest leaf, which gives it a radius, then all leaves that are
still in reach of some query are compared with just these queries.

Defined results: vectors that are null, all zero or empty, or hold a null or non-finite
component take no part, neither do rows without id. Equal distances go to the smaller id.
All rows of a repeated id take part: none is a candidate of its own id, each is one of other
ids. Vectors of different length never meet. A query with fewer than ``k`` candidates gets all
of them.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from milepost.llm.blocks import components, finite, search_blocks

LEAF = 64
SHARD_ROWS = 8_192
BLOCK_ROWS = 512
RELAXATION = 1.25


def distances(points: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Euclidean distance of each point to each of the others, in double precision."""
    out = np.empty((len(points), len(others)))
    others = others.astype(np.float64, copy=False)
    for i in range(0, len(points), 64):
        step = points[i : i + 64, None, :].astype(np.float64, copy=False) - others[None, :, :]
        out[i : i + 64] = np.sqrt(np.einsum("ijk,ijk->ij", step, step))
    return out


def build_tree(ids: np.ndarray, points: np.ndarray, leaf: int = LEAF) -> dict:
    """Tree as plain arrays. A node is a stretch of ``order``; the first entry is its vantage point.

    ``reach`` holds, for both halves, the least and greatest distance to the vantage point.
    """
    order = np.arange(len(ids))
    nodes: list[tuple[int, int, int, int]] = []  # from, to, near child, far child
    reach: list[tuple[float, float, float, float]] = []
    todo = [(0, len(ids), -1, 0)]
    while todo:
        start, end, parent, side = todo.pop()
        here = len(nodes)
        if parent >= 0:
            a, b, *children = nodes[parent]
            children[side] = here
            nodes[parent] = (a, b, *children)
        nodes.append((start, end, -1, -1))
        reach.append((0.0, 0.0, 0.0, 0.0))
        if end - start <= leaf:
            continue
        part = order[start:end]
        # the point farthest from an arbitrary one makes a good vantage point
        far = int(distances(points[part[:1]], points[part])[0].argmax())
        part[[0, far]] = part[[far, 0]]
        away = distances(points[part[:1]], points[part[1:]])[0]
        rank = np.argsort(away, kind="stable")
        part[1:] = part[1:][rank]
        away, half = away[rank], len(away) // 2
        reach[here] = (away[0], away[half - 1], away[half], away[-1])
        todo += [(start + 1, start + 1 + half, here, 0), (start + 1 + half, end, here, 1)]
    return {"ids": ids, "points": points, "order": order, "nodes": np.array(nodes), "reach": np.array(reach)}


def search_tree(tree: dict, ids: np.ndarray, queries: np.ndarray, k: int, relaxation: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of the queries, ids and distances of the points found."""
    order, nodes, reach, points = tree["order"], tree["nodes"], tree["reach"], tree["points"]
    best = np.full((len(ids), k), np.inf)
    who = np.full((len(ids), k), np.iinfo(np.int64).max)

    def compare(active: np.ndarray, part: np.ndarray, away: np.ndarray | None = None) -> None:
        away = distances(queries[active], points[part]) if away is None else away
        away = np.where(ids[active][:, None] == tree["ids"][part][None, :], np.inf, away)
        hit = (away <= best[active, -1:]).any(1)
        active, away = active[hit], away[hit]
        if not len(active):
            return
        both = np.concatenate((best[active], away), axis=1)
        names = np.concatenate((who[active], np.broadcast_to(tree["ids"][part], away.shape)), axis=1)
        names = np.where(np.isinf(both), np.iinfo(np.int64).max, names)
        rank = np.lexsort((names, both), axis=-1)[:, :k]
        best[active] = np.take_along_axis(both, rank, 1)
        who[active] = np.take_along_axis(names, rank, 1)

    def bounds(node: int, away: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        low_in, high_in, low_out, high_out = reach[node]
        return np.maximum(low_in - away, away - high_in), np.maximum(low_out - away, away - high_out)

    # down to the nearest leaf
    home = np.full(len(ids), -1)
    todo = [(0, np.arange(len(ids)))]
    while todo:
        node, active = todo.pop()
        start, end, near, far = nodes[node]
        if near < 0:
            home[active] = node
            compare(active, order[start:end])
            continue
        inside, outside = bounds(node, distances(queries[active], points[order[start : start + 1]])[:, 0])
        todo += [(child, group) for child, group in ((near, active[inside <= outside]), (far, active[inside > outside])) if len(group)]
    # one walk for all
    todo = [(0, np.arange(len(ids)))]
    while todo:
        node, active = todo.pop()
        start, end, near, far = nodes[node]
        if near < 0:
            active = active[home[active] != node]
            if len(active):
                compare(active, order[start:end])
            continue
        away = distances(queries[active], points[order[start : start + 1]])
        compare(active, order[start : start + 1], away)
        radius = best[active, -1] * (1 + 1e-12)
        for child, bound in zip((near, far), bounds(node, away[:, 0])):
            group = active[bound * relaxation <= radius]
            if len(group):
                todo.append((child, group))
    owner, column = np.nonzero(np.isfinite(best))
    return owner, who[owner, column], best[owner, column]


def nearest(
    vectors: DataFrame,
    queries: Column,
    k: int = 10,
    relaxation: float = RELAXATION,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    shard_rows: int = SHARD_ROWS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: up to ``k`` nearest rows of each query row."""
    vector = components(vectors, vector_column)
    rows = vectors.select(F.col(id_column).cast("long").alias("id"), vector.alias("vector"), queries.alias("_asked"))
    rows = rows.where(finite(F.col("vector")) & F.exists("vector", lambda x: x != 0))

    def search(tree: dict, ids: np.ndarray, values: np.ndarray):
        return search_tree(tree, ids, values, k, relaxation)

    return search_blocks(rows, F.col("_asked"), build_tree, search, k, "double", F.asc, shard_rows, block_rows)
