"""Exact top-k by integer inner product on a bit-sliced index.

A shard keeps, for each attribute and each bit of its shifted value, a bitmap over the rows.
The scores of all rows for a query are a weighted sum of attributes. It is formed on bitmaps
alone: for each bit of the weights, from the most significant down, the slices of the
attributes with that bit are added by carry-save adders, 64 rows per machine word. A negative
weight adds the complement instead, which shifts all scores by the same amount. The top rows
are then selected from the most significant slice of the sum downward. Rows still undecided
after the last slice tie exactly and go by id. Selected rows get their exact score from the
stored values.

A row is wide if products with rows like it could leave 64 bits. Wide rows have shards and
blocks of their own, and whatever meets them is multiplied in whole numbers of any length.

Defined results: vectors that are null or hold a null or non-finite component take no part,
neither do rows without id. All rows of a repeated id take part: none is a candidate of its
own id, each is one of other ids. A score beyond 64 bits counts as the nearest 64-bit number.
Vectors of different length never meet; those of
length 0 score 0. A query with fewer than ``k`` candidates gets all of them.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from milepost.llm.blocks import components, finite, search_blocks

SCALE = 256
SHARD_ROWS = 32_768
BLOCK_ROWS = 128
WIDE = float(2**31)  # greatest component times the root of the length
LONGEST, LEAST = 2**63 - 1, -(2**63)


def scaled(values: np.ndarray, scale: int) -> np.ndarray:
    """``floor(scale * x)`` as 64-bit numbers, or as whole numbers of any length if these are too short."""
    values = values.astype(np.float64, copy=False)
    if is_wide(values, scale):
        whole = lambda x: int(x) * scale if abs(x) >= 2**53 else math.floor(x * scale)
        return np.array([[whole(x) for x in row] for row in values.tolist()], object).reshape(values.shape)
    return np.floor(values * scale).astype(np.int64)


def is_wide(values: np.ndarray, scale: int) -> bool:
    return bool(values.size) and float(np.abs(values).max()) * math.sqrt(values.shape[1]) >= WIDE / scale


def build_slices(ids: np.ndarray, values: np.ndarray) -> dict:
    """Bitmaps (attribute, bit, word of 64 rows) of the values less their minimum."""
    if values.dtype == object:
        return {"ids": ids, "values": values, "slices": None, "bits": 0}
    values = values.astype(np.int64)
    low = int(values.min()) if values.size else 0
    shifted = values - low
    bits = int(shifted.max()).bit_length() if values.size else 0
    words = -(-len(ids) // 64)
    slices = np.zeros((values.shape[1], bits, words * 64), np.uint8)
    for bit in range(bits):
        slices[:, bit, : len(ids)] = ((shifted >> bit) & 1).T
    packed = np.packbits(slices, axis=2, bitorder="little").view(np.uint64)
    return {"ids": ids, "values": values, "slices": packed, "bits": bits}


def weighted_sum(slices: np.ndarray, weights: np.ndarray, bits: int) -> np.ndarray:
    """Slices of the sum of ``weight * attribute`` per row, up to a constant for all rows."""
    most = int(np.abs(weights).sum()) * ((1 << bits) - 1)
    height, words = most.bit_length(), slices.shape[2]
    total, carry = np.zeros((height, words), np.uint64), np.zeros((height, words), np.uint64)
    half, both = np.empty_like(total), np.empty_like(total)
    for bit in reversed(range(int(np.abs(weights).max(initial=0)).bit_length())):
        total[1:], carry[1:] = total[:-1].copy(), carry[:-1].copy()
        total[:1] = carry[:1] = 0
        for attribute in np.flatnonzero((np.abs(weights) >> bit) & 1):
            add = slices[attribute] if weights[attribute] > 0 else ~slices[attribute]
            np.bitwise_xor(total, carry, out=half)
            np.bitwise_and(total, carry, out=both)
            both[:bits] |= half[:bits] & add
            half[:bits] ^= add
            total, half = half, total
            carry[1:] = both[:-1]
            carry[:1] = 0
    ripple = np.zeros(words, np.uint64)
    for row in range(height):
        a, b = total[row].copy(), carry[row]
        total[row] = a ^ b ^ ripple
        ripple = (a & b) | (ripple & (a ^ b))
    return total


def select_top(sums: np.ndarray, rows: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` greatest sums among ``rows`` (a bitmap), ties to the first places."""
    sure, tied = np.zeros_like(rows), rows
    for piece in sums[::-1]:
        high = tied & piece
        count = int(np.bitwise_count(sure | high).sum())
        if count > k:
            tied = high
        else:
            sure, tied = sure | high, tied & ~piece
            if count == k:
                tied = np.zeros_like(tied)
                break
    where = lambda bitmap: np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little"))
    chosen = where(sure)
    return np.concatenate((chosen, where(tied)[: k - len(chosen)]))


def search_wide(index: dict, ids: np.ndarray, queries: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Like ``search_slices``, by multiplying whole numbers of any length."""
    values, own = index["values"].astype(object), index["ids"]
    owner, found, scores = [], [], []
    for place, (name, weights) in enumerate(zip(ids, queries.astype(object))):
        every = values.dot(weights) if values.shape[1] else np.zeros(len(own), object)
        every = np.clip(every, LEAST, LONGEST).astype(np.int64)
        top = heapq.nsmallest(k, np.flatnonzero(own != name).tolist(), key=lambda i: (-int(every[i]), own[i]))
        owner += [place] * len(top)
        found += [int(own[i]) for i in top]
        scores += [int(every[i]) for i in top]
    return np.array(owner, np.int64), np.array(found, np.int64), np.array(scores, np.int64)


def search_slices(index: dict, ids: np.ndarray, queries: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of the queries, ids and scores of the rows found."""
    if index["slices"] is None or queries.dtype == object:
        return search_wide(index, ids, queries, k)
    count, own = len(index["ids"]), index["ids"]
    everyone = np.zeros(index["slices"].shape[2] * 64, np.uint8)
    everyone[:count] = 1
    everyone = np.packbits(everyone, bitorder="little").view(np.uint64)
    owner, found, scores = [], [], []
    for place, (name, weights) in enumerate(zip(ids, queries.astype(np.int64))):
        rows = everyone.copy()
        for at in range(np.searchsorted(own, name), np.searchsorted(own, name, "right")):
            rows[at // 64] &= ~np.uint64(1 << (at % 64))
        top = select_top(weighted_sum(index["slices"], weights, index["bits"]), rows, k)
        owner.append(np.full(len(top), place))
        found.append(own[top])
        scores.append(index["values"][top] @ weights)
    return np.concatenate(owner), np.concatenate(found), np.concatenate(scores)


def top_products(
    vectors: DataFrame,
    queries: Column,
    k: int = 5,
    scale: int = SCALE,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    shard_rows: int = SHARD_ROWS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: up to ``k`` rows with the greatest inner product."""
    vector = components(vectors, vector_column)
    rows = vectors.where(finite(vector)).select(F.col(id_column).cast("long").alias("id"), vector.alias("vector"), queries.alias("_asked"))
    greatest = F.array_max(F.transform("vector", lambda x: F.abs(x).cast("double")))
    wide = F.coalesce(greatest * F.sqrt(F.size("vector")) >= F.lit(WIDE / scale), F.lit(False))

    def build(ids: np.ndarray, values: np.ndarray) -> dict:
        return build_slices(ids, scaled(values, scale))

    def search(index: dict, ids: np.ndarray, values: np.ndarray):
        return search_slices(index, ids, scaled(values, scale), k)

    return search_blocks(rows, F.col("_asked"), build, search, k, "long", F.desc, shard_rows, block_rows, wide)
