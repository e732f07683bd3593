"""Ranked lexical search by presence masks.

Documents are tokenised once into segments: per batch the terms that items ask for, with the
documents that hold each and how often. The search visits every segment with a block of
items. Per item the postings become bitmaps over the documents of the segment, and documents
with the same bits, that is with the same matched terms, form a group. The bits of a group
with the greatest frequencies and the shortest document give the most its documents can
score. Groups are scored by descending bound until no later one can reach the ``k`` best found
so far, which each task carries from segment to segment.

A term weighs ``floor(1000 ln((2N + 2) / (2 df + 1)))``; all else is 64-bit integer, see
``impact``. Terms are compared as strings: a bit table of hashes only keeps terms that no
item holds out of the segments.

Defined results: a null or empty text has no term; such a document is not counted and never
found. Every row of items is an item of its own, also if it repeats an id; one without a
known term finds nothing. Rows that repeat a doc_id are documents of their own, and a null
doc_id comes last among equal scores. Other columns are left out. An item's terms and a
block's lists are held in a task: ``BLOCK_ITEMS`` items or ``BLOCK_TERMS`` terms, or one item.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from milepost.llm.arrays import ranges, span_hashes, text_runs, words
from milepost.llm.tables import bit_places, bit_table, has_bits
from milepost.operators.windows import top_rows, write_once

K = 20
BLOCK_ITEMS, BLOCK_TERMS = 512, 1 << 17

# [^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]: bytes of a term
TERM_BYTE = np.zeros(256, bool)
TERM_BYTE[0x80:] = True
for _first, _last in ("09", "AZ", "az"):
    TERM_BYTE[ord(_first) : ord(_last) + 1] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def terms(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-case bytes, start and end of every term, and the terms before each text."""
    return LOWER[data], *words(data, offsets, TERM_BYTE)


def strings(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The pieces ``data[start:end]``, which are whole characters, as a string column."""
    sizes = ends - starts
    offsets = np.concatenate(([0], np.cumsum(sizes)))
    pieces = data[ranges(starts, sizes)]
    return pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(pieces))


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, last, data, offsets in text_runs(batch.column("text")):
            data, starts, ends, bounds = terms(data, offsets)
            owner = np.repeat(np.arange(first, last), np.diff(bounds))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("key").take(pa.array(owner)),
                    strings(data, starts, ends).cast(pa.string()),
                    pa.array(bit_places(span_hashes(data, starts, ends))),
                ],
                names=["key", "term", "place"],
            )


SEGMENT = (
    "doc_id array<long>, n array<long>, term array<string>, df array<long>, at array<int>, tf array<long>"
)


def _segments(table: np.ndarray):
    """One segment per batch of texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, names, owners = [], [], []
            for first, last, data, offsets in text_runs(batch.column("text")):
                data, starts, ends, bounds = terms(data, offsets)
                sizes.append(np.diff(bounds))
                asked = has_bits(table, bit_places(span_hashes(data, starts, ends)))
                owners.append(np.repeat(np.arange(first, last), sizes[-1])[asked])
                names.append(strings(data, starts[asked], ends[asked]))
            if not sizes:
                continue
            n, owner = np.concatenate(sizes), np.concatenate(owners)
            coded = pa.chunked_array(names).combine_chunks().dictionary_encode()
            codes = coded.indices.to_numpy().astype(np.int64)
            pairs, tf = np.unique(codes * len(batch) + owner, return_counts=True)
            df = np.bincount(pairs // len(batch), minlength=len(coded.dictionary))
            yield pa.RecordBatch.from_arrays(
                [
                    _one_list(batch.column("doc_id").cast(pa.int64())), _one_list(pa.array(n, pa.int64())),
                    _one_list(coded.dictionary.cast(pa.string())), _one_list(pa.array(df, pa.int64())),
                    _one_list(pa.array(pairs % len(batch), pa.int32())), _one_list(pa.array(tf, pa.int64())),
                ],
                names=[c.split()[0] for c in SEGMENT.split(", ")],
            )
    return run


def _one_list(values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def impact(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return 1_000_000_000 * tf // (1000 * tf + 12 * m)


def by_mask(present: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Group columns of ``present`` (terms by documents) with equal bits.

    Returns the bits of each group, the documents ordered by group, and where each group begins.
    """
    bits = np.packbits(present, axis=0)
    bits = np.concatenate((bits, np.zeros((-len(bits) % 8, bits.shape[1]), np.uint8)))
    group = np.zeros(bits.shape[1], np.int64)
    for i in range(0, len(bits), 8):
        eight = np.ascontiguousarray(bits[i : i + 8].T).view(np.uint64)[:, 0]
        one = np.unique(eight, return_inverse=True)[1]
        group = np.unique(group * (len(one) + 1) + one, return_inverse=True)[1]
    order = np.argsort(group, kind="stable")
    begins = np.flatnonzero(np.concatenate(([True], np.diff(group[order]) != 0)))
    return present[:, order[begins]], order, begins


class Best:
    """The ``k`` best documents of an item so far: greatest score, then least doc_id."""

    def __init__(self, k: int):
        self.k, self.ids, self.known, self.scores = k, *(np.zeros(0, t) for t in (np.int64, bool, np.int64))

    def least(self) -> int:
        """What a document must reach to enter."""
        return int(self.scores[-1]) if len(self.scores) == self.k else 1

    def add(self, ids: np.ndarray, known: np.ndarray, scores: np.ndarray) -> None:
        good = scores >= self.least()
        ids, known, scores = (np.concatenate(p) for p in ((self.ids, ids[good]), (self.known, known[good]), (self.scores, scores[good])))
        order = np.lexsort((ids, ~known, -scores))[: self.k]
        self.ids, self.known, self.scores = ids[order], known[order], scores[order]


def search_segment(best: Best, ids: np.ndarray, known: np.ndarray, m: np.ndarray, tf: np.ndarray, weights: np.ndarray) -> None:
    """Add the documents of a segment; ``tf`` has a row per term of the item, with its weight."""
    some = np.flatnonzero(tf.any(axis=0))
    if not len(some):
        return
    tf, m = tf[:, some], m[some]
    masks, order, begins = by_mask(tf > 0)
    most = weights * impact(tf.max(axis=1), m.min())
    bounds = most @ masks
    sizes = np.diff(np.append(begins, len(order)))
    ranked = np.argsort(-bounds, kind="stable")
    done, step = 0, 1
    while done < len(ranked) and bounds[ranked[done]] >= best.least():
        groups = ranked[done : done + step]
        docs = order[ranges(begins[groups], sizes[groups])]
        scores = (weights[:, None] * impact(tf[:, docs], m[docs])).sum(axis=0)
        best.add(ids[some[docs]], known[some[docs]], scores)
        done, step = done + step, min(2 * step, 256)


def _search(items: list[Row], total: int, length: int, k: int):
    """Best documents per item of a block, over all segments of a task."""
    vocabulary = sorted({t.term for item in items for t in item.terms})
    number = {t: i for i, t in enumerate(vocabulary)}
    asked = [
        (item.key, np.array([number[t.term] for t in item.terms]), np.array([t.times * t.weight for t in item.terms], np.int64))
        for item in items
    ]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values = pa.array(vocabulary, pa.string())
        found = [Best(k) for _ in asked]
        for batch in batches:
            for i in range(len(batch)):
                doc_id, n, term, df, at, tf = (batch.column(c.split()[0])[i].values for c in SEGMENT.split(", "))
                known = doc_id.is_valid().to_numpy(zero_copy_only=False)
                ids, n, df, at, tf = (pc.fill_null(c, 0).to_numpy() for c in (doc_id, n, df, at, tf))
                m = 75 + (25 * n * total) // length
                begins = np.concatenate(([0], np.cumsum(df)))
                place = pc.fill_null(pc.index_in(values, value_set=term), -1).to_numpy()
                for best, (_, numbers, weights) in zip(found, asked):
                    rows = place[numbers]
                    rows, weights = rows[rows >= 0], weights[rows >= 0]
                    if not len(rows):
                        continue
                    spots = ranges(begins[rows], df[rows])
                    counts = np.zeros((len(rows), len(ids)), np.int64)
                    counts[np.repeat(np.arange(len(rows)), df[rows]), at[spots]] = tf[spots]
                    search_segment(best, ids, known, m, counts, weights)
        for (key, _, _), best in zip(asked, found):
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(best.ids), key)), pa.array(best.ids, mask=~best.known), pa.array(best.scores),
                ],
                names=["key", "doc_id", "score"],
            )
    return run


def _blocks(items: DataFrame) -> Iterator[list[Row]]:
    """Items in blocks of bounded size; one partition of them passes at a time."""
    block, size = [], 0
    for item in items.toLocalIterator():
        if block and (len(block) == BLOCK_ITEMS or size + len(item.terms) > BLOCK_TERMS):
            yield block
            block, size = [], 0
        block.append(item)
        size += len(item.terms)
    if block:
        yield block


def ranked_search(docs: DataFrame, items: DataFrame, k: int = K) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` best of ``docs(doc_id, text)`` per row of ``items(item_id, text)``."""
    keyed = write_once(items.select(F.monotonically_increasing_id().alias("key"), "item_id", "text"), "lexical-items")
    listed = write_once(keyed.select("key", "text").mapInArrow(_item_terms, "key long, term string, place long"), "lexical-terms")
    table = bit_table(listed.select("place").distinct())
    index = write_once(docs.select("doc_id", "text").mapInArrow(_segments(table), SEGMENT), "lexical-segments")
    sizes = index.select(F.explode("n").alias("n")).agg(F.count_if(F.col("n") > 0).alias("docs"), F.sum("n").alias("terms"))
    total, length = sizes.first()
    if not total:
        return items.select("item_id", F.lit(1).alias("rank"), F.lit(0).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("score")).limit(0)
    held = (
        index.select(F.explode(F.arrays_zip("term", "df")).alias("t"))
        .groupBy(F.col("t.term").alias("term"))
        .agg(F.sum("t.df").alias("df"))
    )
    weight = F.floor(1000 * F.log((2 * F.lit(total).cast("long") + 2) / (2 * F.col("df") + 1)))
    weighted = (
        listed.groupBy("key", "term").agg(F.count(F.lit(1)).alias("times"))
        .join(held, "term")
        .groupBy("key")
        .agg(F.collect_list(F.struct("term", "times", weight.cast("long").alias("weight"))).alias("terms"))
    )
    found = None
    for block in _blocks(weighted):
        part = index.mapInArrow(_search(block, total, length, k), "key long, doc_id long, score long")
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = index.select(*[F.lit(0).cast("long").alias(c) for c in ("key", "doc_id", "score")]).limit(0)
    ranked = top_rows(found, ["key"], [F.col("score").desc(), F.col("doc_id").asc_nulls_last()], k, "rank")
    return ranked.join(keyed.select("key", "item_id"), "key").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
