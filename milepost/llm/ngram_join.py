"""Self-join of documents on the Jaccard similarity of their word n-gram sets.

Words are ``[^\\x20\\x09-\\x0D]+``, unchanged. Rows with the same word sequence collapse to one
text first. MinHash signatures are cut into bands; numbers of bands and rows follow from the
threshold and the wanted recall. Texts are shuffled on band hashes; buckets with several
texts are verified on full n-gram sets, held as 64-bit hashes.

A bucket with the same texts as one of a lower band is dropped. A large bucket is dealt to
blocks, and each pair of blocks is a unit of bounded size. A pair that meets in several
buckets counts in that of its lowest band. Units return links per text and the edges of a
spanning forest, never pairs; connected components over these edges give the classes.

Defined results: ``class_id`` is the least doc_id of the class and ``n_links`` the number of
other rows linked to a row, copies included. A null, empty or blank text has no n-grams,
links to nothing and is its own class. A text of fewer than ``n`` words is one n-gram. Rows
without doc_id count as copies; a text held by such rows alone links to its copies only and
has no class. Rows that repeat a doc_id are texts of their own.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from milepost.llm.arrays import U64, inside_texts, mix, range_hashes, span_hashes, text_runs, window_hashes, words
from milepost.llm.components import components
from milepost.operators.windows import write_once

N, THRESHOLD, RECALL = 5, 0.8, 0.999
MOST_HASHES = 64
BLOCK_TEXTS, BLOCK_NGRAMS = 256, 400_000
COLUMNS = 4096


def band_counts(threshold: float = THRESHOLD, recall: float = RECALL, most: int = MOST_HASHES) -> tuple[int, int]:
    """Bands and rows: the most rows per band that reach the recall at the threshold."""
    best = (math.ceil(math.log(1 - recall) / math.log(1 - threshold)), 1)
    for rows in range(2, most + 1):
        bands = math.ceil(math.log(1 - recall) / math.log(1 - threshold**rows))
        if bands * rows <= most:
            best = (bands, rows)
    return best


def ngrams(data: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """N-gram hashes of all texts, the first n-gram of each text, and 16-byte content keys."""
    starts, ends, bounds = words(data, offsets)
    hashes = span_hashes(data, starts, ends)
    lengths = np.diff(bounds)
    counts = np.where(lengths == 0, 0, np.maximum(lengths - n + 1, 1))
    firsts = np.concatenate(([0], np.cumsum(counts)))
    grams = np.zeros(firsts[-1], U64)
    long = np.repeat(lengths >= n, counts)
    grams[long] = window_hashes(hashes, n)[inside_texts(bounds, n, len(hashes))[: max(len(hashes) - n + 1, 0)]]
    short = np.flatnonzero((lengths > 0) & (lengths < n))
    grams[firsts[:-1][short]] = range_hashes(hashes, bounds[:-1][short], bounds[1:][short])
    content = hashes.view(np.uint8)  # a text may have any number of words: digests, no sums
    keys = np.stack([span_hashes(content, 8 * bounds[:-1], 8 * bounds[1:], which) for which in (0, 1)], axis=1)
    return grams, firsts, keys


def _band_hashes(grams: np.ndarray, firsts: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """Hash of each band of the MinHash signature, for texts with n-grams."""
    seeds = mix(np.arange(1, bands * rows + 1, dtype=U64)) | U64(1)
    out = np.zeros((len(firsts), bands), U64)
    for band in range(bands):
        value = np.full(len(firsts), band + 1, U64)
        for row in range(rows):
            value = mix(value + np.minimum.reduceat(grams * seeds[band * rows + row], firsts))
        out[:, band] = value
    return out


def _sketch(n: int, bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, data, offsets in text_runs(batch.column("text")):
                grams, firsts, keys = ngrams(data, offsets, n)
                counts = np.diff(firsts)
                full = np.flatnonzero(counts)
                bits = _band_hashes(grams, firsts[:-1][full], bands, rows) if len(full) else np.zeros((0, bands), U64)
                place = np.zeros(last - first, np.int64)
                place[full] = np.arange(len(full))
                ends = np.cumsum(np.concatenate(([0], np.where(counts > 0, bands, 0)))).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(first, last - first),
                        pa.array([k.tobytes() if c else None for k, c in zip(keys, counts)], pa.binary()),
                        pa.array(counts),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(bits.ravel().view(np.int64))),
                    ],
                    names=["doc_id", "key", "grams", "bands"],
                )
    return run


def _sets(n: int):
    """Sorted distinct n-gram hashes of texts whose content key is the wanted one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, data, offsets in text_runs(batch.column("text")):
                grams, firsts, keys = ngrams(data, offsets, n)
                wanted = batch.column("key").slice(first, last - first).to_pylist()
                good = [i for i, k in enumerate(wanted) if keys[i].tobytes() == k]
                sets = [np.unique(grams[firsts[i] : firsts[i + 1]]).tobytes() for i in good]
                yield pa.RecordBatch.from_arrays([pa.array([wanted[i] for i in good], pa.binary()), pa.array(sets, pa.binary())], names=["key", "set"])
    return run


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections, by products of indicator matrices."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    values = np.concatenate(sets)
    order = np.argsort(values, kind="stable")
    owner, values = owner[order], values[order]
    fresh = np.concatenate(([True], values[1:] != values[:-1]))
    shared = ~fresh | ~np.concatenate((fresh[1:], [True]))
    owner, column = owner[shared], np.cumsum(fresh[shared]) - 1
    out = np.zeros((len(sets), len(sets)), np.float64)
    width = min(COLUMNS, int(column[-1]) + 1) if len(column) else 0
    for low in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
        a, b = np.searchsorted(column, (low, low + COLUMNS))
        held = np.zeros((len(sets), width), np.float32)
        held[owner[a:b], column[a:b] - low] = 1
        out += held @ held.T
    return out


def _verify(threshold: float):
    """Links of the texts of one unit: a bucket, or two blocks of one."""

    def run(group: pa.Table) -> pa.Table:
        keys = group.column("key").to_pylist()
        once = list(dict(zip(keys, range(len(keys)))).values())
        keys = [keys[i] for i in once]
        group = group.take(once)
        sets = [np.frombuffer(s, U64) for s in group.column("set").to_pylist()]
        bands = np.array(group.column("bands").to_pylist(), np.int64)
        band, block = group.column("band")[0].as_py(), group.column("block").to_numpy()
        low, high = group.column("low")[0].as_py(), group.column("high")[0].as_py()
        sizes = np.array([len(s) for s in sets], np.float64)
        common = overlaps(sets)
        linked = common >= threshold * (sizes[:, None] + sizes[None, :] - common) - 1e-9
        np.fill_diagonal(linked, False)
        if low != high:
            linked &= block[:, None] != block[None, :]
        for lower in range(band):
            linked &= bands[:, lower][:, None] != bands[:, lower][None, :]
        copies = group.column("copies").to_numpy()
        links = linked @ copies
        label = np.arange(len(keys))
        while True:
            least = np.minimum(label, np.where(linked, label[None, :], len(keys)).min(1))
            least = least[least]
            if (least == label).all():
                break
            label = least
        has = np.flatnonzero(links)
        return pa.table({
            "key": pa.array([keys[i] for i in has], pa.binary()),
            "root": pa.array([keys[label[i]] for i in has], pa.binary()),
            "links": pa.array(links[has].astype(np.int64)),
        })
    return run


def similar_classes(docs: DataFrame, n: int = N, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """``doc_id, class_id, n_links`` for every row of ``docs(doc_id, text)``."""
    bands, rows = band_counts(threshold, recall)
    docs = docs.select("doc_id", "text")
    rows_ = write_once(docs.mapInArrow(_sketch(n, bands, rows), "doc_id long, key binary, grams long, bands array<long>"), "ngram-sketches")
    texts = write_once(
        rows_.where(F.col("key").isNotNull())
        .groupBy("key")
        .agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.max("grams").alias("grams"), F.min("bands").alias("bands")),
        "ngram-texts",
    )
    banded = texts.where(F.col("rep").isNotNull()).select("key", "rep", "copies", "grams", "bands", F.posexplode("bands").alias("band", "bucket"))
    name = F.xxhash64("key")
    buckets = (
        banded.groupBy("bucket", "band")
        .agg(F.count(F.lit(1)).alias("members"), F.sum("grams").alias("weight"), F.bit_xor(name).alias("names"), F.min("key").alias("least"), F.max("key").alias("most"))
        .where(F.col("members") > 1)
        .groupBy("members", "names", "least", "most")
        .agg(F.min(F.struct("band", "bucket")).alias("own"), F.max("weight").alias("weight"))
        .select("own.bucket", "own.band", F.ceil(F.greatest(F.col("members") / BLOCK_TEXTS, F.col("weight") / BLOCK_NGRAMS)).alias("blocks"))
    )
    members = write_once(banded.join(buckets, ["bucket", "band"]), "ngram-members")
    wanted = members.select(F.col("rep").alias("doc_id"), "key").distinct()
    sets = docs.join(wanted, "doc_id").select("key", "text").mapInArrow(_sets(n), "key binary, set binary")
    block = F.pmod(F.xxhash64("key", F.lit(7)), F.col("blocks"))
    units = (
        members.select("bucket", "band", "key", "copies", "bands", block.alias("block"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other"))
        .withColumn("low", F.least("block", "other"))
        .withColumn("high", F.greatest("block", "other"))
        .drop("other")
    )
    verified = write_once(
        units.join(sets, "key").groupBy("bucket", "band", "low", "high").applyInArrow(_verify(threshold), "key binary, root binary, links long"),
        "ngram-links",
    )
    labels = components(verified.select(F.col("key").alias("a"), F.col("root").alias("b")))
    links = verified.groupBy("key").agg(F.sum("links").alias("links"))
    known = texts.select("key", "rep", "copies").join(labels, F.col("key") == F.col("node"), "left").drop("node").join(links, "key", "left")
    known = known.withColumn("label", F.coalesce("label", "key"))
    least = known.groupBy("label").agg(F.min("rep").alias("class_id"))
    classes = known.join(least, "label").select("key", "class_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"))
    return rows_.select("doc_id", "key").join(classes, "key", "left").select(
        "doc_id",
        F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
    )


def keep_one_of_each(docs: DataFrame, n: int = N, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """The rows of ``docs`` that stand for their class, and those without doc_id.

    Of rows that repeat the standing doc_id with the same text one stays. Different texts
    under that doc_id all stay, also one that is a near copy of another class.
    """
    classes = similar_classes(docs, n, threshold, recall)
    standing = classes.where(F.col("doc_id") == F.col("class_id")).select("doc_id").distinct()
    kept = docs.join(standing, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    return kept.unionByName(docs.where(F.col("doc_id").isNull()))
