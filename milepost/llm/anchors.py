"""Stretches of a text that may repeat, found by winnowed anchors.

A text is a sequence of units: words or bytes. An anchor is a run of ``k`` units whose hash
is the least among ``width`` neighbouring runs, so every window of ``k + width - 1`` units
selects an anchor inside it, and equal windows select equal ones. A window can only repeat
if its anchor occurs more than once. Occurrences are gathered over all documents by hash,
combined map-side, so that a passage in most documents is no hot key. Anchors met in one
text and place only go back to their document, whose other windows are the candidates.

Whole copies of a text are told by a digest first. All their windows start earlier in the
copy with the least doc_id, so they are finished at once, and their anchors do not count as
repeats: an anchor that only copies of one text share, at one place, counts as met once.

Candidate windows fall into segments: neighbours with the same anchor. Segments are compared
by a hash of their content first, and only the first of each content goes on: the others
start later as a whole. The texts are shuffled once, by doc_id; all steps of a query read
that one exchange.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from milepost.llm.arrays import BYTE_KEYS, U64, inside_texts, range_hashes, ranges, sliding, span_hashes, text_runs, window_hashes, winnowed, words
from milepost.llm.tables import later_copies
from milepost.operators.windows import write_once

LAST = U64(2**64 - 1)
COPY = -1
# bytes of text at a time; hashes take eight times as much and are passed over many times, so they should stay in the cache
RUN = 1 << 18


@dataclass(frozen=True)
class Shape:
    """What repeats: ``length`` units of a kind (word or byte), with anchors of ``k``."""

    kind: str
    length: int
    k: int

    @property
    def width(self) -> int:
        return self.length - self.k + 1


class Run:
    """Units of the texts of one run of bytes."""

    def __init__(self, shape: Shape, data: np.ndarray, offsets: np.ndarray):
        self.shape, self.data, self.offsets = shape, data, offsets
        if shape.kind == "word":
            self.starts, self.ends, self.bounds = words(data, offsets)
            self.values = span_hashes(data, self.starts, self.ends)
        else:
            self.bounds, self.values = offsets, BYTE_KEYS[0][data]

    def other_values(self) -> np.ndarray:
        """The units by an independent hash."""
        return span_hashes(self.data, self.starts, self.ends, 1) if self.shape.kind == "word" else BYTE_KEYS[1][self.data]

    def anchors(self) -> np.ndarray:
        """Hash of the ``k`` units at each unit, with its last bit free; the greatest value where a text ends."""
        hashes = window_hashes(self.values, self.shape.k) & ~U64(1)
        hashes[~inside_texts(self.bounds, self.shape.k, len(self.values))[: len(hashes)]] = LAST
        return hashes

    def local(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Text of each unit and its place in that text."""
        text = np.searchsorted(self.bounds, places, "right") - 1
        return text, places - self.bounds[text]

    def digests(self, kept: np.ndarray) -> list[str]:
        """SHA-256 of what is kept of each text; words are joined by one space."""
        if self.shape.kind == "byte":
            out, ends = self.data[kept], np.concatenate(([0], np.cumsum(kept)))[self.bounds]
        else:
            starts, sizes = self.starts[kept], (self.ends - self.starts)[kept]
            ends = np.concatenate(([0], np.cumsum(sizes + 1)))
            out = np.full(ends[-1], 0x20, np.uint8)
            out[ranges(ends[:-1], sizes)] = self.data[ranges(starts, sizes)]
            ends = ends[np.concatenate(([0], np.cumsum(kept)))[self.bounds]]
        view = memoryview(np.ascontiguousarray(out))
        cut = 1 if self.shape.kind == "word" else 0
        return [hashlib.sha256(view[a : max(a, b - cut)]).hexdigest() for a, b in zip(ends[:-1], ends[1:])]


def lists(column: pa.Array, first: int, last: int) -> tuple[np.ndarray, np.ndarray]:
    """Values and lengths of the lists of some rows; null is an empty list."""
    part = column.slice(first, last - first)
    lengths = pc.fill_null(pc.list_value_length(part), 0).to_numpy(zero_copy_only=False)
    return part.flatten().to_numpy(zero_copy_only=False), lengths.astype(np.int64)


def stretches(places: np.ndarray, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the consecutive runs in ``places``; a run also starts at ``breaks``."""
    if not len(places):
        return places, places
    cut = np.flatnonzero(np.concatenate(([True], (np.diff(places) != 1) | breaks[1:])))
    return places[cut], np.diff(np.concatenate((cut, [len(places)])))


def _emit(shape: Shape):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, marks = batch.column("doc_id").to_numpy(), batch.column("mark").to_numpy()
            for first, last, data, offsets in text_runs(batch.column("text"), RUN):
                units = Run(shape, data, offsets)
                hashes = units.anchors()
                places = np.flatnonzero(winnowed(hashes, shape.width) & (hashes != LAST))
                text, at = units.local(places)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(hashes[places].view(np.int64)), pa.array(ids[first:last][text]), pa.array(marks[first:last][text]), pa.array(at.astype(np.int32))],
                    names=["hash", "doc_id", "mark", "at"],
                )
    return run


def anchor_counts(docs: DataFrame, shape: Shape) -> DataFrame:
    """``hash, n, doc_id, at, once``: each anchor's occurrences, and the place of those met once."""
    known = docs.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull()).select("doc_id", "text", F.xxhash64("text").alias("mark"))
    found = known.mapInArrow(_emit(shape), "hash long, doc_id long, mark long, at int").groupBy("hash")
    ends = [f(c).alias(f"{name}_{c}") for c in ("mark", "at") for name, f in (("min", F.min), ("max", F.max))]
    once = (F.col("min_mark") == F.col("max_mark")) & (F.col("min_at") == F.col("max_at"))
    counts = found.agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("doc_id"), *ends)
    return counts.select("hash", "n", "doc_id", F.col("min_at").alias("at"), once.alias("once"))


def singles(docs: DataFrame, once: DataFrame, purpose: str) -> DataFrame:
    """``doc_id, single``: places of anchors met once per document; ``COPY`` marks whole copies."""
    marked = once.union(later_copies(docs).select("doc_id", F.lit(COPY).alias("at")))
    return write_once(marked.groupBy("doc_id").agg(F.collect_list("at").alias("single")), purpose)


def candidates(units: Run, column: pa.Array, known: np.ndarray, first: int, last: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows that may repeat, the anchor of every window start, and which texts are copies."""
    shape = units.shape
    hashes = units.anchors()
    at, counts = lists(column, first, last)
    owner = np.repeat(np.arange(last - first), counts)
    copy = np.zeros(last - first, bool)
    copy[owner[at == COPY]] = True
    owner, at = owner[at != COPY], at[at != COPY]
    hashes[units.bounds[owner] + at] |= U64(1)
    least = sliding(hashes, shape.width) if len(hashes) >= shape.width else hashes
    may = inside_texts(units.bounds, shape.length, len(units.values))[: len(least)]
    may &= (least & U64(1)) == 0
    out = np.flatnonzero(~known[first:last] | copy)
    for a, b in zip(units.bounds[out].tolist(), units.bounds[out + 1].tolist()):
        may[a:b] = False
    return np.flatnonzero(may), least, copy


def segments(units: Run, windows: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First window and number of windows of each run with one key in one text."""
    text, _ = units.local(windows)
    breaks = np.concatenate(([True], (np.diff(text) != 0) | (keys[1:] != keys[:-1])))[: len(windows)]
    return stretches(windows, breaks)


def _contents(shape: Shape):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known = batch.column("doc_id").is_valid().to_numpy(zero_copy_only=False)
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            for first, last, data, offsets in text_runs(batch.column("text"), RUN):
                units = Run(shape, data, offsets)
                windows, least, _ = candidates(units, batch.column("single"), known, first, last)
                starts, sizes = segments(units, windows, least[windows])
                if not len(starts):
                    continue
                ends = starts + sizes + shape.length - 1
                text, at = units.local(starts)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(range_hashes(units.values, starts, ends).view(np.int64)),
                        pa.array(range_hashes(units.other_values(), starts, ends, 1).view(np.int64)),
                        pa.array(ids[first:last][text].astype(np.int64)),
                        pa.array(at.astype(np.int32)),
                        pa.array(sizes.astype(np.int32)),
                    ],
                    names=["one", "two", "doc_id", "at", "n"],
                )
    return run


def first_segments(docs: DataFrame, single: DataFrame, shape: Shape) -> DataFrame:
    """``doc_id, text, at, n``: each text with its segments that are the first of their content."""
    rows = docs.join(single, "doc_id", "left").select("doc_id", "text", "single")
    found = rows.mapInArrow(_contents(shape), "one long, two long, doc_id long, at int, n int")
    firsts = (
        found.groupBy("one", "two")
        .agg(F.min(F.struct("doc_id", "at", "n")).alias("place"))
        .groupBy(F.col("place.doc_id").alias("doc_id"))
        .agg(F.collect_list("place.at").alias("at"), F.collect_list("place.n").alias("n"))
    )
    return docs.join(firsts, "doc_id", "left").select("doc_id", "text", "at", "n")


def listed_windows(units: Run, batch: pa.RecordBatch, first: int, last: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and sizes of the runs of windows listed in columns ``at`` and ``n``, in order."""
    at, counts = lists(batch.column("at"), first, last)
    sizes, _ = lists(batch.column("n"), first, last)
    starts = np.repeat(units.bounds[:-1], counts) + at
    order = np.argsort(starts, kind="stable")
    return starts[order].astype(np.int64), sizes[order].astype(np.int64)


def _finish(shape: Shape):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known = batch.column("doc_id").is_valid().to_numpy(zero_copy_only=False)
            for first, last, data, offsets in text_runs(batch.column("text"), RUN):
                units = Run(shape, data, offsets)
                windows, _, copy = candidates(units, batch.column("single"), known, first, last)
                repeats = np.zeros(len(units.values) + 1, bool)
                repeats[windows] = True
                repeats[ranges(*listed_windows(units, batch, first, last))] = False
                places = np.flatnonzero(repeats)
                edge = np.zeros(len(units.values) + 1, np.int8)
                edge[places] = 1
                edge[places + shape.length] -= 1
                size = np.diff(units.bounds)
                gone = (np.cumsum(edge, dtype=np.int32)[:-1] > 0) | np.repeat(copy & (size >= shape.length), size)
                lost = np.flatnonzero(gone)
                starts, sizes = segments(units, lost, np.zeros(len(lost), U64))
                owner, place = units.local(starts)
                spans = np.bincount(owner, minlength=last - first)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(first, last - first),
                        pa.array(size),
                        pa.array(np.bincount(units.local(lost)[0], minlength=last - first)),
                        pa.ListArray.from_arrays(
                            pa.array(np.concatenate(([0], np.cumsum(spans))).astype(np.int32)),
                            pa.StructArray.from_arrays([pa.array(place.astype(np.int32)), pa.array(sizes.astype(np.int32))], ["start", "length"]),
                        ),
                        pa.array(units.digests(~gone)),
                    ],
                    names=["doc_id", "size", "removed", "spans", "kept_sha256"],
                )
    return run


def without_repeats(docs: DataFrame, single: DataFrame, firsts: DataFrame, shape: Shape) -> DataFrame:
    """``doc_id, size, removed, spans, kept_sha256`` of every document.

    ``firsts(doc_id, at, n)`` lists the candidate windows that are the first of their
    content: runs of ``n`` windows from ``at`` on. All other candidates repeat an earlier one.
    """
    rows = docs.join(single, "doc_id", "left").join(firsts, "doc_id", "left").select("doc_id", "text", "single", "at", "n")
    return rows.mapInArrow(_finish(shape), "doc_id long, size long, removed long, spans array<struct<start:int,length:int>>, kept_sha256 string")
