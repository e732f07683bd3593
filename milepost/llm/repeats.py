"""Substring deduplication over words by seed and extend.

Seeds are winnowed anchors of ``SEED`` words that occur more than once. A seed is extended
both ways: every window of ``length`` words around it is compared, as a 96-bit hash of its
words, with the windows around all other occurrences. Of each window content only the first
place by (doc_id, start) is kept as such; the other windows repeat it. Overlapping repeated
windows join to maximal repeats, which are the spans removed. Hot seeds are no issue: places
are combined map-side to the least one per content.

Defined results: words are ``[^\\x20\\x09-\\x0D]+``, unchanged; a null text has none. Windows
are judged on the input. Rows without doc_id keep everything and are nobody's earlier copy.
Rows that repeat a doc_id with the same text are one document: none is earlier than the
other. ``doc_id`` has to tell different texts apart, else some repeats in them may stay.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from milepost.llm.anchors import Run, Shape, anchor_counts, first_segments, listed_windows, singles, without_repeats
from milepost.llm.arrays import U64, ranges, text_runs, window_hashes

LENGTH, SEED = 20, 4


def _extend(shape: Shape):
    """The listed windows with two independent hashes of their words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            for first, last, data, offsets in text_runs(batch.column("text")):
                units = Run(shape, data, offsets)
                windows = ranges(*listed_windows(units, batch, first, last))
                if not len(windows):
                    continue
                text, at = units.local(windows)
                other = window_hashes(units.other_values(), shape.length, 1)[windows] >> U64(32)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(window_hashes(units.values, shape.length)[windows].view(np.int64)),
                        pa.array(other.astype(np.uint32).view(np.int32)),
                        pa.array(ids[first:last][text].astype(np.int64)),
                        pa.array(at.astype(np.int32)),
                    ],
                    names=["one", "two", "doc_id", "at"],
                )
    return run


def repeated_passages(docs: DataFrame, length: int = LENGTH, seed: int = SEED) -> DataFrame:
    """Maximal repeats of at least ``length`` words per document of ``docs(doc_id, text)``.

    Returns ``doc_id, size`` (words), ``removed`` (words), ``spans`` (first word and number
    of words of each removed stretch) and ``kept_sha256`` (of the kept words, joined by one
    space).
    """
    shape, docs = Shape("word", length, seed), docs.select("doc_id", "text")
    single = singles(docs, anchor_counts(docs, shape).where("once").select("doc_id", "at"), "repeats-words")
    windows = first_segments(docs, single, shape).mapInArrow(_extend(shape), "one long, two int, doc_id long, at int")
    firsts = (
        windows.groupBy("one", "two")
        .agg(F.min(F.struct("doc_id", "at")).alias("place"))
        .groupBy(F.col("place.doc_id").alias("doc_id"))
        .agg(F.collect_list("place.at").alias("at"), F.collect_list(F.lit(1)).alias("n"))
    )
    return without_repeats(docs, single, firsts, shape)
