"""Suffix-array deduplication over bytes.

Equal windows of ``length`` bytes have the same anchor, so windows are dealt by anchor to
independent suffix arrays. What is dealt are segments: runs of candidate windows with one
anchor, each once per distinct content and task, with its least place. A task sorts all
suffixes of its segments by prefix doubling up to ``length`` bytes; suffixes that agree on
these are ordered by place. The longest previous factor of a suffix is the longer one of what
it shares with the nearest entry before it and the nearest one after it, in suffix order,
whose places are smaller. A window whose factor has ``length`` bytes is a later copy and goes;
the others are the first of their content and stay.

Anchors with very many occurrences are dealt window by window, by a hash of the whole
window, so no suffix array gets a group that grows with the corpus. Their list is broadcast;
the limit is doubled until at most ``MOST_HOT`` anchors exceed it.

Defined results: a text is its UTF-8 bytes, null is empty; matches never span documents and
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

from milepost.llm.anchors import RUN, Run, Shape, anchor_counts, first_segments, listed_windows, singles, stretches, without_repeats
from milepost.llm.arrays import BYTE_KEYS, U64, large_binary, ranges, sliding, text_runs, window_hashes
from milepost.operators.windows import write_once

LENGTH, SEED = 100, 16
HOT, MOST_HOT = 16_384, 1 << 20
CHUNK_BYTES = 1 << 18


def _least_places(table: pa.Table) -> pa.Table:
    """One row per distinct content, with its least (doc_id, at)."""
    codes = table.column("content").combine_chunks().dictionary_encode().indices.to_numpy()
    doc, at = table.column("doc_id").to_numpy(), table.column("at").to_numpy()
    order = np.lexsort((at, doc, codes))
    return table.take(order[np.concatenate(([True], np.diff(codes[order]) != 0))]) if len(order) else table


def _segments(shape: Shape, hot: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, parts = batch.column("doc_id").to_numpy(zero_copy_only=False), []
            for first, last, data, offsets in text_runs(batch.column("text"), RUN):
                units = Run(shape, data, offsets)
                starts, sizes = listed_windows(units, batch, first, last)
                if not len(starts):
                    continue
                # the anchor of a segment is that of its first window
                heads = BYTE_KEYS[0][data[ranges(starts, np.full(len(starts), shape.length))]]
                keys = sliding(window_hashes(heads, shape.k) & ~U64(1), shape.width)[:: shape.length]
                lengths = sizes + shape.length - 1
                single = np.isin(keys, hot)
                if single.any():
                    windows = ranges(starts[single], sizes[single])
                    keys = np.concatenate((keys[~single], window_hashes(units.values, shape.length)[windows]))
                    starts = np.concatenate((starts[~single], windows))
                    lengths = np.concatenate((lengths[~single], np.full(len(windows), shape.length)))
                text, at = units.local(starts)
                parts.append(pa.table({
                    "key": pa.array(keys.view(np.int64)),
                    "content": large_binary(data[ranges(starts, lengths)], np.concatenate(([0], np.cumsum(lengths)))),
                    "doc_id": pa.array(ids[first:last][text].astype(np.int64)),
                    "at": pa.array(at.astype(np.int32)),
                }))
            if parts:
                yield from _least_places(pa.concat_tables(parts)).to_batches()
    return run


def _refined(rank: np.ndarray, among: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Tell the suffixes ``among`` apart by ``keys``, which begin with the ranks they share.

    A rank is the number of lesser suffixes, so a group that splits leaves all others alone.
    Changes ``rank``; returns the suffixes that still share one, by rank.
    """
    order = np.argsort(keys)
    among, keys = among[order], keys[order]
    old = rank[among]
    new, other = np.ones(len(keys), bool), np.ones(len(keys), bool)
    new[1:], other[1:] = old[1:] != old[:-1], keys[1:] != keys[:-1]
    part = np.flatnonzero(other)
    sizes = np.diff(np.append(part, len(keys)))
    start = np.flatnonzero(new)[np.cumsum(new[part]) - 1]
    rank[among] = np.repeat(old[part] + (part - start), sizes)
    return among[np.repeat(sizes > 1, sizes)]


def suffix_ranks(data: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """Rank of the ``length`` bytes at each start among all starts, by prefix doubling.

    Suffixes that are told apart already take no part in later rounds.
    """
    size = len(data)
    padded = np.concatenate((data, np.zeros(8, np.uint8)))
    words = np.lib.stride_tricks.sliding_window_view(padded, 8)[:size]
    have = min(8, length)
    first = np.ascontiguousarray(words).view(">u8").ravel().astype(U64) >> U64(64 - 8 * have)
    rank, bits = np.zeros(size, np.int64), 21 if size < 1 << 21 else 32
    among = _refined(rank, np.arange(size), first)
    while have < length and len(among):
        step = min(have, length - have)
        keys, have = rank[among] << bits | rank[np.minimum(among + step, size - 1)], have + step
        if bits == 21 and have < length:  # the key has room for the next bytes, too
            more = min(have - step, length - have)
            keys, have = keys << bits | rank[np.minimum(among + step + more, size - 1)], have + more
        among = _refined(rank, among, keys)
    return rank[starts]


def shared_bytes(data: np.ndarray, one: np.ndarray, two: np.ndarray, length: int) -> np.ndarray:
    """Bytes, up to ``length``, that the windows at ``one`` and ``two`` share from their start on."""
    windows = np.lib.stride_tricks.sliding_window_view(data, length)
    out = np.empty(len(one), np.int64)
    for i in range(0, len(one), 8_192):
        differ = windows[one[i : i + 8_192]] != windows[two[i : i + 8_192]]
        out[i : i + 8_192] = np.where(differ.any(1), differ.argmax(1), length)
    return out


def _shared_with_smaller(places: np.ndarray, common: np.ndarray) -> np.ndarray:
    """What each entry shares with the nearest one before it that has a smaller place; 0 without one.

    ``common[i]`` is what entries ``i - 1`` and ``i`` share, 0 for the first. All entries step
    back over the greater places before them, by blocks that double until one holds a smaller
    place and then halve. Level ``k`` has the least of each ``2**k`` neighbours.
    """
    least, shared, start, out = [places], [common], np.arange(len(places)), common.copy()
    met, live, tries = [], start.copy(), 0

    def stepped(live: np.ndarray, level: int) -> np.ndarray:
        """Which entries have no smaller place in the block before them; these step over it."""
        at = start[live] - (1 << level)
        over = (at >= 0) & (least[level][np.minimum(np.maximum(at, 0), len(least[level]) - 1)] >= places[live])
        moved, at = live[over], at[over]
        start[moved], out[moved] = at, np.minimum(out[moved], shared[level][at])
        return over

    while len(live):
        over = stepped(live, tries)
        met.append(live[~over])
        live, tries, half = live[over], tries + 1, 1 << tries
        if len(live):
            if len(least[-1]) <= half:  # no block of the next size; smaller ones may still fit
                met.append(live)
                break
            least.append(np.minimum(least[-1][:-half], least[-1][half:]))
            shared.append(np.minimum(shared[-1][:-half], shared[-1][half:]))
    back = np.zeros(0, np.int64)
    for level in range(len(met) - 2, -1, -1):
        back = np.concatenate((back, met[level + 1]))
        stepped(back, level)
    return out


def previous_factors(data: np.ndarray, starts: np.ndarray, places: np.ndarray, length: int) -> np.ndarray:
    """Longest previous factor, up to ``length`` bytes, of each window.

    That is the most that a window shares, from its start on, with one of a smaller place
    (0 or more). Windows that agree on ``length`` bytes are looked at once, at their
    least place; those at a later one share ``length`` bytes with it. Equal places are no
    earlier than each other; windows of one place are expected to agree on all bytes.
    """
    if not len(starts):
        return np.zeros(0, np.int64)
    rank = suffix_ranks(data, starts, length)
    order = np.argsort(rank << 32 | places)
    heads = np.flatnonzero(np.concatenate(([True], np.diff(rank[order]) != 0)))
    one = order[heads]
    common = np.concatenate(([0], shared_bytes(data, starts[one[:-1]], starts[one[1:]], length)))
    previous = _shared_with_smaller(places[one], common)
    following = _shared_with_smaller(places[one][::-1], np.concatenate(([0], common[:0:-1])))[::-1]
    of_heads = np.maximum(previous, following)
    group = np.repeat(np.arange(len(heads)), np.diff(np.concatenate((heads, [len(order)]))))
    factors = np.empty(len(starts), np.int64)
    factors[order] = np.where(places[order] > places[one][group], length, of_heads[group])
    return factors


def first_windows(table: pa.Table, length: int) -> pa.Table:
    """Runs of windows of the segments that have no longest previous factor of ``length``."""
    table = _least_places(table)
    content = table.column("content").combine_chunks().cast(pa.large_binary())
    ends = np.frombuffer(content.buffers()[1], np.int64)[content.offset : content.offset + len(content) + 1]
    data = np.frombuffer(content.buffers()[2], np.uint8)[ends[0] : ends[-1]]
    ends = ends - ends[0]
    counts = np.diff(ends) - length + 1
    starts, owner = ranges(ends[:-1], counts), np.repeat(np.arange(len(counts)), counts)
    at = table.column("at").to_numpy()[owner] + starts - ends[owner]
    # rows that repeat a document have equal places; neither is earlier
    docs, doc = np.unique(table.column("doc_id").to_numpy(), return_inverse=True)
    place = doc[owner] << 32 | at
    order = np.argsort(place)
    places = np.zeros(len(starts), np.int64)
    places[order[1:]] = np.cumsum(np.diff(place[order]) != 0)
    first = np.flatnonzero(previous_factors(data, starts, places, length) < length)
    breaks = np.concatenate(([True], np.diff(owner[first]) != 0)) if len(first) else np.zeros(0, bool)
    runs, sizes = stretches(first, breaks)
    return pa.table({"doc_id": docs[doc[owner[runs]]], "at": at[runs].astype(np.int32), "n": sizes.astype(np.int32)})


def _suffix_arrays(length: int):
    """Suffix arrays over consecutive groups, about ``CHUNK_BYTES`` each; a key is never cut."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        size = 0
        for batch in batches:
            held.append(pa.Table.from_batches([batch]))
            size += batch.nbytes
            if size < CHUNK_BYTES:
                continue
            table = pa.concat_tables(held).combine_chunks()
            keys = table.column("key").to_numpy()
            cut = int(np.searchsorted(keys, keys[-1])) if len(keys) else 0
            if cut:
                yield from first_windows(table.slice(0, cut), length).to_batches()
            held = [table.slice(cut)]
            size = held[0].nbytes
        if held and sum(map(len, held)):
            yield from first_windows(pa.concat_tables(held), length).to_batches()
    return run


def repeated_bytes(docs: DataFrame, length: int = LENGTH, seed: int = SEED) -> DataFrame:
    """Stretches of ``docs(doc_id, text)`` covered by ``length`` bytes that start earlier too.

    Returns ``doc_id, size`` (bytes), ``removed`` (bytes), ``spans`` (first byte and number
    of bytes of each removed stretch) and ``kept_sha256`` (of the remaining bytes).
    """
    shape, docs = Shape("byte", length, seed), docs.select("doc_id", "text")
    frequent, met = F.col("n") > HOT, F.col("once")
    kept = write_once(
        anchor_counts(docs, shape)
        .where(met | frequent)
        .select(F.when(met, F.col("doc_id")).alias("doc_id"), F.when(met, F.col("at")).alias("at"), *[F.when(~met, F.col(c)).alias(c) for c in ("hash", "n")]),
        "repeats-anchors",
    )
    hot, limit = kept.where(F.col("hash").isNotNull()), HOT
    while hot.where(F.col("n") > limit).count() > MOST_HOT:
        limit *= 2
    frequent = np.array([r[0] for r in hot.where(F.col("n") > limit).select("hash").collect()], np.int64).view(U64)
    single = singles(docs, kept.where(F.col("hash").isNull()).select("doc_id", "at"), "repeats-bytes")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    firsts = (
        first_segments(docs, single, shape)
        .mapInArrow(_segments(shape, frequent), "key long, content binary, doc_id long, at int")
        .repartition(parts, "key")
        .sortWithinPartitions("key")
        .mapInArrow(_suffix_arrays(length), "doc_id long, at int, n int")
        .groupBy("doc_id")
        .agg(F.collect_list("at").alias("at"), F.collect_list("n").alias("n"))
    )
    return without_repeats(docs, single, firsts, shape)
