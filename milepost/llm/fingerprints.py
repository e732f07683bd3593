"""Fingerprints of documents from the phrases of a Lempel-Ziv parse.

A text is parsed left to right into dictionary phrases: each is the shortest piece that is no
phrase yet, so it continues an earlier phrase by one byte, as in LZ78 over UTF-8 bytes. The
dictionary starts anew after ``PHRASES`` phrases, which bounds the memory of a very long text.
Texts that compress each other well share many phrases. The set of phrases is hashed and reduced to
a signature: hashes fall into ``BINS`` bins and each bin keeps its least one (one-permutation
MinHash). The likeness of two fingerprints is the share of equal bins among the bins that
either has filled; it estimates the Jaccard similarity of the phrase sets.

``edited_fingerprints`` also fingerprints every text after an edit: its last quarter is
replaced by the beginning of the next document. Texts are range partitioned by doc_id once
and read in order, so that a document meets its successor in the same task; the parse of the
edited text resumes at the edit. Only the last document of a partition waits for the first of
the next one, which is joined to it afterwards by the number of the partition.

Defined results: null is an empty text. Empty texts have no phrases and are alike with
likeness 1; an empty and another text have likeness 0. Rows with a null doc_id come last. Rows
that repeat a doc_id are documents of their own, ordered by their text. The last document is
followed by the first; a single document is its own next. Other columns are left out.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from milepost.llm.arrays import span_hashes
from milepost.operators.windows import write_once

BINS = 128
EMPTY = np.uint16(0xFFFF)
RUN_BYTES = 1 << 18
PHRASES = 1 << 16

FOUND = (
    "n_chars long, edited_sha256 string, print binary, edited_print binary, near_edited double, near_next double"
)


def phrase_ends(content: bytes, start: int, nodes: dict[int, int], ends: list[int]) -> None:
    """Parse ``content[start:]`` and append where its phrases end.

    ``nodes`` is the trie of the phrases since the last restart, ``ends`` ends with theirs.
    Each phrase but an unfinished last one adds one node.
    """
    node, get, put = 0, nodes.get, ends.append
    fresh = (len(nodes) + 1) << 8
    for at, byte in enumerate(memoryview(content)[start:], start + 1):
        key = node + byte
        node = get(key)
        if node is None:
            put(at)
            node = 0
            if fresh >> 8 < PHRASES:
                nodes[key] = fresh
                fresh += 256
            else:
                nodes.clear()
                fresh = 256
    if node:
        put(len(content))


def signatures(texts: list[bytes], ends: list[list[int]]) -> np.ndarray:
    """One row of ``BINS`` numbers per text, from the phrases that tile it."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    counts = np.array([len(e) for e in ends], np.int64)
    shift = np.concatenate(([0], np.cumsum([len(t) for t in texts])))[:-1].astype(np.int64)
    stops = np.fromiter((e for one in ends for e in one), np.int64, int(counts.sum())) + np.repeat(shift, counts)
    starts = np.concatenate((np.zeros(1, np.int64), stops))[:-1]  # phrases tile the texts without gaps
    hashes = span_hashes(data, starts, stops)
    owner = np.repeat(np.arange(len(texts)), counts)
    least = np.full((len(texts), BINS), 2**64 - 1, np.uint64)
    np.minimum.at(least, (owner, (hashes >> np.uint64(57)).astype(np.int64)), hashes << np.uint64(7))
    filled = least != np.uint64(2**64 - 1)
    return np.where(filled, np.minimum((least >> np.uint64(40)).astype(np.uint16), EMPTY - 1), EMPTY)


def likeness(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Share of equal bins among those filled, by rows."""
    filled = ((one != EMPTY) | (two != EMPTY)).sum(axis=1)
    same = ((one == two) & (one != EMPTY)).sum(axis=1)
    return np.where(filled == 0, 1.0, same / np.maximum(filled, 1))


class Document:
    """A text with its parse and signature."""

    __slots__ = ("content", "doc_id", "ends", "nodes", "part", "print", "text")

    def __init__(self, doc_id: int | None, text: str | None, part: int = 0):
        self.doc_id, self.text, self.part, self.print = doc_id, text or "", part, None
        self.content, self.nodes, self.ends = self.text.encode(), {}, []
        phrase_ends(self.content, 0, self.nodes, self.ends)


def edited(doc: Document, following: str) -> tuple[bytes, list[int]]:
    """The edited text and its parse, which goes on from the last phrase before the edit.

    The trie of ``doc`` is used up.
    """
    cut = len(doc.text) // 4
    if not cut:
        return doc.content, doc.ends
    kept = doc.text[: len(doc.text) - cut].encode()
    content = kept + following[:cut].encode()
    same = bisect_right(doc.ends, len(kept))
    ends = doc.ends[:same]
    restart, nodes = same - same % PHRASES, doc.nodes
    if len(doc.ends) - len(doc.ends) % PHRASES == restart:
        while len(nodes) > same - restart:
            nodes.popitem()
    else:  # the trie at hand is that of a later stretch
        nodes = {}
        phrase_ends(content[: ends[-1]], ends[restart - 1] if restart else 0, nodes, [])
    phrase_ends(content, ends[-1] if ends else 0, nodes, ends)
    return content, ends


def _results(docs: list[Document], nexts: list[tuple[str, np.ndarray]]) -> list[pa.Array]:
    """The columns ``FOUND`` for documents with text and signature of their next ones."""
    if not docs:
        return [pa.array([], t) for t in (pa.int64(), pa.string(), pa.binary(), pa.binary(), pa.float64(), pa.float64())]
    changed = [edited(d, text) for d, (text, _) in zip(docs, nexts)]
    own = np.stack([d.print for d in docs])
    after = signatures([c for c, _ in changed], [e for _, e in changed])
    return [
        pa.array([len(d.text) for d in docs], pa.int64()),
        pa.array([hashlib.sha256(c).hexdigest() for c, _ in changed]),
        pa.array([p.astype(">u2").tobytes() for p in own], pa.binary()),
        pa.array([p.astype(">u2").tobytes() for p in after], pa.binary()),
        pa.array(likeness(own, after)),
        pa.array(likeness(own, np.stack([p for _, p in nexts]))),
    ]


def _read_print(content: bytes) -> np.ndarray:
    return np.frombuffer(content, ">u2").astype(np.uint16)


ORDERED = f"part int, doc_id long, edge string, text string, {FOUND}"


def _in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Results of the ordered documents of one partition.

    The first document is repeated as an ``edge`` row with its text, and the last one comes as
    such a row in place of its results, as its next document is elsewhere.
    """
    def rows(docs: list[Document], edge: str | None, columns: list[pa.Array]) -> pa.RecordBatch:
        n = len(docs)
        texts = [d.text if edge else None for d in docs]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([d.part for d in docs], pa.int32()), pa.array([d.doc_id for d in docs], pa.int64()),
                pa.array([edge] * n, pa.string()), pa.array(texts, pa.string()), *columns,
            ],
            names=["part", "doc_id", "edge", "text", *[c.split()[0] for c in FOUND.split(", ")]],
        )

    def edge_row(doc: Document, edge: str) -> pa.RecordBatch:
        content = pa.array([doc.print.astype(">u2").tobytes()], pa.binary())
        nothing = [pa.nulls(1, t) for t in (pa.int64(), pa.string(), pa.binary(), pa.binary(), pa.float64(), pa.float64())]
        nothing[2] = content
        return rows([doc], edge, nothing)

    def settle(docs: list[Document]) -> pa.RecordBatch:
        new = [d for d in docs if d.print is None]
        for d, p in zip(new, signatures([d.content for d in new], [d.ends for d in new])):
            d.print = p
        done = docs[:-1]
        return rows(done, None, _results(done, [(d.text, d.print) for d in docs[1:]]))

    waiting: list[Document] = []
    size, begun = 0, False
    for batch in batches:
        for doc_id, text, part in zip(batch.column("doc_id"), batch.column("text"), batch.column("part")):
            waiting.append(Document(doc_id.as_py(), text.as_py(), part.as_py()))
            size += len(waiting[-1].content)
            if size >= RUN_BYTES and len(waiting) > 1:
                yield settle(waiting)
                if not begun:
                    yield edge_row(waiting[0], "first")
                    begun = True
                waiting, size = waiting[-1:], len(waiting[-1].content)
    if waiting:
        yield settle(waiting)
        if not begun:
            yield edge_row(waiting[0], "first")
        yield edge_row(waiting[-1], "last")


def _at_edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Results of the last documents of partitions, each with its next document."""
    for batch in batches:
        for i in range(len(batch)):
            row = batch.slice(i, 1).to_pylist()[0]
            doc = Document(row["doc_id"], row["text"])
            doc.print = signatures([doc.content], [doc.ends])[0]
            columns = _results([doc], [(row["next_text"] or "", _read_print(row["next_print"]))])
            yield pa.RecordBatch.from_arrays(
                [pa.array([doc.doc_id], pa.int64()), *columns], names=["doc_id", *[c.split()[0] for c in FOUND.split(", ")]]
            )


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``.

    A fingerprint is the signature in hexadecimal, four digits per bin.
    """
    order = [F.col("doc_id").asc_nulls_last(), F.col("tie").asc(), F.col("text").asc()]
    ordered = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
        .withColumn("tie", F.xxhash64("text"))
        .repartitionByRange(*order[:2])
        .sortWithinPartitions(*order)
        .select("doc_id", "text", F.spark_partition_id().alias("part"))
    )
    stored = write_once(ordered.mapInArrow(_in_order, ORDERED), "fingerprints")
    # one row per partition: its next non-empty one, the first after the last
    parts = stored.where("edge = 'first'").select("part")
    by_part = W.orderBy("part")
    following = parts.select("part", F.coalesce(F.lead("part").over(by_part), F.min("part").over(W.partitionBy())).alias("next_part"))
    firsts = stored.where("edge = 'first'").select(F.col("part").alias("next_part"), F.col("text").alias("next_text"), F.col("print").alias("next_print"))
    waiting = stored.where("edge = 'last'").select("part", "doc_id", "text").join(following, "part").join(firsts, "next_part")
    last = waiting.select("doc_id", "text", "next_text", "next_print").mapInArrow(_at_edges, f"doc_id long, {FOUND}")
    both = stored.where("edge IS NULL").select(*last.columns).unionByName(last)
    return both.select(
        "doc_id", "n_chars", "edited_sha256",
        F.lower(F.hex("print")).alias("fingerprint"), F.lower(F.hex("edited_print")).alias("edited_fingerprint"),
        "near_edited", "near_next",
    )
