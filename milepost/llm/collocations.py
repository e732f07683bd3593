"""Collocations per language by best-first growth of phrases.

Phrases grow word by word. A phrase of ``least`` occurrences is a candidate; its score is
``1000000 a^2 / (l r)`` at its worst cut into a beginning (``l`` occurrences) and a rest
(``r``). The counts of a prefix bound all that grows from it: with a prefix of ``p``
occurrences that begins with a word of ``f``, a longer phrase has at most ``p`` occurrences
and its rest at least as many as itself, so it scores at most ``1000000 p / f``.

Words are counted first, then pairs of words that each reach ``least``. Pairs form the
frontier, ordered by bound. A round expands, per language, the pairs whose bound reaches a
threshold: the longer phrases they begin are counted, and those that hold a pair whose own
score reaches it, for these may displace that pair. All phrases that score the threshold or
more are then known exactly. When enough of them survive, ties included, the language is
settled; else its threshold falls to twice the rank and the frontier grows. The last threshold
is 0, where everything is expanded. Thresholds start at twice the rank asked for.

Counts are combined per batch before the shuffle, over whole phrases as text. Which
phrases a round counts is told to tasks by a bit table of fixed size; its few hits too many
cost time only, as counts are joined by text afterwards.

Defined results: a null language is ``und``, a null text is empty. Documents that repeat count
again. Equal scores go by ``a``, descending, then phrase in byte order, so ranks are unique.
Other columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from milepost.llm.arrays import U64, mix, ranges, span_hashes, text_runs, words
from milepost.llm.tables import bit_places, bit_table, has_bits
from milepost.operators.windows import top_rows, write_once

K, LEAST = 2_000, 10
DISPLACED_BY = 50
ROWS = 1_000  # texts counted together
UNDETERMINED = "und"

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32
# [.,;:!?\x0A-\x0D] ends a piece; [^\x20\x09]+ within a piece is a word
ENDS_PIECE = np.zeros(256, bool)
ENDS_PIECE[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
WORD_BYTE = ~ENDS_PIECE
WORD_BYTE[[0x20, 0x09]] = False


class Words:
    """Words of the texts of one language, as numbers, with what follows what."""

    def __init__(self, lang: str, column: pa.Array):
        self.lang, names, after, hashes = lang, [], [], []
        for _, _, data, offsets in text_runs(column):
            starts, ends, bounds = words(data, offsets, WORD_BYTE)
            data = LOWER[data]
            piece = np.cumsum(ENDS_PIECE[data])[starts] if len(starts) else starts
            joined = np.zeros(len(starts), bool)
            joined[:-1] = piece[1:] == piece[:-1]
            joined[bounds[1:][bounds[1:] > 0] - 1] = False
            names.append(_strings(data, starts, ends))
            hashes.append(span_hashes(data, starts, ends))
            after.append(joined)
        coded = pa.chunked_array(names, pa.large_string()).combine_chunks().dictionary_encode()
        self.codes = coded.indices.to_numpy().astype(np.int64)
        self.names = coded.dictionary
        self.hashes = np.concatenate(hashes) if hashes else np.zeros(0, U64)
        self.after = np.concatenate(after) if after else np.zeros(0, bool)

    def counted(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return np.unique(codes, return_counts=True)

    def starts(self, size: int) -> np.ndarray:
        """First words of all phrases of ``size`` words."""
        good = self.after.copy()
        for i in range(1, size - 1):
            good[: len(good) - i] &= self.after[i:]
        return np.flatnonzero(good)


def _strings(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    sizes = ends - starts
    offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int64)
    return pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(data[ranges(starts, sizes)]))


def _language_hash(lang: str) -> np.uint64:
    content = np.frombuffer(lang.encode(), np.uint8)
    return span_hashes(content, np.zeros(1, np.int64), np.array([len(content)]), 1)[0]


def _phrase_hashes(lang: str, *parts: np.ndarray) -> np.ndarray:
    """Hash of a phrase in a language from the hashes of its words."""
    out = np.full(len(parts[0]), _language_hash(lang), U64)
    for part in parts:
        out = mix(out * U64(0x9E3779B97F4A7C15) ^ part)
    return out


def _by_language(batch: pa.RecordBatch) -> Iterator[Words]:
    for start in range(0, len(batch), ROWS):
        rows = batch.slice(start, ROWS)
        langs = rows.column("lang").dictionary_encode()
        codes = langs.indices.to_numpy()
        for i, lang in enumerate(langs.dictionary.to_pylist()):
            yield Words(lang, rows.column("text").take(pa.array(np.flatnonzero(codes == i))))


def _counts(lang: str, names: list[pa.Array], n: np.ndarray) -> pa.RecordBatch:
    phrase = names[0] if len(names) == 1 else pc.binary_join_element_wise(*names, pa.scalar(" ", pa.large_string()))
    return pa.RecordBatch.from_arrays(
        [pa.array([lang] * len(n), pa.string()), phrase.cast(pa.string()), pa.array(n, pa.int64())], names=["lang", "phrase", "n"]
    )


def _single_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for w in _by_language(batch):
            codes, n = w.counted(w.codes)
            yield _counts(w.lang, [w.names.take(pa.array(codes))], n)


def _pairs(table: np.ndarray):
    """Pairs of words that are both in the table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for w in _by_language(batch):
                often = has_bits(table, bit_places(_phrase_hashes(w.lang, w.hashes)))
                at = w.starts(2)
                at = at[often[at] & often[at + 1]]
                size = len(w.names)
                codes, n = w.counted(w.codes[at] * size + w.codes[at + 1])
                yield _counts(w.lang, [w.names.take(pa.array(codes // size)), w.names.take(pa.array(codes % size))], n)
    return run


def _triples(prefixes: np.ndarray, contested: np.ndarray):
    """Phrases of three words that begin with a pair of one table or end with one of the other.

    A contested pair may be at either end.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for w in _by_language(batch):
                at = w.starts(3)
                places = bit_places(_phrase_hashes(w.lang, w.hashes[:-1], w.hashes[1:])) if len(w.hashes) else np.zeros(0, np.int64)
                at = at[has_bits(prefixes, places[at]) | has_bits(contested, places[at]) | has_bits(contested, places[at + 1])]
                # pairs get numbers first, so that a phrase is a pair and a word
                size = len(w.names)
                first, pair = np.unique(w.codes[at] * size + w.codes[at + 1], return_inverse=True)
                codes, n = w.counted(pair * size + w.codes[at + 2])
                head, last = first[codes // size] if size else codes, codes % max(size, 1)
                parts = (head // size, head % size, last) if size else (codes, codes, codes)
                yield _counts(w.lang, [w.names.take(pa.array(p)) for p in parts], n)
    return run


def _places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Places of phrases of one or two words in the bit table."""
    for batch in batches:
        langs = batch.column("lang").dictionary_encode()
        codes = langs.indices.to_numpy()
        for i, lang in enumerate(langs.dictionary.to_pylist()):
            phrases = batch.column("phrase").take(pa.array(np.flatnonzero(codes == i)))
            for _, _, data, offsets in text_runs(phrases):
                starts, ends, bounds = words(data, offsets, WORD_BYTE)
                hashes = span_hashes(data, starts, ends)
                first, two = bounds[:-1], np.diff(bounds) == 2
                for part, places in ((~two, (first[~two],)), (two, (first[two], first[two] + 1))):
                    if part.any():
                        yield pa.RecordBatch.from_arrays([pa.array(bit_places(_phrase_hashes(lang, *[hashes[p] for p in places])))], names=["place"])


def _table_of(phrases: DataFrame) -> np.ndarray:
    return bit_table(phrases.select("lang", "phrase").mapInArrow(_places, "place long").distinct())


COUNTS = "lang string, phrase string, n long"


def _summed(found: DataFrame, least: int) -> DataFrame:
    return found.groupBy("lang", "phrase").agg(F.sum("n").alias("a")).where(F.col("a") >= least)


def _part(phrase: Column, first: int, n: int) -> Column:
    return F.array_join(F.slice(F.split(phrase, " "), first, n), " ")


def _with_counts(phrases: DataFrame, counts: DataFrame, part: Column, name: str) -> DataFrame:
    """Add the occurrences of a part of each phrase."""
    known = counts.select("lang", F.col("phrase").alias("_part"), F.col("a").alias(name))
    return phrases.withColumn("_part", part).join(known, ["lang", "_part"]).drop("_part")


def _score(left: str, right: str) -> Column:
    """Exact: products of three counts stay below 38 digits for counts below 10**15."""
    return F.expr(
        f"CAST((CAST(1000000 AS DECIMAL(7,0)) * CAST(a AS DECIMAL(15,0)) * CAST(a AS DECIMAL(15,0)))"
        f" div (CAST({left} AS DECIMAL(15,0)) * CAST({right} AS DECIMAL(15,0))) AS BIGINT)"
    )


def mine_phrases(docs: DataFrame, k: int = K, least: int = LEAST, displaced_by: int = DISPLACED_BY) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the ``k`` best phrases of each language of ``docs(lang, text)``.

    Phrases have two or three words. A pair is displaced by a longer phrase around it that has
    at least ``displaced_by`` percent of its occurrences.
    """
    spark = docs.sparkSession
    texts = docs.select(F.coalesce("lang", F.lit(UNDETERMINED)).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    counted = write_once(
        texts.mapInArrow(_single_words, COUNTS).groupBy("lang", "phrase").agg(F.sum("n").alias("a")), "collocation-words"
    )
    totals = counted.groupBy("lang").agg(F.sum("a").alias("n"))
    single = counted.where(F.col("a") >= least)
    pair_counts = _summed(texts.mapInArrow(_pairs(_table_of(single)), COUNTS), least)
    pairs = _with_counts(pair_counts, single, F.substring_index("phrase", " ", 1), "l")
    pairs = _with_counts(pairs, single, F.substring_index("phrase", " ", -1), "r")
    bound = F.expr("CAST(CAST(a AS DECIMAL(15,0)) * 1000000 div CAST(l AS DECIMAL(15,0)) AS BIGINT)")
    pairs = write_once(pairs.select("lang", "phrase", "a", "l", "r", _score("l", "r").alias("score"), bound.alias("bound")), "collocation-pairs")

    open_langs, results, size = totals.select("lang"), [], 2 * k
    while True:
        # the score at the given rank of each open language; all of it where there are fewer pairs
        ranked = top_rows(pairs.join(open_langs, "lang"), ["lang"], [F.col("score").desc(), F.col("phrase")], size)
        limits = ranked.groupBy("lang").agg(F.when(F.count(F.lit(1)) == size, F.min("score")).otherwise(0).alias("limit"))
        limits = write_once(open_langs.join(limits, "lang", "left").select("lang", F.coalesce("limit", F.lit(0)).alias("limit")), "collocation-limits")
        found = write_once(_expand(texts, single, pairs, limits, least, displaced_by), "collocation-found")
        reached = found.groupBy("lang").agg(F.count(F.lit(1)).alias("reached"))
        state = limits.join(reached, "lang", "left").withColumn(
            "settled", (F.col("limit") == 0) | (F.coalesce("reached", F.lit(0)) >= k)
        )
        results.append(found.join(state.where("settled").select("lang"), "lang", "left_semi"))
        open_langs = write_once(state.where(~F.col("settled")).select("lang"), "collocation-open")
        if open_langs.isEmpty():
            break
        size *= 2
    merged = results[0]
    for more in results[1:]:
        merged = merged.unionByName(more)
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    best = top_rows(merged, ["lang"], order, k, "rank").join(totals, "lang")
    return best.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def _expand(texts: DataFrame, single: DataFrame, pairs: DataFrame, limits: DataFrame, least: int, displaced_by: int) -> DataFrame:
    """All surviving candidates of the open languages that score their limit or more."""
    frontier = pairs.join(limits, "lang")
    expanded = frontier.where(F.col("bound") >= F.col("limit"))
    contested = frontier.where(F.col("score") >= F.col("limit"))
    tables = _table_of(expanded), _table_of(contested)
    of_open = texts.join(limits.select("lang"), "lang", "left_semi")
    counts = write_once(_summed(of_open.mapInArrow(_triples(*tables), COUNTS), least), "collocation-triples")
    triples = counts
    for name, part, known in (
        ("l1", _part(F.col("phrase"), 1, 1), single), ("r1", _part(F.col("phrase"), 2, 2), pairs),
        ("l2", _part(F.col("phrase"), 1, 2), pairs), ("r2", _part(F.col("phrase"), 3, 1), single),
    ):
        triples = _with_counts(triples, known, part, name)
    triples = triples.withColumn("one", _score("l1", "r1")).withColumn("two", _score("l2", "r2"))
    worse = F.col("two") < F.col("one")
    triples = triples.select(
        "lang", "phrase", "a",
        F.when(worse, F.col("l2")).otherwise(F.col("l1")).alias("l"),
        F.when(worse, F.col("r2")).otherwise(F.col("r1")).alias("r"),
        F.least("one", "two").alias("score"),
    ).join(limits, "lang").where(F.col("score") >= F.col("limit"))
    around = counts.select(
        "lang", F.explode(F.array_distinct(F.array(_part(F.col("phrase"), 1, 2), _part(F.col("phrase"), 2, 2)))).alias("phrase"), "a"
    ).groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = contested.join(around, ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | (100 * F.col("longer") < displaced_by * F.col("a"))
    )
    return kept.select("lang", "phrase", "a", "l", "r", "score").unionByName(triples.drop("limit"))
