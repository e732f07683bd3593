"""Language identification as inference of a language mixture per document.

Learning counts character trigrams per language over all labelled rows; the tables have a
fixed size. For a document each word gets a likelihood under every language. Expectation
maximisation turns these into language proportions, first over all languages and then over
the sets of the most present ones; the set with the best penalised likelihood stays.

Defined results: a text that is null, empty or without a letter is ``und`` with score 0 and
an empty mixture; so is every text if nothing was learned. Rows with a null language or
text teach nothing. Equal likelihoods go to the language first by code point. Rows that
repeat are judged each on its own, and nothing but the text enters a prediction.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from milepost.llm.arrays import ranges, text_runs

UNDETERMINED = "und"
CLASSES = 64
CODES = CLASSES**3
SMOOTHING = 2.0
EM_ROUNDS = 12
PENALTY_LOG, PENALTY_WORD = 2.0, 0.02

_BREAK, _DIGIT, _MARK, _QUOTE, _HIGH = 0, 27, 28, 29, 32


def _byte_classes() -> np.ndarray:
    """Letters keep their own class, UTF-8 lead and trailing bytes share 16 each."""
    out = np.full(256, _MARK, np.int32)
    out[[0x20, *range(0x09, 0x0E)]] = _BREAK
    for i in range(26):
        out[ord("a") + i] = out[ord("A") + i] = 1 + i
    out[ord("0") : ord("9") + 1] = _DIGIT
    out[ord("'")] = _QUOTE
    out[0x80:0xC0] = _HIGH + np.arange(64) // 4
    out[0xC0:] = _HIGH + 16 + np.arange(64) // 4
    return out


BYTE_CLASS = _byte_classes()
LETTER = np.zeros(CLASSES, bool)
LETTER[1:27] = LETTER[_HIGH:] = True


def _trigrams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Trigram code at each byte, whether it counts, and where a word of letters begins.

    A trigram counts if it ends in a letter or in the character that ends a word. The text
    before the first character is a break.
    """
    kinds = np.zeros(len(data) + 2, np.int32)
    kinds[2:] = BYTE_CLASS[data]
    one, two = kinds[1:-1].copy(), kinds[:-2].copy()
    begins = offsets[:-1][np.diff(offsets) > 0]
    one[begins] = two[begins] = _BREAK
    second = begins[begins + 1 < len(data)] + 1
    two[second] = _BREAK
    now = kinds[2:]
    letter = LETTER[now]
    after = LETTER[one]
    return (two * CLASSES + one) * CLASSES + now, letter | after, letter & ~after


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals: dict[str, np.ndarray] = {}
    for batch in batches:
        labels = batch.column("lang").to_numpy(zero_copy_only=False)
        for first, last, data, offsets in text_runs(batch.column("text")):
            names, which = np.unique(labels[first:last].astype(str), return_inverse=True)
            codes, counts, _ = _trigrams(data, offsets)
            owner = np.repeat(which, np.diff(offsets))
            seen = np.bincount(owner[counts] * CODES + codes[counts], minlength=len(names) * CODES)
            for name, row in zip(names, seen.reshape(len(names), CODES)):
                totals[str(name)] = totals.get(str(name), 0) + row
    for name, row in totals.items():
        code = np.flatnonzero(row)
        yield pa.RecordBatch.from_arrays(
            [pa.array([name] * len(code)), pa.array(code.astype(np.int32)), pa.array(row[code])],
            names=["lang", "code", "n"],
        )


class LanguageModel:
    """Log probability of a trigram's last character given the two before, by language."""

    def __init__(self, names: list[str], counts: np.ndarray):
        self.names = names
        self.table = np.stack([_smoothed(c) for c in counts]) if names else np.zeros((0, CODES), np.float32)


def _smoothed(counts: np.ndarray) -> np.ndarray:
    """Trigrams interpolated with bigrams, these with single characters."""
    three = counts.reshape(CLASSES, CLASSES, CLASSES).astype(np.float64)
    two, one = three.sum(0), three.sum((0, 1))
    p1 = (one + SMOOTHING) / (one.sum() + SMOOTHING * CLASSES)
    p2 = (two + SMOOTHING * p1) / (two.sum(1, keepdims=True) + SMOOTHING)
    p3 = (three + SMOOTHING * p2) / (three.sum(2, keepdims=True) + SMOOTHING)
    return np.log(p3).astype(np.float32).ravel()


def learn_languages(rows: DataFrame) -> LanguageModel:
    """Model of the ``lang`` values of ``rows(text, lang)``; every row counts.

    Tasks send table entries, not texts: at most 64**3 numbers per language.
    """
    usable = rows.select("text", "lang").where(F.col("text").isNotNull() & F.col("lang").isNotNull())
    sums = (
        usable.mapInArrow(_count, "lang string, code int, n bigint")
        .groupBy("lang", "code")
        .agg(F.sum("n").alias("n"))
        .toArrow()
    )
    names = sorted(set(sums.column("lang").to_pylist()))
    counts = np.zeros((len(names), CODES), np.int64)
    which = np.array([names.index(x) for x in sums.column("lang").to_pylist()], np.int64)
    counts[which, sums.column("code").to_numpy()] = sums.column("n").to_numpy()
    return LanguageModel(names, counts)


def _maximise(fit: np.ndarray, firsts: np.ndarray, lengths: np.ndarray, shares: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Proportions by expectation maximisation, and the log-likelihood they reach.

    ``fit`` has the relative likelihood of each word by language, ``firsts`` the first word
    of each document. Languages that start at 0 stay there.
    """
    for _ in range(EM_ROUNDS):
        part = fit * np.repeat(shares, lengths, axis=1)
        part /= part.sum(0)
        shares = np.add.reduceat(part, firsts, axis=1) / lengths
    mixed = np.log((fit * np.repeat(shares, lengths, axis=1)).sum(0))
    return shares, np.add.reduceat(mixed, firsts)


def mixtures(names: list[str], table: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Language proportions of each text (rows of 0 if it has no word), and their trust.

    The trust of a text is the chance of its main language against those outside its set.
    """
    size, languages = len(offsets) - 1, len(names)
    shares, trust = np.zeros((size, languages)), np.zeros(size)
    codes, counts, begin = _trigrams(data, offsets)
    codes, starts = codes[counts], np.flatnonzero(begin[counts])
    if not languages or not len(starts):
        return shares, trust
    words = np.stack([np.add.reduceat(row[codes], starts) for row in table])
    fit = np.maximum(np.exp(words - words.max(0)), np.float32(1e-30))
    bounds = np.searchsorted(np.flatnonzero(begin), offsets)
    has = np.flatnonzero(np.diff(bounds))
    firsts, lengths = bounds[:-1][has], np.diff(bounds)[has].astype(np.float32)
    times = np.diff(bounds)[has]
    alone = np.add.reduceat(np.log(fit), firsts, axis=1).astype(np.float64)
    everyone = np.arange(len(has))
    best, value = alone.argmax(0), alone.max(0)
    penalty = PENALTY_LOG * np.log(lengths + 1.0) + PENALTY_WORD * lengths
    found = np.zeros((languages, len(has)))
    found[best, everyone] = 1.0
    even = np.full((languages, len(has)), 1.0 / languages, np.float32)
    every, reached = _maximise(fit, firsts, times, even)
    # a smaller set cannot beat all languages together: the rest is settled
    unsettled = np.flatnonzero(reached - value > penalty)
    if len(unsettled):
        own, own_times = fit[:, ranges(firsts[unsettled], times[unsettled])], times[unsettled]
        own_firsts = np.concatenate(([0], np.cumsum(own_times)[:-1]))
        order = np.argsort(-every[:, unsettled], axis=0, kind="stable").argsort(0, kind="stable")
        for members in range(2, languages + 1):
            start = np.where(order < members, np.float32(1 / members), np.float32(0))
            part, reach = _maximise(own, own_firsts, own_times, start)
            reach = reach - (members - 1) * penalty[unsettled]
            better = reach > value[unsettled]
            value[unsettled[better]] = reach[better]
            found[:, unsettled[better]] = part[:, better]
    main = found.argmax(0)
    rivals = np.where((found > 0) & (np.arange(languages)[:, None] != main), -np.inf, alone)
    chance = np.exp(rivals - rivals.max(0))
    trust[has] = chance[main, everyone] / chance.sum(0)
    shares[has] = found.T
    return shares, trust


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def identify_languages(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` and ``mixture``.

    ``mixture`` lists the languages of the chosen set with their shares. Columns of these
    names are replaced; the others are kept as they are.
    """
    names = model.names
    output = [c for c in docs.columns if c not in ("lang_pred", "score", "mixture")]
    added = T.StructType.fromDDL("lang_pred string, score double, mixture array<struct<lang:string,share:double>>")
    schema = T.StructType([*docs.select(*output).schema.fields, *added.fields])
    model_of = docs.sparkSession.sparkContext.broadcast((model.names, model.table))

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        item = pa.struct([("lang", pa.string()), ("share", pa.float64())])
        for batch in batches:
            known, main, score, sets, counts = batch.column(len(output) + 1).to_numpy(zero_copy_only=False), [], [], [], []
            for first, last, data, offsets in text_runs(batch.column(len(output))):
                shares, trust = mixtures(*model_of.value, data, offsets)
                shares[~known[first:last]] = 0
                found = shares.sum(1) > 0 if names else np.zeros(last - first, bool)
                best = shares.argmax(1) if names else np.zeros(last - first, np.int64)
                main += [names[b] if f else UNDETERMINED for b, f in zip(best, found)]
                score.append(np.where(found, (shares.max(1) if names else 0.0) * trust, 0.0))
                doc, lang = np.nonzero(shares)
                sets.append((lang, shares[doc, lang]))
                counts.append(np.bincount(doc, minlength=last - first))
            lang = np.concatenate([s[0] for s in sets] or [np.zeros(0, np.int64)])
            share = np.concatenate([s[1] for s in sets] or [np.zeros(0)])
            values = pa.StructArray.from_arrays(
                [pa.array(np.array([*names, ""], object)[lang], pa.string()), pa.array(share)], fields=list(item)
            )
            ends = np.concatenate(([0], np.cumsum(np.concatenate(counts or [np.zeros(0, np.int64)]))))
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[: len(output)],
                    pa.array(main, pa.string()),
                    pa.array(np.clip(np.concatenate(score or [np.zeros(0)]), 0, 1)),
                    pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), values),
                ],
                names=[*output, "lang_pred", "score", "mixture"],
            )

    source = docs.select(*output, F.lower("text").alias("_lower"), has_letter(F.col("text")).alias("_letter"))
    return source.mapInArrow(predict, schema)
