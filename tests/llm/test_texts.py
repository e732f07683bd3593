"""Operators on documents, against brute force on small tables and on odd rows."""

import hashlib
import random
import re
import sys
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from milepost.llm import bpe, language, mixing, ngram_join, queries, repeats, suffixes, surrogates, toxicity
from milepost.llm.arrays import range_hashes, sliding, window_hashes, winnowed, words

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SMALL = "/root/testdata/sf0.001"
VOCABULARY = queries.VOCABULARY


def texts(docs):
    return [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]


# language


def test_language_held_out_accuracy(spark):
    found = queries.op1_language_mixture(spark, "/root/testdata/sf0.01")
    truth = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    rows = found.join(truth, "doc_id").where("held_out").select("lang", "lang_pred", "score").collect()
    assert len(rows) > 100
    assert sum(r.lang == r.lang_pred for r in rows) / len(rows) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_mixture_of_two_halves(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language.learn_languages(docs)
    pick = {r.lang: r.text for r in docs.where("n_chars > 2000").groupBy("lang").agg(F.min("text").alias("text")).collect()}
    mixed = spark.createDataFrame([(1, pick["en"][:1500] + " " + pick["de"][:1500])], "doc_id long, text string")
    row = language.identify_languages(mixed, model).first()
    shares = {m.lang: m.share for m in row.mixture}
    assert set(shares) == {"en", "de"} and abs(shares["en"] - 0.5) < 0.15


def test_language_odd_rows(odd_documents, no_documents):
    model = language.learn_languages(odd_documents)
    rows = language.identify_languages(odd_documents, model).collect()
    assert len(rows) == 14
    for r in rows:
        blank = r.text is None or not any(c.isalpha() for c in r.text)
        assert (r.lang_pred == "und") == blank and (r.score == 0) == blank and (r.mixture == []) == blank
    assert language.identify_languages(no_documents, model).count() == 0
    nothing = language.learn_languages(no_documents)
    assert {r.lang_pred for r in language.identify_languages(odd_documents, nothing).collect()} == {"und"}


# mixing


def expected_mix(rows, passes=3, weights=(5, 2, 1)):
    """Targets by plain iteration."""
    sizes = defaultdict(int)
    for source, size in rows:
        sizes[source] += size
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    open_, target, left = set(names), {}, float(sum(sizes.values()))
    while open_:
        total = sum(weight[s] for s in open_)
        full = {s for s in open_ if left * weight[s] / total > passes * sizes[s]}
        if not full:
            target |= {s: left * weight[s] / total for s in open_}
            break
        for s in full:
            target[s] = float(passes * sizes[s])
            left -= target[s]
        open_ -= full
    return sizes, target


@pytest.mark.parametrize("table", ["odd", "small"])
def test_mix_targets_and_budget(spark, odd_documents, table):
    docs = odd_documents if table == "odd" else spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = mixing.mix_sources(docs).collect()
    source = [(r.source, len(WORD.findall(r.text or ""))) for r in docs.collect()]
    sizes, target = expected_mix(source)
    assert Counter((r.source, r.size) for r in rows) == Counter(source)
    for r in rows:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(target[r.source])
        assert r.taken in {r.size * t for t in range(4)}
    budget = sum(sizes.values())
    assert sum(r.taken for r in rows) <= budget
    if table == "small":
        for s in sizes:
            taken, largest = sum(r.taken for r in rows if r.source == s), max(r.size for r in rows if r.source == s)
            assert abs(taken - target[s]) <= largest + 0.05 * target[s]
        again = mixing.mix_sources(docs.repartition(7)).collect()
        assert Counter(map(tuple, rows)) == Counter(map(tuple, again))


def test_mix_is_cut_by_finish_time(spark):
    """Against the plain queue: sort all finish times, take while the budget lasts."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = mixing.mix_sources(docs).collect()
    places = {r.doc_id: r.p for r in docs.select("doc_id", F.xxhash64("doc_id", mixing.word_count(F.col("text")), F.lit(mixing.SEED)).alias("p")).collect()}
    queue, until = [], defaultdict(int)
    for r in sorted(rows, key=lambda r: (places[r.doc_id], r.doc_id)):
        until[r.source] += r.size
        if r.size:
            queue += [((p * r.source_size + until[r.source]) / r.target, r.size, r.doc_id) for p in range(3)]
    total, taken = 0, Counter()
    for _, size, doc_id in sorted(queue):
        total += size
        if total > sum(r.size for r in rows):
            break
        taken[doc_id] += size
    assert {r.doc_id: r.taken for r in rows} == {r.doc_id: taken[r.doc_id] for r in rows}


def test_mix_applied_and_empty(odd_documents, no_documents):
    mixed = mixing.apply_mix(odd_documents)
    assert mixed.columns == odd_documents.columns
    want = sum(r.taken // r.size if r.size else 1 for r in mixing.mix_sources(odd_documents).collect())
    assert mixed.count() == want
    assert mixing.mix_sources(no_documents).count() == 0 and mixing.apply_mix(no_documents).count() == 0


def test_mix_plan_is_native(spark):
    plan = mixing.mix_sources(spark.read.parquet(f"{SMALL}/documents.parquet"))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan)


# n-gram join


def brute_classes(rows):
    grams = []
    for _, text in rows:
        w = WORD.findall(text or "")
        grams.append(frozenset(" ".join(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset())
    parent, links = list(range(len(rows))), Counter()

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(grams):
        for j, b in enumerate(grams[:i]):
            if a and b and len(a & b) >= 0.8 * len(a | b) - 1e-9:
                links[i] += 1
                links[j] += 1
                parent[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[find(i)] = min(least.get(find(i), doc_id), doc_id)
    return Counter((d, least.get(find(i)), links[i]) for i, (d, _) in enumerate(rows))


def test_ngram_join_against_all_pairs(spark, odd_documents):
    for docs in (spark.read.parquet(f"{SMALL}/documents.parquet"), odd_documents):
        found = ngram_join.similar_classes(docs)
        assert Counter(map(tuple, found.select("doc_id", "class_id", "n_links").collect())) == brute_classes(texts(docs))


def test_ngram_join_splits_a_hot_bucket(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK_TEXTS", 8)
    base = [f"w{i}" for i in range(200)]
    rows = [(i, " ".join(base[:i] + ["new"] + base[i + 1 :])) for i in range(60)] + [(100, "other words entirely in this text here")]
    found = ngram_join.similar_classes(spark.createDataFrame(rows, "doc_id long, text string"))
    assert Counter(map(tuple, found.collect())) == brute_classes(rows)


def test_ngram_join_empty_and_bands(no_documents):
    assert ngram_join.similar_classes(no_documents).count() == 0
    bands, rows = ngram_join.band_counts(0.8, 0.999, 64)
    assert bands * rows <= 64 and 1 - (1 - 0.8**rows) ** bands >= 0.999


def test_keep_one_of_each(odd_documents):
    kept = ngram_join.keep_one_of_each(odd_documents)
    assert kept.columns == odd_documents.columns
    ids = Counter(r.doc_id for r in kept.collect())
    assert ids[5] == 1 and ids[6] == 0 and ids[12] == 1 and ids[None] == 1 and ids[2] == 1


# BPE


def test_bpe_as_the_library(spark, odd_documents):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(VOCABULARY)
    hard = ["<|endoftext|>a<|endoftext|>", " " * 300, "a" * 700, "don't we'LL 12³ ½ \u0085\x1c　x", "日本語😀‍👩", "\r\n\r\n x"]
    extra = spark.createDataFrame([(100 + i, t) for i, t in enumerate(hard)], "doc_id long, text string")
    docs = odd_documents.select("doc_id", "text").union(extra).union(spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text"))
    vocabulary = bpe.Vocabulary(VOCABULARY)
    rows = bpe.encode_texts(docs, vocabulary).collect()
    assert Counter(r.doc_id for r in rows) == Counter(d for d, _ in texts(docs))
    by_text = {(d, t) for d, t in texts(docs)}
    for r in rows:
        options = [t for d, t in by_text if d == r.doc_id]
        assert any(list(r.ids) == library.encode(t or "", add_special_tokens=False).ids and r.decoded == (t or "") for t in options)
    decoded = bpe.decode_ids(bpe.encode_texts(docs, vocabulary).select("doc_id", "ids"), vocabulary)
    assert Counter((r.doc_id, r.decoded) for r in decoded.collect()) == Counter((r.doc_id, r.decoded) for r in rows)


def test_bpe_words_level_by_level():
    from tokenizers import Tokenizer

    library, vocabulary, rng = Tokenizer.from_file(VOCABULARY), bpe.Vocabulary(VOCABULARY), np.random.default_rng(5)
    letters = np.array(list("aeinorstäж日"))
    found = {"".join(rng.choice(letters, n)) for n in [*rng.integers(1, 12, 3_000), *range(30, 200, 5)]}
    found |= {w[:i] for w in list(found)[:500] for i in range(1, len(w))} | {" " + w for w in list(found)[:500]}
    raw, encoder = [w.encode() for w in found], bpe.Encoder(bpe.Suffixes(vocabulary.whole_ids()), vocabulary.parts, vocabulary.ranks)
    assert any(len(w) > bpe.LEVELS for w in raw)
    packed = encoder.encode(raw)
    assert {w.decode(): np.frombuffer(ids, "<i4").tolist() for w, ids in packed.items()} == {w: library.encode(w, add_special_tokens=False).ids for w in found}
    assert encoder.encode([]) == {}
    # a call for each level, not for each byte
    short, calls = [w for w in raw if len(w) <= bpe.LEVELS], []
    sys.setprofile(lambda _, event, __: calls.append(1) if event in ("call", "c_call") else None)
    try:
        encoder.encode(short)
    finally:
        sys.setprofile(None)
    assert len(calls) < sum(map(len, short)) / 2


def test_bpe_ascii_words():
    import regex

    rng, signs = np.random.default_rng(6), [*map(chr, range(128)), *" \n\t'sreat1" * 8]
    for _ in range(5_000):
        text = "".join(rng.choice(signs, 12))
        assert re.findall(bpe.ASCII_WORDS, text) == regex.findall(bpe.WORDS, text)


def test_bpe_other_vocabularies_are_refused(tmp_path, no_documents):
    with pytest.raises(ValueError):
        bpe.Vocabulary("/opt/tokenizers/word_bpe_49k.json")
    assert bpe.encode_texts(no_documents, bpe.Vocabulary(VOCABULARY)).count() == 0


def test_bpe_operator_query(spark):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(VOCABULARY)
    rows = {r.doc_id: r for r in queries.op6_trie_bpe(spark, SMALL).collect()}
    for doc_id, text in texts(spark.read.parquet(f"{SMALL}/documents.parquet")):
        ids = library.encode(text or "", add_special_tokens=False).ids
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        assert (rows[doc_id].n_tokens, rows[doc_id].ids_sha256) == (len(ids), sha(",".join(map(str, ids))))
        assert rows[doc_id].decoded_sha256 == sha(library.decode(ids, skip_special_tokens=False))


# repeats


def brute_repeats(rows, length, kind):
    seen, out = {}, {}
    units = {}
    for doc_id, text in rows:
        raw = (text or "").encode()
        units[doc_id] = [w.encode() for w in WORD.findall(text or "")] if kind == "word" else raw
    join = (lambda u: b" ".join(u)) if kind == "word" else bytes
    for doc_id in sorted(d for d in units if d is not None):
        u = units[doc_id]
        for p in range(len(u) - length + 1):
            seen.setdefault(join(u[p : p + length]), (doc_id, p))
    for doc_id, u in units.items():
        gone = np.zeros(len(u), bool)
        for p in range(len(u) - length + 1 if doc_id is not None else 0):
            if seen[join(u[p : p + length])] < (doc_id, p):
                gone[p : p + length] = True
        spans = int((gone & ~np.concatenate(([False], gone[:-1]))).sum())
        kept = [x for x, g in zip(u, gone) if not g]
        out[doc_id] = (len(u), int(gone.sum()), spans, hashlib.sha256(join(kept)).hexdigest())
    return out


@pytest.mark.parametrize("kind", ["word", "byte"])
def test_repeats_against_brute_force(spark, odd_documents, kind):
    run = repeats.repeated_passages if kind == "word" else suffixes.repeated_bytes
    for docs in (spark.read.parquet(f"{SMALL}/documents.parquet"), odd_documents):
        expected = brute_repeats(texts(docs), 20 if kind == "word" else 100, kind)
        rows = run(docs).collect()
        assert len(rows) == docs.count()
        for r in rows:
            assert (r["size"], r.removed, len(r.spans), r.kept_sha256) == expected[r.doc_id], r.doc_id
            assert sum(s.length for s in r.spans) == r.removed


def test_repeats_with_hot_anchors(spark, monkeypatch):
    """Anchors over the limit are dealt window by window; the result is the same."""
    monkeypatch.setattr(suffixes, "HOT", 3)
    monkeypatch.setattr(suffixes, "CHUNK_BYTES", 2_000)
    common = "".join(chr(97 + i * i % 26) for i in range(170))
    rows = [(i, f"{i * 7919:x}" * 9 + common + f"{i * 104729:x}" * 9) for i in range(1, 40)]
    found = suffixes.repeated_bytes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    expected = brute_repeats(rows, 100, "byte")
    for r in found:
        assert (r["size"], r.removed, len(r.spans), r.kept_sha256) == expected[r.doc_id]
    assert sum(r.removed for r in found) > 30 * 170


def test_repeats_empty(no_documents):
    assert repeats.repeated_passages(no_documents).count() == 0
    assert suffixes.repeated_bytes(no_documents).count() == 0


def test_previous_factors_value_by_value():
    rng = np.random.default_rng(8)
    for letters, size, length in ((1, 60, 12), (2, 300, 12), (3, 400, 100), (26, 200, 5), (2, 12, 12)):
        data = rng.integers(97, 97 + letters, size).astype(np.uint8)
        if letters > 1 and size > 200:
            data[150:280] = data[10:140]
        starts = np.arange(size - length + 1)
        shuffled = rng.permutation(len(starts))
        # windows of the same bytes may have one place
        same = np.array([min(shuffled[j] for j in starts if (data[j : j + length] == data[i : i + length]).all()) for i in starts])
        for places in (starts, shuffled, same):
            found = suffixes.previous_factors(data, starts, places, length)
            raw = data.tobytes()
            for i in starts:
                shared = [
                    next((n for n in range(length) if raw[i + n] != raw[j + n]), length) for j in starts if places[j] < places[i]
                ]
                assert found[i] == max(shared, default=0)
    assert len(suffixes.previous_factors(np.zeros(0, np.uint8), np.zeros(0, np.int64), np.zeros(0, np.int64), 5)) == 0


def test_previous_factors_without_a_loop_over_windows():
    rng = np.random.default_rng(9)
    for size in (1, 2, 3, 17, 64, 200):
        for places in (rng.permutation(size), np.arange(size), np.arange(size)[::-1], rng.integers(0, 5, size)):
            common = np.concatenate(([0], rng.integers(0, 9, size - 1)))
            expected = []
            for i in range(size):
                before = [j for j in range(i) if places[j] < places[i]]
                expected.append(min(common[before[-1] + 1 : i + 1]) if before else 0)
            assert suffixes._shared_with_smaller(places, common).tolist() == expected
    data, calls = rng.integers(0, 4, 20_000).astype(np.uint8), []
    starts = np.arange(len(data) - 30)
    sys.setprofile(lambda _, event, __: calls.append(1) if event in ("call", "c_call") else None)
    try:
        suffixes.previous_factors(data, starts, rng.permutation(len(starts)), 30)
    finally:
        sys.setprofile(None)
    assert len(calls) < len(starts) / 10


def test_suffix_ranks_against_sorting():
    rng = np.random.default_rng(2)
    data = rng.integers(97, 99, 400).astype(np.uint8)
    starts = np.arange(300)
    for length in (5, 8, 20, 100):
        rank = suffixes.suffix_ranks(data, starts, length)
        cut = [data[s : s + length].tobytes() for s in starts]
        order = {r: i for i, r in enumerate(sorted(set(rank.tolist())))}
        assert [sorted(set(cut)).index(c) for c in cut] == [order[r] for r in rank.tolist()]


# hashing helpers


def test_window_hashes_and_winnowing():
    rng = np.random.default_rng(3)
    values = rng.integers(0, 2**63, 500, dtype=np.uint64)
    values[300:400] = values[100:200]
    hashes = window_hashes(values, 5)
    assert (hashes[300:396] == hashes[100:196]).all() and len(set(hashes.tolist())) == 496 - 96
    assert (range_hashes(values, np.array([7]), np.array([12])) == range_hashes(values, np.array([7]), np.array([12]))).all()
    chosen = winnowed(hashes, 16)
    for start in range(len(hashes) - 15):
        assert chosen[start + int(hashes[start : start + 16].argmin())]
    assert (sliding(values, 13) == np.array([values[i : i + 13].min() for i in range(488)])).all()


def test_words_are_those_of_the_pattern():
    rows = ["", " a  b", "x y z", "\tq\n", "é漢 字"]
    raw = [r.encode() for r in rows]
    data, offsets = np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)])
    starts, ends, bounds = words(data, offsets)
    found = [[data[a:b].tobytes().decode() for a, b in zip(starts[f:t], ends[f:t])] for f, t in zip(bounds, bounds[1:])]
    assert found == [WORD.findall(r) for r in rows]


# toxicity


def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = queries.op8_kneser_ney(spark, sf).collect()
    assert len(rows) == 10_000 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id in labels]
    toxic = np.array([r.score for r in held if labels[r.doc_id]])
    plain = np.array([r.score for r in held if not labels[r.doc_id]])
    assert np.mean([(t > plain).mean() for t in toxic]) > 0.9
    assert (plain >= 0.7).mean() < 0.01 and (toxic >= 0.7).mean() > 0.5


def test_toxicity_odd_rows(spark, odd_documents, no_documents):
    labels = spark.createDataFrame([(5, 1), (5, 1), (7, 0), (9, 0), (10, None), (None, 1), (11, 2)], "doc_id long, toxic int")
    model = toxicity.learn_toxicity(odd_documents, labels)
    rows = toxicity.score_toxicity(odd_documents, model).collect()
    assert len(rows) == 14 and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if not (r.text or "").strip()}) == 1
    none = toxicity.learn_toxicity(no_documents, labels.where("false"))
    assert {r.score < 1e-6 for r in toxicity.score_toxicity(odd_documents, none).collect()} == {True}
    assert toxicity.score_toxicity(no_documents, model).count() == 0


# surrogates

PRIVATE = [
    "write to anna.k42@mail.example.org or Anna.K42@mail.example.org now",
    "call +49 (030) 555-1234 or (212) 555-7788",
    "host 192.168.17.4 answered",
    "card 4111 1111 1111 1111 and 4111111111111112",
    'token = "0123456789abcdef0123456789abcdef01234567"',
    "Mrs. Maria Keller met Herr Schröder and г-жа Анна Петрова",
    "ssn 123-45-6789, iban DE89370400440532013000",
]


def test_surrogates_keep_format_and_identity(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(PRIVATE * 2)], "doc_id long, text string")
    rows = {r.doc_id: r for r in surrogates.replace_private(docs, b"k1").collect()}
    maker = surrogates.Surrogates(b"k1")
    seen = {}
    for i, text in enumerate(PRIVATE * 2):
        before, after = list(maker.find(text)), list(maker.find(rows[i].text))
        assert rows[i].n_entities == len(before) > 0 and [b[2] for b in before] == [a[2] for a in after]
        for b, a in zip(before, after):
            assert b[3].lower() != a[3].lower()
            assert seen.setdefault((b[2], b[3].lower()), a[3].lower()) == a[3].lower()
    assert len({(k[0], v) for k, v in seen.items()}) == len(seen)
    card = re.findall(r"\d[\d ]{14,18}\d", rows[3].text)
    right = [surrogates._luhn(c.strip()[:-1]) == int(c.strip()[-1]) for c in card]
    assert right == [True, False]
    other = {r.doc_id: r.text for r in surrogates.replace_private(docs, b"k2").collect()}
    assert all(other[i] != rows[i].text for i in other)


def test_surrogate_gender_and_script():
    maker = surrogates.Surrogates(b"k")
    kinds = {v: k for _, _, k, v in maker.find(PRIVATE[5])}
    assert kinds == {"Maria Keller": "female", "Schröder": "male", "Анна Петрова": "female"}
    assert maker.replace("female", "Maria Keller").split()[0] in surrogates.GIVEN["female", "latin"]
    assert maker.replace("female", "Анна Петрова").split()[0] in surrogates.GIVEN["female", "cyrillic"]


def test_permutations_are_bijective():
    maker = surrogates.Surrogates(b"k")
    for sizes in ([10], [10, 10], [6, 20, 10]):
        every = [[]]
        for s in sizes:
            every = [e + [d] for e in every for d in range(s)]
        assert len({tuple(maker.permute(e, sizes, "t")) for e in every}) == len(every)


def test_surrogates_draw_again_on_collision(spark, monkeypatch):
    """A short list of given names and a scrambler that does nothing force collisions."""
    monkeypatch.setitem(surrogates.GIVEN, ("male", "latin"), ["Hugo", "Bruno", "Felix", "Anton", "Oscar", "Simon"])
    names = ["Karl", "Egon", "Otto", "Kurt"]
    docs = spark.createDataFrame([(i, f"Herr {n} Maier ruft") for i, n in enumerate(names)] + [(9, "Herr Hugo Maier")], "doc_id long, text string")
    monkeypatch.setattr(surrogates.Surrogates, "scramble", lambda self, value, *a, **k: value)
    rows = surrogates.replace_private(docs, b"k").collect()
    assert len({r.text.split("Herr ")[1].split()[0] for r in rows}) == 5
    assert all(r.n_entities == 1 for r in rows)


def test_surrogates_grow_where_a_format_is_used_up(spark):
    """More names of two vowels than there are, and names that no class can change."""
    names = [a.upper() + b for a in "aeiouy" for b in "aeiouy"] + ["Þð", "Ðþ"]
    docs = spark.createDataFrame([(i, f"Frau {n} kommt") for i, n in enumerate(names)], "doc_id long, text string")
    made = [r.text.split()[1].lower() for r in surrogates.replace_private(docs, b"k").collect()]
    assert len(set(made)) == len(names) and not set(made) & {n.lower() for n in names}


def test_surrogates_odd_rows(odd_documents, no_documents):
    rows = surrogates.replace_private(odd_documents, b"k").collect()
    assert Counter((r.doc_id, r.text) for r in rows) == Counter((r.doc_id, r.text) for r in odd_documents.collect())
    assert surrogates.replace_private(no_documents, b"k").count() == 0


def _matching(tree, draw):
    """A string after a parsed pattern; what stands around it is left out."""
    out = ""
    for op, arg in tree:
        name = str(op)
        if name == "LITERAL":
            out += chr(arg)
        elif name == "IN":
            kind, value = draw.choice(arg)
            one = {"LITERAL": lambda: chr(value), "RANGE": lambda: chr(draw.randint(*value)), "CATEGORY": lambda: draw.choice("0123456789٣")}
            out += one[str(kind)]()
        elif name == "MAX_REPEAT":
            low, high, inner = arg
            out += "".join(_matching(inner, draw) for _ in range(draw.randint(low, min(high, low + 2))))
        elif name == "SUBPATTERN":
            out += _matching(arg[3], draw)
        elif name == "BRANCH":
            out += _matching(draw.choice(arg[1]), draw)
    return out


def test_every_match_passes_the_filter(spark):
    maker, draw, found = surrogates.Surrogates(b"k"), random.Random(7), set()
    for kind, pattern in surrogates.PATTERNS.items():
        made = {_matching(re._parser.parse(pattern), draw) for _ in range(600)}
        held = {t for t in made if re.search(pattern, t)}
        assert len(held) > 40, kind
        found |= held
    found |= {"host 10.0.0.1 answered", "8.8.8.8", "127.0.0.1", "10.1.2.30", "+49 (30) 123 456", "+44 (20) 79 46 09", "api \u212aey: abcdefabcdef"}
    docs = spark.createDataFrame([(t,) for t in sorted(found)], "text string")
    assert docs.where(~F.col("text").rlike(surrogates.CANDIDATE)).collect() == []
    assert all(any(True for _ in maker.find(t)) for t in ("8.8.8.8", "+44 (20) 79 46 09"))


def test_short_addresses_and_numbers_are_replaced(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(["host 10.0.0.1 answered", "call +49 (30) 123 456", "host 10.0.0.1, mail a@b.org"])], "doc_id long, text string")
    rows = {r.doc_id: r for r in surrogates.replace_private(docs, b"k").collect()}
    assert [rows[i].n_entities for i in range(3)] == [1, 1, 2]
    assert "10.0.0.1" not in rows[0].text and "123 456" not in rows[1].text
    assert rows[0].text.split()[1] == rows[2].text.split()[1].rstrip(",")


def test_words_after_an_iban():
    maker = surrogates.Surrogates(b"k")

    def found(text):
        return [(k, v) for _, _, k, v in maker.find(text)]

    iban = "ES91 2100 0418 4502 0005 1332"
    assert found(f"{iban} BIC CAIX") == found(iban) == [("iban", iban)]
    assert found(f"AB12 {iban}") == [("iban", iban)]
    assert found("AB12 4111 1111 1111 1111") == [("card", "4111 1111 1111 1111")]
    assert found("DE88370400440532013000") == []


def test_parts_of_a_name_stay_related(spark):
    text = "Mrs. Anna Miller came. Mrs. Miller sat; Anna Miller spoke, Miller's hat, MILLER and Anna. Mr. Miller, Miss Anna; a miller, Millers"
    docs = spark.createDataFrame([(0, text), (1, "Frau Miller kommt"), (2, "Miller and Anna are not titled")], "doc_id long, text string")
    rows = {r.doc_id: r for r in surrogates.replace_private(docs, b"k").collect()}
    m = re.fullmatch(r"Mrs\. (\w+) (\w+) came\. Mrs\. (\w+) sat; (\w+) (\w+) spoke, (\w+)'s hat, (\w+) and (\w+)\. Mr\. (\w+), Miss (\w+); a miller, Millers", rows[0].text)
    given, surname = m.group(1), m.group(2)
    assert given in surrogates.GIVEN["female", "latin"] and given != "Anna" and surname != "Miller"
    assert [m.group(i) for i in (4, 8, 10)] == [given] * 3
    assert [m.group(i) for i in (3, 5, 6, 9)] == [surname] * 4 and m.group(7) == surname.upper()
    assert rows[0].n_entities == 8
    assert rows[1].text == f"Frau {surname} kommt"
    assert rows[2].text == "Miller and Anna are not titled" and rows[2].n_entities == 0


def test_many_given_names_stay_apart(spark):
    names = [a + b for a in ("Al", "Be", "Ca", "Do") for b in ("na", "ra", "la", "ma", "ta", "sa", "va", "ka")]
    docs = spark.createDataFrame([(i, f"Frau {n} Maier kommt") for i, n in enumerate(names)], "doc_id long, text string")
    made = [r.text.split()[1:3] for r in surrogates.replace_private(docs, b"k").collect()]
    assert len({g for g, _ in made}) == len(names) and len({s for _, s in made}) == 1
