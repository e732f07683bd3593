"""Phrase fingerprints, collocations and ranked search against brute force and SQL."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from milepost.checks.compare import difference, oracle_connection
from milepost.llm import collocations, fingerprints, lexical, ngram_join, queries, repeats
from milepost.llm.arrays import span_hashes
from milepost.llm.tables import bit_places, bit_table, has_bits

SMALL = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def mirrored(n):
    """A word over two letters in which every prefix sum cancels, and its mirror."""
    bits = [bin(i).count("1") % 2 for i in range(n)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


@pytest.mark.parametrize("size", [8, 16, 512, 1024, 2048])
def test_span_hashes_tell_mirrored_words_apart(size):
    one, two = mirrored(size)
    data = np.frombuffer((one + two + one).encode(), np.uint8)
    starts = np.arange(3) * size
    a, b, c = span_hashes(data, starts, starts + size)
    assert a == c and a != b


def test_mirrored_words_are_no_repeats(spark):
    """Documents that differ in one long word whose mirror a polynomial hash cannot tell from it."""
    one, two = mirrored(2048)
    around = [f"w{i}" for i in range(10)], [f"v{i}" for i in range(10)]
    docs = [(i, " ".join([*around[0], word, *around[1]])) for i, word in enumerate((one, two), 1)]
    removed = repeats.repeated_passages(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert [r.removed for r in removed] == [0, 0]
    texts = spark.createDataFrame([(1, one + " x"), (2, two + " x")], "doc_id long, text string")
    assert [r.n_links for r in ngram_join.similar_classes(texts).collect()] == [0, 0]
    assert ngram_join.keep_one_of_each(texts).count() == 2
    words = [" ".join(w) for w in mirrored(2048)]
    texts = spark.createDataFrame(list(enumerate(words)), "doc_id long, text string")
    assert {r.n_links for r in ngram_join.similar_classes(texts).collect()} == {1}  # the same five-word pieces


def test_different_texts_under_one_id_stay(spark):
    prose = [" ".join(f"{c}{i}" for i in range(30)) for c in "abc"]
    rows = [(1, prose[0]), (1, prose[1]), (2, prose[0]), (3, prose[2]), (1, prose[0]), (None, prose[2])]
    kept = ngram_join.keep_one_of_each(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(((r.doc_id or 0, r.text) for r in kept)) == sorted([(1, prose[0]), (1, prose[1]), (3, prose[2]), (0, prose[2])])


def test_span_hashes_depend_on_content_only():
    rng = random.Random(3)
    pieces = [bytes(rng.randrange(256) for _ in range(rng.randint(0, 40))) for _ in range(300)]
    data = np.frombuffer(b"".join(pieces) + b"".join(reversed(pieces)), np.uint8)
    ends = np.cumsum([len(p) for p in pieces + pieces[::-1]])
    hashes = span_hashes(data, np.concatenate(([0], ends[:-1])), ends)
    assert (hashes[:300] == hashes[300:][::-1]).all()
    assert len(set(hashes.tolist())) == len(set(pieces))


def test_bit_table(spark):
    hashes = span_hashes(np.arange(200, dtype=np.uint8), np.arange(199), np.arange(1, 200))
    places = bit_places(hashes)
    table = bit_table(spark.createDataFrame([(int(p),) for p in [0, 2**23 - 1, *places]], "place long"))
    assert has_bits(table, places).all()
    assert has_bits(table, np.array([0, 2**23 - 1])).all()
    assert np.unpackbits(table).sum() == len({0, 2**23 - 1, *places.tolist()})


# fingerprints


def plain_parse(content, limit=fingerprints.PHRASES):
    phrases, known, start = [], set(), 0
    while start < len(content):
        end = start + 1
        while end < len(content) and content[start:end] in known:
            end += 1
        piece = content[start:end]
        phrases.append(piece)
        if piece not in known:
            known = known | {piece} if len(known) < limit - 1 else set()
        start = end
    return phrases


def plain_print(content, limit=fingerprints.PHRASES):
    least = {}
    for piece in set(plain_parse(content, limit)):
        h = int(span_hashes(np.frombuffer(piece, np.uint8), np.zeros(1, np.int64), np.array([len(piece)]))[0])
        low = (h << 7) % 2**64
        least[h >> 57] = min(least.get(h >> 57, 2**64), low)
    return [min(least[b] >> 40 & 0xFFFF, 0xFFFE) if b in least else 0xFFFF for b in range(fingerprints.BINS)]


def plain_likeness(one, two):
    filled = [(a, b) for a, b in zip(one, two) if a != 0xFFFF or b != 0xFFFF]
    return sum(a == b for a, b in filled) / len(filled) if filled else 1.0


def expected_prints(rows):
    docs = [(i, t or "") for i, t in rows]
    out = []
    for n, (doc_id, text) in enumerate(docs):
        following = docs[(n + 1) % len(docs)][1]
        cut = len(text) // 4
        changed = (text[: len(text) - cut] + following[:cut]).encode()
        own, after, other = plain_print(text.encode()), plain_print(changed), plain_print(following.encode())
        shown = ["".join(f"{x:04x}" for x in p) for p in (own, after)]
        out.append((
            doc_id, len(text), hashlib.sha256(changed).hexdigest(), *shown,
            round(plain_likeness(own, after), 12), round(plain_likeness(own, other), 12),
        ))
    return out


def print_rows(found):
    return sorted((r.doc_id if r.doc_id is not None else 10**9, *r[1:5], *(round(x, 12) for x in r[5:])) for r in found.collect())


@pytest.mark.parametrize("slices", [1, 4, 16])
def test_fingerprints_against_brute_force(spark, slices):
    rng = random.Random(slices)
    alphabet = ["the ", "of ", "straße ", "漢字", "x", "Nuñez ", "\n"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 120))) for _ in range(60)]
    rows = list(enumerate([*texts, None, "", texts[3], texts[3], "aé" * 300]))
    shuffled = rng.sample(rows, len(rows))
    docs = spark.createDataFrame(shuffled, "doc_id long, text string").repartition(slices)
    assert print_rows(fingerprints.edited_fingerprints(docs)) == sorted(expected_prints(rows))


def test_fingerprint_dictionary_restarts(monkeypatch):
    monkeypatch.setattr(fingerprints, "PHRASES", 8)
    rng = random.Random(1)
    for size in (0, 1, 3, 7, 30, 200):
        text = "".join(rng.choice("abc") for _ in range(size))
        doc = fingerprints.Document(1, text)
        pieces = [text.encode()[a:b] for a, b in zip([0, *doc.ends], doc.ends)]
        assert pieces == plain_parse(text.encode(), 8)
        content, ends = fingerprints.edited(doc, "cabbage" * 9)
        assert [content[a:b] for a, b in zip([0, *ends], ends)] == plain_parse(content, 8)


def test_fingerprints_of_odd_rows(spark, odd_documents, no_documents):
    found = fingerprints.edited_fingerprints(odd_documents).collect()
    assert len(found) == 14
    texts = {(r.doc_id, len(r.text or "")): r.text for r in odd_documents.collect()}
    assert all((r.doc_id, r.n_chars) in texts for r in found)
    by_id = {r.doc_id: r for r in found}
    assert by_id[5].fingerprint == by_id[6].fingerprint and by_id[5].near_next == 1
    assert by_id[1].near_edited == 1 and by_id[1].fingerprint == "ffff" * fingerprints.BINS
    assert by_id[None].n_chars == by_id[5].n_chars
    assert fingerprints.edited_fingerprints(no_documents).count() == 0
    alone = fingerprints.edited_fingerprints(spark.createDataFrame([(7, "abcdefgh")], "doc_id long, text string")).first()
    assert alone.near_next == 1 and alone.edited_sha256 == hashlib.sha256(b"abcdefab").hexdigest()


# collocations


def expected_phrases(rows, k, least):
    counts = {}
    for lang, text in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            for size in (1, 2, 3):
                counts.setdefault(lang or "und", Counter()).update(tuple(w[i : i + size]) for i in range(len(w) - size + 1))
    out = []
    for lang, f in counts.items():
        n = sum(c for p, c in f.items() if len(p) == 1)
        scored = []
        for p, a in f.items():
            if len(p) == 1 or a < least:
                continue
            around = [c for q, c in f.items() if len(q) == 3 and c >= least and p in (q[:2], q[1:])] if len(p) == 2 else []
            if any(100 * c >= 50 * a for c in around):
                continue
            cuts = [(10**6 * a * a // (f[p[:c]] * f[p[c:]]), c) for c in range(1, len(p))]
            score, c = min(cuts)
            scored.append((-score, -a, " ".join(p).encode(), f[p[:c]], f[p[c:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:k], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return sorted(out)


def mixed_texts(seed):
    rng = random.Random(seed)
    vocabulary = [f"W{i}" if i % 7 else f"é{i}漢" for i in range(25)]
    weights = [1 / (i + 1) for i in range(25)]
    prose = lambda n: "".join(rng.choices(vocabulary, weights)[0] + rng.choice([" ", " ", "  ", "\t", ", ", ".\n"]) for _ in range(n))
    rows = [(rng.choice(["en", "en", "en", "de", None]), prose(rng.randint(0, 60))) for _ in range(80)]
    rows += [("en", "Alpha beta gamma, delta epsilon")] * 12 + [("de", None), (None, ""), ("fr", None), ("xx", "one. two")]
    return rows


@pytest.mark.parametrize("k", [3, 15, 60, 2000])
def test_collocations_against_brute_force(spark, k):
    rows = mixed_texts(k)
    found = collocations.mine_phrases(spark.createDataFrame(rows, "lang string, text string").repartition(5), k, 5)
    assert sorted(tuple(r) for r in found.collect()) == expected_phrases(rows, k, 5)


def test_collocation_frontier_grows(spark, monkeypatch):
    """The best pairs are all displaced by longer phrases of low score, so more have to be expanded."""
    rounds = []
    expand = collocations._expand
    monkeypatch.setattr(collocations, "_expand", lambda *a: rounds.append(1) or expand(*a))
    rows = [("en", f"the a{i} b{i}.") for i in range(30) for _ in range(6)] + [("en", "u v, v w, u, w, x y, y, x")] * 6
    docs = spark.createDataFrame(rows, "lang string, text string")
    found = collocations.mine_phrases(docs, 5, 5)
    assert sorted(tuple(r) for r in found.collect()) == expected_phrases(rows, 5, 5)
    assert len(rounds) > 1


def test_collocations_of_odd_rows(odd_documents, no_documents):
    rows = [(r.lang, r.text) for r in odd_documents.select("lang", "text").collect()]
    found = collocations.mine_phrases(odd_documents, 50, 4)
    assert sorted(tuple(r) for r in found.collect()) == expected_phrases(rows, 50, 4)
    assert collocations.mine_phrases(no_documents).count() == 0


def test_collocations_sql(spark):
    sf_dir = "/root/testdata/sf0.01"
    found = queries.op12_phrase_growth(spark, sf_dir)
    assert difference(found, oracle_connection(sf_dir), queries.OP12_SQL) is None


# ranked search


def expected_ranks(docs, items, k):
    tokens = [(i, TERM.findall((t or "").translate(LOWER))) for i, t in docs]
    tokens = [(i, t) for i, t in tokens if t]
    total, length = len(tokens), sum(len(t) for _, t in tokens)
    df = Counter(w for _, t in tokens for w in set(t))
    out = []
    for item_id, text in items:
        scores = []
        asked = TERM.findall((text or "").translate(LOWER))
        for doc_id, t in tokens:
            tf, m = Counter(t), 75 + (25 * len(t) * total) // length
            score = sum(
                math.floor(1000 * math.log((2 * total + 2) / (2 * df[w] + 1))) * (10**9 * tf[w] // (1000 * tf[w] + 12 * m))
                for w in asked if tf[w]
            )
            if score > 0:
                scores.append((-score, doc_id is None, doc_id or 0))
        for rank, (score, missing, doc_id) in enumerate(sorted(scores)[:k], 1):
            out.append((item_id, rank, -1 if missing else doc_id, -score))
    return sorted(out, key=repr)


def rank_rows(found):
    return sorted(((r.item_id, r.rank, -1 if r.doc_id is None else r.doc_id, r.score) for r in found.collect()), key=repr)


@pytest.mark.parametrize("block", [1, 512])
def test_search_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(lexical, "BLOCK_ITEMS", block)
    rng = random.Random(block)
    vocabulary = [f"T{i}" if i % 5 else f"ñ{i}" for i in range(90)]
    prose = lambda n: " ".join(rng.choices(vocabulary, [1 / (i + 1) for i in range(90)], k=n))
    docs = [(i, prose(rng.randint(0, 40))) for i in range(150)]
    docs += [(150 + i, docs[7][1]) for i in range(30)] + [(None, docs[7][1]), (3, "T1 t2"), (200, None), (201, "--")]
    items = [(i, prose(rng.choice([3, 12, 90]))) for i in range(6)] + [(6, None), (7, "unheard of"), (1, docs[7][1]), (None, "T1 t1 ñ5")]
    found = lexical.ranked_search(
        spark.createDataFrame(docs, "doc_id long, text string").repartition(6),
        spark.createDataFrame(items, "item_id long, text string"),
    )
    assert rank_rows(found) == expected_ranks(docs, items, 20)


def test_search_odd_rows(spark, odd_documents, no_documents):
    items = spark.createDataFrame([(1, "one two aaaa 漢字"), (2, "")], "item_id long, text string")
    docs = [(r.doc_id, r.text) for r in odd_documents.select("doc_id", "text").collect()]
    assert rank_rows(lexical.ranked_search(odd_documents, items, 4)) == expected_ranks(docs, [(1, "one two aaaa 漢字"), (2, "")], 4)
    assert lexical.ranked_search(no_documents, items).count() == 0
    assert lexical.ranked_search(odd_documents, items.limit(0)).count() == 0


def test_masks_group_documents():
    present = np.array([[1, 1, 0, 1], [0, 0, 1, 0]] * 40, bool)
    bits, order, begins = lexical.by_mask(present)
    assert bits.shape == (80, 2) and sorted(order.tolist()) == [0, 1, 2, 3]
    assert {tuple(sorted(g)) for g in np.split(order, begins[1:])} == {(0, 1, 3), (2,)}


def test_search_sql(spark):
    assert difference(queries.op13_presence_masks(spark, SMALL), oracle_connection(SMALL), queries.OP13_SQL) is None
