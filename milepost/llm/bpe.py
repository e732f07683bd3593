"""Byte-level BPE encoding by a depth-first walk over the trie of distinct words.

The encoding of a text prefix is known from its last token and the prefix before it: of all
vocabulary entries that end the prefix exactly one is compatible with the last token of
what stands before. So a trie node needs only its last token. Sorting the distinct words of
a batch gives their trie in depth-first order; a prefix that neighbouring words share is one
node and encoded once. The nodes of a level are walked together, as arrays; an automaton over
the vocabulary tells the entries that end a prefix. Words beyond ``LEVELS`` bytes are walked
byte by byte.

Two neighbouring tokens are compatible if byte pair merging, with all merges by rank and
then from left to right, would never have merged anything across their boundary. Only the
right edge of the first and the left edge of the second token matter for that, and both
change at known merge ranks.

Defined results: a null text is encoded as an empty one, without tokens. Text that spells an
added token becomes that token. Ids are those of the ``tokenizers`` library without special
tokens added, and decoding keeps special tokens. Vocabularies of any other kind than plain
byte-level BPE raise ``ValueError``. Unknown or null ids in ``decode`` raise as well.
"""

from __future__ import annotations

import json
import re
import struct
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from milepost.llm.arrays import U64, mix, ranges, text_runs

# fixed value: the pattern by which byte-level BPE cuts a text into words
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# the same on ASCII alone, for which the standard library's faster matcher will do
ASCII_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\t-\r A-Za-z0-9]+|[\t-\r ]+(?![^\t-\r ])|[\t-\r ]+"
NEVER = 1 << 60
CACHED_WORDS, CACHED_EDGES, PAIR_SLOTS = 200_000, 30_000, 1 << 20
TRIE_BYTES = 2 << 20
LEVELS = 128


def _bytes_by_character() -> dict[str, int]:
    """The printable character that stands for each byte in vocabulary files."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Vocabulary:
    """Tokens, merges and added tokens of a byte-level BPE file; plain data, so it can be broadcast."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, cutter = spec["model"], spec.get("pre_tokenizer") or {}
        plain = (
            model["type"] == "BPE"
            and cutter.get("type") == "ByteLevel"
            and cutter.get("use_regex", True)
            and not cutter.get("add_prefix_space")
            and not spec.get("normalizer")
            and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
        )
        if not plain:
            raise ValueError(f"{path}: not a plain byte-level BPE vocabulary")
        to_byte = _bytes_by_character()
        self.added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.ids = {bytes(to_byte[c] for c in t): i for t, i in model["vocab"].items() if t not in self.added}
        self.parts: dict[int, tuple[int, int, int]] = {}
        self.ranks: dict[tuple[int, int], int] = {}
        for rank, merge in enumerate(model["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            a, b = model["vocab"][left], model["vocab"][right]
            self.ranks.setdefault((a, b), rank)
            self.parts.setdefault(model["vocab"][left + right], (a, b, rank))

    def token_bytes(self) -> dict[int, bytes]:
        return {i: b for b, i in self.ids.items()} | {i: t.encode() for t, i in self.added.items()}

    def whole_ids(self) -> dict[bytes, int]:
        """Without the tokens that no text is ever encoded to."""
        pairs = Pairs(self.parts, self.ranks)
        return {b: i for b, i in self.ids.items() if pairs.whole(i)}


class Pairs:
    """Which tokens may stand next to each other."""

    def __init__(self, parts: dict, ranks: dict):
        self.parts, self.ranks = parts, ranks
        self.edges: dict[tuple[int, bool], list[tuple[int, int]]] = {}
        self.reachable: dict[int, bool] = {}

    def _edge(self, token: int, right: bool) -> list[tuple[int, int]]:
        """What stands at one edge of a token while it is built, and until which rank."""
        key = (token, right)
        if key not in self.edges:
            if len(self.edges) > CACHED_EDGES:
                self.edges.clear()
            steps, until = [], NEVER
            while True:
                steps.append((token, until))
                if token not in self.parts:
                    break
                a, b, until = self.parts[token]
                token = b if right else a
            self.edges[key] = steps[::-1]
        return self.edges[key]

    def apart(self, a: int, b: int) -> bool:
        """Both tokens get finished before anything merges across their boundary."""
        left, right, i, j = self._edge(a, True), self._edge(b, False), 0, 0
        while True:
            (x, x_until), (y, y_until) = left[i], right[j]
            if x_until == NEVER and y_until == NEVER:
                return True
            rank = self.ranks.get((x, y), NEVER)
            if rank < x_until and rank <= y_until:
                return False
            if x_until <= y_until:
                i += 1
            else:
                j += 1

    def compatible(self, a: int, b: int) -> bool:
        return (a, b) not in self.ranks and self.apart(a, b)

    def whole(self, token: int) -> bool:
        """The token is the encoding of its own bytes."""
        known = self.reachable.get(token)
        if known is None:
            known = True
            if token in self.parts:
                a, b, _ = self.parts[token]
                known = self.whole(a) and self.whole(b) and self.apart(a, b)
            self.reachable[token] = known
        return known


class Suffixes:
    """Which tokens end a prefix, longest first, as an automaton over the bytes of the tokens.

    A state is the longest end of what was read that some token starts with. Plain arrays, so
    that it can be broadcast.
    """

    def __init__(self, ids: dict[bytes, int]):
        states, heads = {b"": 0}, [b""]
        for token in sorted(ids, key=len):
            for end in range(1, len(token) + 1):
                if token[:end] not in states:
                    states[token[:end]] = len(heads)
                    heads.append(token[:end])
        size = max(ids.values(), default=0) + 1
        self.sizes, self.shorter = np.zeros(size, np.int64), np.full(size, -1, np.int64)
        self.fail, self.longest = np.zeros(len(heads), np.int64), np.full(len(heads), -1, np.int64)
        for head in sorted(states, key=len)[1:]:
            state, end = states[head], 1
            while head[end:] not in states:
                end += 1
            rest = self.fail[state] = states[head[end:]]
            token, self.longest[state] = ids.get(head), self.longest[rest]
            if token is not None:
                self.sizes[token], self.shorter[token], self.longest[state] = len(head), self.longest[rest], token
        steps = sorted((states[h[:-1]] << 8 | h[-1], states[h]) for h in heads[1:])
        self.steps, self.targets = np.array([*steps, (NEVER, 0)], np.int64).T.copy()

    def after(self, states: np.ndarray, read: np.ndarray) -> np.ndarray:
        """The state after one more byte, for each state."""
        out, left, now = np.zeros(len(states), np.int64), np.arange(len(states)), states
        while len(left):
            step = now << 8 | read[left]
            at = np.searchsorted(self.steps, step)
            met = self.steps[at] == step
            out[left[met]] = self.targets[at[met]]
            more = ~met & (now > 0)
            left, now = left[more], self.fail[now[more]]
        return out


class Encoder:
    """Encodes distinct words; keeps what it has learned about token pairs."""

    def __init__(self, suffixes: Suffixes, parts: dict, ranks: dict):
        self.suffixes, self.pairs = suffixes, Pairs(parts, ranks)
        self.known, self.fits = np.full(PAIR_SLOTS, -1, np.int64), np.zeros(PAIR_SLOTS, bool)

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """``Pairs.compatible`` of many pairs; a pair may push another one out of its slot."""
        pairs = a << 24 | b
        slots = (mix(pairs.astype(U64)) & U64(PAIR_SLOTS - 1)).astype(np.int64)
        out, new = self.fits[slots], np.flatnonzero(self.known[slots] != pairs)
        if len(new):
            distinct, first, again = np.unique(pairs[new], return_index=True, return_inverse=True)
            found = np.array([self.pairs.compatible(p >> 24, p & 0xFFFFFF) for p in distinct.tolist()], bool)
            out[new] = found[again]
            slots, kept = np.unique(slots[new[first]], return_index=True)
            self.known[slots], self.fits[slots] = distinct[kept], found[kept]
        return out

    def encode(self, words: list[bytes]) -> dict[bytes, bytes]:
        """Token ids of each word, as packed 32-bit numbers."""
        out: dict[bytes, bytes] = {}
        words = sorted(words)
        for some in ([w for w in words if len(w) <= LEVELS], [w for w in words if len(w) > LEVELS]):
            if some:
                tokens, ends = self._tokens(some) if len(some[0]) <= LEVELS else self._tokens_of_long(some)
                packed, ends = tokens.astype("<i4").tobytes(), (4 * ends).tolist()
                out.update(zip(some, map(packed.__getitem__, map(slice, [0, *ends], ends))))
        return out

    def _tokens(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of sorted words, and where those of each word end; all nodes of a trie level at a time."""
        suffixes, sizes = self.suffixes, np.fromiter(map(len, words), np.int64, len(words))
        data = np.frombuffer(b"".join(words), np.uint8).astype(np.int64)
        begin = np.cumsum(sizes) - sizes
        first = begin + np.arange(len(words))  # a place for the empty prefix of each word, too
        last = np.full(len(data) + len(words), -1, np.int64)
        live, alike, state, depth = np.arange(len(words)), np.ones(len(words), bool), np.zeros(len(words), np.int64), 0
        while True:
            more = sizes[live] > depth
            live, alike, state = live[more], alike[more], state[more]
            if not len(live):
                break
            read = data[begin[live] + depth]
            depth += 1
            # a word is at the node of the word before it while they share their prefix
            alike[1:] &= (live[1:] - live[:-1] == 1) & (read[1:] == read[:-1])
            alike[0] = False
            heads = np.flatnonzero(~alike)
            states = suffixes.after(state[heads], read[heads])
            tokens, at, left = suffixes.longest[states], first[live[heads]] + depth, np.arange(len(heads))
            while len(left):
                token = tokens[left]
                if token.min() < 0:
                    word = words[live[heads[left[token.argmin()]]]]
                    raise ValueError(f"no token ends {word[:depth]!r}")
                size = suffixes.sizes[token]
                inner = np.flatnonzero(size < depth)
                failed = inner[~self.compatible(last[(at[left] - size)[inner]], token[inner])]
                left = left[failed]
                tokens[left] = suffixes.shorter[token[failed]]
            node = np.cumsum(~alike) - 1
            last[first[live] + depth], state = tokens[node], states[node]
        steps, live, at = [], np.arange(len(words)), sizes.copy()
        while len(live):
            token = last[first[live] + at[live]]
            steps.append((live, token))
            at[live] -= suffixes.sizes[token]
            live = live[at[live] > 0]
        ends = np.cumsum(np.bincount(np.concatenate([x for x, _ in steps]), minlength=len(words)))
        out = np.empty(ends[-1], np.int64)
        for i, (live, token) in enumerate(steps):
            out[ends[live] - 1 - i] = token
        return out, ends

    def _tokens_of_long(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """As ``_tokens``, depth first, byte by byte: long words are too few to fill trie levels."""
        suffixes, known, out, ends = self.suffixes, {}, [], []
        longest, sizes, shorter = suffixes.longest, suffixes.sizes, suffixes.shorter
        steps = dict(zip(suffixes.steps[:-1].tolist(), suffixes.targets.tolist()))
        tokens, lengths, states, before = [-1], [0], [0], b""
        for word in words:
            shared, most = 0, min(len(word), len(before))
            while shared < most and word[shared] == before[shared]:
                shared += 1
            del tokens[shared + 1 :], lengths[shared + 1 :], states[shared + 1 :]
            for end in range(shared + 1, len(word) + 1):
                now, read = states[end - 1], word[end - 1]
                while (state := steps.get(now << 8 | read)) is None and now:
                    now = int(suffixes.fail[now])
                token = int(longest[state or 0])
                while token >= 0:
                    size = int(sizes[token])
                    pair = (tokens[end - size], token)
                    if size < end and pair not in known:
                        known[pair] = self.pairs.compatible(*pair)
                    if size == end or known[pair]:
                        break
                    token = int(shorter[token])
                else:
                    raise ValueError(f"no token ends {word[:end]!r}")
                tokens.append(token)
                lengths.append(size)
                states.append(state or 0)
            found, at = [], len(word)
            while at:
                found.append(tokens[at])
                at -= lengths[at]
            out += found[::-1]
            ends.append(len(out))
            before = word
        return np.array(out, np.int64), np.array(ends, np.int64)


class Spelling:
    """Bytes of tokens, by id."""

    def __init__(self, token_bytes: dict[int, bytes]):
        size = max(token_bytes, default=0) + 1
        self.sizes, self.starts = np.zeros(size, np.int64), np.zeros(size, np.int64)
        self.data = np.frombuffer(b"".join(token_bytes.values()), np.uint8)
        ids = np.fromiter(token_bytes, np.int64, len(token_bytes))
        self.sizes[ids] = np.fromiter(map(len, token_bytes.values()), np.int64, len(ids))
        self.starts[ids] = np.cumsum(self.sizes[ids]) - self.sizes[ids]

    def decode(self, ids: np.ndarray, ends: np.ndarray) -> list[str]:
        """Text of the ids of each row, given where the rows end."""
        sizes = self.sizes[ids]
        data = memoryview(self.data[ranges(self.starts[ids], sizes)])
        ends = np.concatenate(([0], np.cumsum(sizes)))[ends].tolist()
        return [str(data[a:b], "utf-8", "replace") for a, b in zip([0, *ends], ends)]


def encode_texts(docs: DataFrame, vocabulary: Vocabulary, text: str = "text") -> DataFrame:
    """``docs`` with ``ids`` (array of int) and ``decoded``, the text decoded from them.

    Columns of these names are replaced. Words are collected over about ``TRIE_BYTES`` of text
    at a time; encodings of words stay in a bounded cache of the task.
    """
    keep = [c for c in docs.columns if c not in ("ids", "decoded")]
    schema = T.StructType([*docs.select(*keep).schema.fields, *T.StructType.fromDDL("ids array<int>, decoded string").fields])
    shared = docs.sparkSession.sparkContext.broadcast((Suffixes(vocabulary.whole_ids()), vocabulary.parts, vocabulary.ranks, vocabulary.added, Spelling(vocabulary.token_bytes())))
    from pyspark.sql import functions as F

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        suffixes, parts, ranks, added, spelling = shared.value
        encoder = Encoder(suffixes, parts, ranks)
        of_any, of_ascii = regex.compile(WORDS).findall, re.compile(ASCII_WORDS).findall
        specials = re.compile("|".join(map(re.escape, sorted(added, key=len, reverse=True)))) if added else None
        known: dict[str, bytes] = {}  # ids of a word as packed 32-bit numbers

        def words_of(value: str) -> list[str]:
            find = of_ascii if value.isascii() else of_any
            if specials is None or not specials.search(value):
                return find(value)
            found, at = [], 0
            for m in specials.finditer(value):
                found += [*find(value[at : m.start()]), m[0]]
                at = m.end()
            return [*found, *find(value[at:])]

        for batch in batches:
            column = batch.column(len(keep))
            for first, last, *_ in text_runs(column, TRIE_BYTES):
                cut = [words_of(v or "") for v in column.slice(first, last - first).to_pylist()]
                if len(known) > CACHED_WORDS:
                    known.clear()
                for t, i in added.items():
                    known[t] = struct.pack("<i", i)
                new = {w.encode(): w for w in set(chain.from_iterable(cut)).difference(known)}
                for word, tokens in encoder.encode(list(new)).items():
                    known[new[word]] = tokens
                rows = [b"".join(map(known.__getitem__, found)) for found in cut]
                del cut
                ids, ends = np.frombuffer(b"".join(rows), "<i4"), np.cumsum([len(row) // 4 for row in rows])
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], ends)).astype(np.int32)), pa.array(ids))
                decoded = spelling.decode(ids, ends)
                kept = [c.slice(first, last - first) for c in batch.columns[: len(keep)]]
                yield pa.RecordBatch.from_arrays([*kept, lists, pa.array(decoded, pa.string())], names=[*keep, "ids", "decoded"])

    return docs.select(*keep, F.col(text).alias("_text")).mapInArrow(run, schema)


def decode_ids(rows: DataFrame, vocabulary: Vocabulary, ids: str = "ids") -> DataFrame:
    """``rows`` with ``decoded``, the text of the token ids; null ids give null."""
    keep = [c for c in rows.columns if c != "decoded"]
    schema = T.StructType([*rows.select(*keep).schema.fields, T.StructField("decoded", T.StringType())])
    shared = rows.sparkSession.sparkContext.broadcast(vocabulary.token_bytes())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [
                None if row is None else b"".join([shared.value[i] for i in row]).decode("utf-8", "replace")
                for row in batch.column(batch.schema.get_field_index(ids)).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*keep, "decoded"])

    return rows.select(*keep).mapInArrow(run, schema)
