"""Replacing personal data and secrets by keyed, type-consistent surrogates.

Detected entities keep their format: punctuation, length, letter case, script, country
code, top-level domain and title stay, and check digits stay right or wrong as they were.
Everything else passes through a keyed permutation of the characters of each class (digits,
vowels, consonants, hexadecimal digits) over the entity's own length. Equal entities get
equal surrogates in all documents, in any letter case. A given name becomes another one of
its gender and script.

Persons are found after a title. Each part of a name, given name or surname, has a surrogate
of its own, so that ``Mrs. Anna Miller`` and ``Mrs. Miller`` stay related. Parts that a titled
mention establishes are replaced in the rest of that document without a title too, capitalised
or in capitals. Of a name of several words the first is the given name; a single word is a
surname unless the document has it as a given name of that gender.

A permutation cannot make two entities equal, but names drawn from lists can, and a surrogate
can hit an entity that really occurs. So all distinct entities are listed first, by a Spark
aggregation, and a surrogate that another entity has already, that occurs as an entity (given
names aside, which the surname tells apart), or that changes nothing is drawn again with the
next attempt number, until none is left. Only
attempts beyond the first have to travel to the documents that hold those entities.

Defined results: null stays null, a text without entities stays as it is. Overlapping matches
go to the one that starts first, then to the kind listed first. Rows that repeat get equal
results. Other columns stay; ``n_entities`` replaces a column of that name.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import blake2b

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from milepost.operators.windows import write_once

ROUNDS = 8
PATIENCE = 6

# Kinds of entities in order of precedence. The group ``v`` is what gets
# replaced; without it, the whole match.
PATTERNS = {
    "secret": r"(?i:\b(?:token|secret|password|passwd|api[_-]?key|access[_-]?key|key)\b\"?\s*[:=]\s*[\"']?)(?P<v>[A-Za-z0-9+/_\-]{12,})",
    "hash": r"(?<![0-9A-Za-z])(?:[0-9a-f]{32,}|[0-9A-F]{32,})(?![0-9A-Za-z])",
    "email": r"(?<![\w.%+\-@])[\w.%+\-]+@(?:[A-Za-z0-9\-]+\.)+[A-Za-z]{2,}(?![\w\-])",
    "ip": r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)\.){3}(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)(?!\.?\d)",
    "iban": r"(?<![0-9A-Za-z])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,4})?(?![0-9A-Za-z])",
    "phone": r"(?<![\w+])\+\d{1,3}[ .\-]?(?:\(\d{1,4}\)[ .\-]?)?\d{2,4}(?:[ .\-]?\d{2,4}){1,4}(?!\w)|(?<!\w)\(\d{3}\) ?\d{3}[ .\-]\d{4}(?!\w)|(?<![\w.\-])\d{3}[.\-]\d{3}[.\-]\d{4}(?![\w\-])",
    "ssn": r"(?<![\w\-])\d{3}-\d{2}-\d{4}(?![\w\-])",
    "card": r"(?<![\w.\-])\d(?:[ \-]?\d){12,18}(?![\w\-])",
    "person": r"(?<!\w)(?:(?P<female>Mrs\.?|Ms\.?|Miss|Frau|Mme|Madame|Sra\.?|Señora|Doña|г-жа|госпожа)|(?P<male>Mr\.?|Herr|Monsieur|Sr\.?|Señor|Don|г-н|господин)) (?P<v>[A-ZÀ-ÖØ-ÞА-ЯЁ][a-zß-öø-ÿа-яё]+(?:[ \-][A-ZÀ-ÖØ-ÞА-ЯЁ][a-zß-öø-ÿа-яё]+){0,2})(?!\w)",
}
# Given names by gender and script.
GIVEN = {
    ("female", "latin"): "Anna Maria Laura Julia Sarah Emma Clara Helena Sofia Paula Nora Alice Irene Lucia Marta Rosa Teresa Victoria Camille Elise".split(),
    ("male", "latin"): "Thomas Martin Daniel Peter Lucas Simon Robert Victor Hugo Oscar Felix Anton Bruno Marco Pablo David Julien Stefan Walter Adrian".split(),
    ("female", "cyrillic"): "Анна Мария Ольга Елена Ирина Татьяна Наталья Светлана Юлия Дарья".split(),
    ("male", "cyrillic"): "Иван Пётр Сергей Андрей Алексей Дмитрий Николай Михаил Павел Егор".split(),
}
# Classes of letters that replace each other.
CLASSES = ["0123456789", "aeiouy", "bcdfghjklmnpqrstvwxz", "àâäáãåæéèêëíìîïóòôöõøúùûü", "çñß", "аеёиоуыэюя", "бвгджзйклмнпрстфхцчшщ"]
HEX = "0123456789abcdef"
# Fixed value: kinds of name parts.
NAMES = ("given-female", "given-male", "surname")
# Fixed value: a digit as any version of Unicode counts it, unassigned characters among them.
DIGIT = r"[\p{Nd}\p{Cn}]"
# Fixed value: what a text with an entity holds, by kinds; every match of PATTERNS passes.
CANDIDATE = "|".join([
    r"(?iu:token|secret|passw|key)",
    r"[0-9a-fA-F]{32}",
    r"@",
    rf"{DIGIT}\.{DIGIT}{{1,3}}\.{DIGIT}{{1,3}}\.{DIGIT}",  # ip
    rf"[A-Z]{{2}}{DIGIT}{{2}}",  # iban
    rf"\+{DIGIT}",  # phone with a country code
    rf"{DIGIT}(?:[ .\-]?{DIGIT}){{6}}",  # other phones, ssn, card
    r"(?:Mrs|Ms|Mr|Miss|Frau|Herr|Mme|Madame|Monsieur|Sra|Sr|Señora|Señor|Don|Doña|г-жа|г-н|госпожа|господин)\.? ",
])


class Surrogates:
    """Finds entities and makes surrogates; holds nothing but the key."""

    def __init__(self, key: bytes):
        self.key = key
        self.pattern = re.compile("|".join(f"(?P<{kind}>{self._own(kind, p)})" for kind, p in PATTERNS.items()))
        self.iban = re.compile(PATTERNS["iban"])

    @staticmethod
    def _own(kind: str, pattern: str) -> str:
        return pattern.replace("(?P<v>", f"(?P<{kind}_v>")

    def find(self, text: str) -> Iterator[tuple[int, int, str, str]]:
        """Start, end, kind and spelling of each entity; of persons also gender."""
        at = 0
        while m := self.pattern.search(text, at):
            kind = m.lastgroup if m.lastgroup in PATTERNS else next(k for k in PATTERNS if m.group(k) is not None)
            part = f"{kind}_v" if f"{kind}_v" in m.re.groupindex else kind
            start, end = m.span(part)
            at = m.end()
            if kind == "iban":
                end = self._iban_end(text, start, end)
                at = end or start + 1
                if not end:
                    continue
            if kind == "person":
                kind = "female" if m.group("female") else "male"
            yield start, end, kind, text[start:end]

    def _iban_end(self, text: str, start: int, end: int) -> int:
        """End of the longest number with a right check; words that follow may look like its groups."""
        while end > start:
            if self.iban.fullmatch(text, start, end) and _iban_holds(text[start:end]):
                return end
            end = text.rfind(" ", start, end)
        return 0

    def mentions(self, text: str) -> list[list[tuple[int, int, str, str]]]:
        """Pieces of each mention, as ``find`` gives them: name parts of persons, else one."""
        found = list(self.find(text))
        people = [_name_parts(start, value) for start, _, kind, value in found if kind in ("female", "male")]
        if not people:
            return [[piece] for piece in found]
        given, surnames = {}, set()
        for (_, _, kind, _), (first, rest) in zip((f for f in found if f[2] in ("female", "male")), people):
            for _, _, word in first:
                given.setdefault((word.lower(), kind), None)
            surnames |= {word.lower() for _, _, word in rest} if first else set()
        out, named = [], iter(people)
        for start, end, kind, value in found:
            if kind not in ("female", "male"):
                out.append([(start, end, kind, value)])
                continue
            first, rest = next(named)
            if not first and len(rest) == 1 and (rest[0][2].lower(), kind) in given and rest[0][2].lower() not in surnames:
                first, rest = rest, []
            out.append([(s, e, f"given-{kind}", w) for s, e, w in first] + [(s, e, "surname", w) for s, e, w in rest])
        surnames = {w.lower() for pieces in out for _, _, kind, w in pieces if kind == "surname"}
        genders = {}
        for word, kind in given:
            genders.setdefault(word, kind)
        words = sorted({v for _, _, _, w in (p for pieces in out for p in pieces if p[2] in NAMES) for v in (w, w.upper())}, key=lambda w: (-len(w), w))
        one = f"(?:{'|'.join(map(re.escape, words))})(?!\\w)"
        untitled = re.compile(rf"(?<!\w){one}(?:[ \-]{one})*")
        at = 0
        for start, end, _, _ in [*found, (len(text), len(text), "", "")]:
            for m in untitled.finditer(text, at, start):
                pieces = [(m.start() + w.start(), m.start() + w.end(), w.group()) for w in re.finditer(r"[^ \-]+", m.group())]
                out.append([(s, e, self._role(w.lower(), i == 0, len(pieces), genders, surnames), w) for i, (s, e, w) in enumerate(pieces)])
            at = end
        return sorted(out)

    @staticmethod
    def _role(word: str, leads: bool, size: int, genders: dict[str, str], surnames: set[str]) -> str:
        if word in genders and (word not in surnames or (leads and size > 1)):
            return f"given-{genders[word]}"
        return "surname"

    def held(self, text: str) -> set[tuple[str, str]]:
        """Kind and entity of all that a text holds."""
        return {(kind, value.lower()) for pieces in self.mentions(text) for _, _, kind, value in pieces}

    def _number(self, tweak: str, round_: int, value: int, size: int) -> int:
        digest = blake2b(f"{tweak}|{round_}|{value}".encode(), key=self.key[:64], digest_size=32).digest()
        return int.from_bytes(digest, "big") % size

    def permute(self, digits: list[int], sizes: list[int], tweak: str) -> list[int]:
        """Keyed permutation of mixed-radix numbers: a Feistel network on two halves."""
        if len(digits) < 2:
            if not digits:
                return []
            order = sorted(range(sizes[0]), key=lambda x: (self._number(tweak, 0, x, 1 << 128), x))
            return [order[digits[0]]]
        half = len(digits) // 2
        left_size, right_size = _size(sizes[:half]), _size(sizes[half:])
        left, right = _pack(digits[:half], sizes[:half]), _pack(digits[half:], sizes[half:])
        for r in range(0, ROUNDS, 2):
            left = (left + self._number(tweak, r, right, left_size)) % left_size
            right = (right + self._number(tweak, r + 1, left, right_size)) % right_size
        return _unpack(left, sizes[:half]) + _unpack(right, sizes[half:])

    def scramble(self, value: str, tweak: str, fixed: range | list[int] = (), hexadecimal: bool = False) -> str:
        """Permute the characters of each class over their places; case and the rest stay."""
        low, keep = value.lower(), set(fixed)
        if len(low) != len(value):
            low = value
        classes = [HEX] if hexadecimal else CLASSES
        places, digits, sizes, alphabets = [], [], [], []
        for i, c in enumerate(low):
            alphabet = next((a for a in classes if c in a), None)
            if alphabet and i not in keep:
                places.append(i)
                digits.append(alphabet.index(c))
                sizes.append(len(alphabet))
                alphabets.append(alphabet)
        held = set(places)
        form = "".join("#" if i in held else c for i, c in enumerate(low))
        out = list(value)
        for i, d, a in zip(places, self.permute(digits, sizes, f"{tweak}|{form}|{sizes}"), alphabets):
            out[i] = a[d].upper() if value[i].isupper() and len(a[d].upper()) == 1 else a[d]
        return "".join(out)

    def replace(self, kind: str, value: str, attempt: int = 0) -> str:
        """Surrogate of an entity; the attempt number changes the permutation.

        A format with few or no values besides the entity's own cannot keep all entities
        distinct. From attempt ``PATIENCE`` on the surrogate grows by a character each time,
        a given name by another one of the list.
        """
        if kind in ("female", "male"):
            first, rest = _name_parts(0, value)
            at, out = 0, ""
            for start, end, role, word in [(s, e, f"given-{kind}", w) for s, e, w in first] + [(s, e, "surname", w) for s, e, w in rest]:
                out, at = out + value[at:start] + self.replace(role, word, attempt), end
            return out
        if kind.startswith("given-"):
            return self._given(kind, value, attempt)
        drawn = self._draw(kind, value, attempt)
        more = "".join(
            CLASSES[(2 - i % 2) if kind in ("surname", "email") else 0][self._number(f"{kind}|{value.lower()}|{attempt}", i, 0, 5)]
            for i in range(attempt - PATIENCE + 1)
        )
        return more + drawn if kind == "email" else drawn + more

    def _draw(self, kind: str, value: str, attempt: int) -> str:
        tweak = f"{kind}|{attempt}"
        if kind == "ip":
            whole = self.permute([int(x) for x in value.split(".")], [256] * 4, tweak)
            return ".".join(map(str, whole))
        if kind == "card":
            return self._card(value, tweak)
        if kind == "iban":
            body = self.scramble(value, tweak, range(4))
            return f"{value[:2]}{_iban_check(body):02d}{body[4:]}"
        if kind == "email":
            return self.scramble(value, tweak, range(value.rindex("."), len(value)))
        if kind == "phone" and value[0] == "+":
            return self.scramble(value, tweak, range(re.match(r"\+\d{1,3}(?=\D)|\+\d", value).end()))
        pure = kind in ("hash", "secret") and re.fullmatch(r"[0-9a-f]+|[0-9A-F]+", value)
        return self.scramble(value, tweak, hexadecimal=bool(pure))

    def _card(self, value: str, tweak: str) -> str:
        last = len(value) - 1
        changed = self.scramble(value, tweak, [last])
        shift = (int(value[last]) - _luhn(value[:last])) % 10
        return changed[:last] + str((_luhn(changed[:last]) + shift) % 10)

    def _given(self, kind: str, value: str, attempt: int) -> str:
        script = "cyrillic" if re.search("[А-Яа-яЁё]", value) else "latin"
        pool, number = GIVEN[kind.removeprefix("given-"), script], int.from_bytes(value.lower().encode(), "big")
        drawn = "".join(pool[self._number(f"{kind}|{attempt}", i, number, len(pool))] for i in range(max(1, attempt - PATIENCE + 2)))
        return drawn.upper() if value.isupper() else drawn.capitalize()


def _name_parts(start: int, value: str) -> tuple[list[tuple[int, int, str]], list[tuple[int, int, str]]]:
    """Given names and surnames of a titled name, with their places in the text."""
    parts = [(start + m.start(), start + m.end(), m.group()) for m in re.finditer(r"[^ \-]+", value)]
    space = value.find(" ")
    return [p for p in parts if p[1] <= start + space], [p for p in parts if p[0] > start + space]


def _size(sizes: list[int]) -> int:
    out = 1
    for s in sizes:
        out *= s
    return out


def _pack(digits: list[int], sizes: list[int]) -> int:
    out = 0
    for d, s in zip(digits, sizes):
        out = out * s + d
    return out


def _unpack(value: int, sizes: list[int]) -> list[int]:
    out = []
    for s in reversed(sizes):
        value, d = divmod(value, s)
        out.append(d)
    return out[::-1]


def _luhn(digits: str) -> int:
    """Check digit of a number without it."""
    total = 0
    for i, c in enumerate(reversed([int(c) for c in digits if c.isdigit()])):
        total += c if i % 2 else sum(divmod(2 * c, 10))
    return -total % 10


def _iban_number(value: str) -> int:
    plain = value.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4]))


def _iban_holds(value: str) -> bool:
    return _iban_number(value) % 97 == 1


def _iban_check(value: str) -> int:
    return 98 - _iban_number(value[:2] + "00" + value[4:]) % 97


def _candidates() -> Column:
    """The text where it may hold entities, else null."""
    return F.when(F.col("text").rlike(CANDIDATE), F.col("text"))


def entities(docs: DataFrame, key: bytes) -> DataFrame:
    """Distinct ``kind, entity`` of all texts; spellings that differ in case only are one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Surrogates(key)
        for batch in batches:
            found = {piece for text in batch.column(0).to_pylist() for piece in finder.held(text)}
            yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in found], pa.string()), pa.array([v for _, v in found], pa.string())], names=["kind", "entity"])

    return docs.select(_candidates().alias("text")).where(F.col("text").isNotNull()).mapInArrow(run, "kind string, entity string").distinct()


def attempts(found: DataFrame, key: bytes) -> DataFrame:
    """``kind, entity, attempt`` of the entities whose first surrogate will not do."""

    def draw(rows: DataFrame) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            maker = Surrogates(key)
            for batch in batches:
                made = [maker.replace(k, v, a).lower() for k, v, a in zip(*(batch.column(c).to_pylist() for c in ("kind", "entity", "attempt")))]
                yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(made, pa.string())], names=["kind", "entity", "attempt", "surrogate"])
        return rows.select("kind", "entity", "attempt").mapInArrow(run, "kind string, entity string, attempt int, surrogate string")

    found = write_once(found, "surrogate-entities")
    known = write_once(draw(found.withColumn("attempt", F.lit(0))), "surrogates")
    while True:
        # of the entities that share a surrogate the least keeps it; an entity drawn
        # later gives way to one that has not moved
        keeper = known.groupBy("kind", "surrogate").agg(F.min(F.struct("attempt", "entity")).alias("keeper"), F.count(F.lit(1)).alias("sharing"))
        taken = found.select("kind", F.col("entity").alias("surrogate"), F.lit(True).alias("occurs"))
        judged = known.join(keeper, ["kind", "surrogate"]).join(taken, ["kind", "surrogate"], "left")
        occurs = F.when(F.col("kind").startswith("given-"), F.col("surrogate") == F.col("entity")).otherwise(F.coalesce("occurs", F.lit(False)))
        moves = occurs | ((F.col("sharing") > 1) & (F.col("keeper.entity") != F.col("entity")))
        judged = write_once(judged.select("kind", "entity", "attempt", "surrogate", moves.alias("moves")), "surrogates")
        known = judged.drop("moves")
        if judged.where("moves").isEmpty():
            return known.where(F.col("attempt") > 0).select("kind", "entity", "attempt")
        again = draw(judged.where("moves").withColumn("attempt", F.col("attempt") + 1))
        known = write_once(judged.where(~F.col("moves")).drop("moves").unionByName(again), "surrogates")


def _per_document(docs: DataFrame, later: DataFrame, key: bytes) -> DataFrame:
    """``_text_key, _later``: for each text that holds some, its entities drawn again."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Surrogates(key)
        for batch in batches:
            rows = [(t, k, v) for t, text in zip(*(batch.column(i).to_pylist() for i in (0, 1))) for k, v in finder.held(text)]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.string()) for i in range(3)], names=["_text_key", "kind", "entity"])

    held = docs.select(F.sha2("text", 256).alias("_text_key"), _candidates().alias("text")).where(F.col("text").isNotNull())
    held = held.mapInArrow(run, "_text_key string, kind string, entity string").distinct()
    pair = F.struct(F.concat_ws("|", "kind", "entity").alias("name"), "attempt")
    return held.join(later, ["kind", "entity"]).groupBy("_text_key").agg(F.map_from_entries(F.collect_list(pair)).alias("_later"))


def replace_private(docs: DataFrame, key: bytes) -> DataFrame:
    """``docs`` with surrogates in ``text``, and ``n_entities``, the number replaced."""
    later = attempts(entities(docs, key), key)
    columns = [c for c in docs.columns if c != "n_entities"]
    docs = docs.select(*columns)
    if later.isEmpty():
        rows = docs.withColumn("_later", F.lit(None).cast("map<string,int>"))
    else:
        rows = docs.withColumn("_text_key", F.sha2("text", 256)).join(_per_document(docs, later, key), "_text_key", "left").drop("_text_key")

    @F.pandas_udf("text string, n int")
    def change(texts: pd.Series, again: pd.Series) -> pd.DataFrame:
        maker, out, counts = Surrogates(key), [], []
        for text, moved in zip(texts, again):
            if text is None:
                out.append(None)
                counts.append(0)
                continue
            parts, at, n = [], 0, 0
            for pieces in maker.mentions(text):
                for start, end, kind, value in pieces:
                    attempt = (moved or {}).get(f"{kind}|{value.lower()}", 0)
                    parts += [text[at:start], maker.replace(kind, value, attempt)]
                    at = end
                n += 1
            out.append("".join([*parts, text[at:]]))
            counts.append(n)
        return pd.DataFrame({"text": pd.Series(out, dtype=object), "n": pd.Series(counts, dtype="int32")})

    done = rows.withColumn("_changed", change(_candidates(), F.col("_later")))
    text = F.coalesce("_changed.text", "text").alias("text")
    return done.select(*[text if c == "text" else F.col(c) for c in columns], F.coalesce("_changed.n", F.lit(0)).alias("n_entities"))
