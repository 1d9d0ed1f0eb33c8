"""Operator 7: personal data replaced by surrogates.

Detected entities (e-mail, phone, card, IBAN, IP address, access key, social security number, person) get keyed replacements
of their own kind: digits stay digits, letters stay letters of the same case and script, vowels and consonants keep their
places, separators stay; first names become first names of the same gender.  A replacement is a keyed permutation
of the entities of one kind and shape (a Feistel network over their number), so different entities stay different,
and equal ones, however written (case, separators, a surname alone), stay equal.

Collision checks run over the whole table of different entities: replacements that meet, or that equal some other entity
of the data, are permuted again until none does.  These exceptions reach their texts by a join.

Defined results: null text counts as empty; a text without entities is returned unchanged; of overlapping entities the first,
then the longest, counts; repeated rows are rewritten each; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saleslake.llm.common import text_of, written

# ---- fixed values -------------------------------------------------------------------------------------------------
#: Kinds of characters that are replaced within their kind; all others stay.
ALPHABETS = ["0123456789", "aeiou", "bcdfghjklmnpqrstvwxyz", "аеиоуыэюя", "бвгджзклмнпрстфхцчшщ", "αεηιουω", "βγδζθκλμνξπρστφχψ",
             "àáâãäåæèéêëìíîïòóôõöøùúûü", "çðñýþ", "йъь"]
FEMALE = ("Alice Amelia Anna Barbara Catherine Charlotte Claire Diana Elena Elizabeth Emily Emma Eva Grace Hannah Helen Irene Julia "
          "Karen Laura Linda Lisa Maria Martha Mary Monica Nina Olivia Patricia Paula Rachel Rebecca Rosa Sarah Sofia Susan "
          "Teresa Ursula Vera Victoria").split()
MALE = ("Adam Albert Alexander Andrew Anthony Arthur Benjamin Bernard Carlos Charles Christopher Daniel David Edward Eric Francis "
        "Frank George Henry Hugo James John Joseph Kevin Louis Martin Matthew Michael Nicholas Oliver Paul Peter Philip "
        "Richard Robert Samuel Stephen Thomas Victor William").split()
FEMALE_CYRILLIC = "Анна Вера Галина Дарья Елена Ирина Мария Наталья Ольга Светлана Татьяна Юлия".split()
MALE_CYRILLIC = "Алексей Андрей Борис Виктор Дмитрий Иван Михаил Николай Олег Павел Сергей Юрий".split()
TITLES = "Mr Mrs Ms Miss Dr Prof Herr Frau Madame Monsieur Señor Señora".split()
# -------------------------------------------------------------------------------------------------------------------

FIRST_NAMES = {name.lower(): group for group in (FEMALE, MALE, FEMALE_CYRILLIC, MALE_CYRILLIC) for name in group}
KIND_OF = {c: n for n, alphabet in enumerate(ALPHABETS) for c in alphabet}

NAME = r"[A-ZÀ-ÖØ-ÞΑ-ΩА-Я][a-zà-öø-ÿα-ωа-я]+(?:-[A-ZÀ-ÖØ-ÞΑ-ΩА-Я][a-zà-öø-ÿα-ωа-я]+)?"
OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
#: Kind, what a text must hold for it to occur, pattern.
PATTERNS = [
    ("email", "@", re.compile(r"[A-Za-z0-9][A-Za-z0-9._%+-]*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}")),
    ("ip", ".", re.compile(rf"(?<![\d.])(?:{OCTET}\.){{3}}{OCTET}(?!\.?\d)")),
    ("ssn", "-", re.compile(r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])")),
    ("phone", "", re.compile(r"(?<![\w.+])(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)|\d{3})[ .-]?\d{3}[ .-]\d{4}(?!\d)|(?<![\w.+])\+\d(?:[ .()-]{0,2}\d){7,14}(?!\d)")),
    ("card", "", re.compile(r"(?<![\w.-])\d(?:[ -]?\d){12,18}(?![\w-])")),
    ("iban", "", re.compile(r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?\b")),
    ("key", "", re.compile(r"\b(?:AKIA|ASIA)[0-9A-Z]{16}\b|\b(?:ghp_|sk-|xox[bp]-)[A-Za-z0-9]{20,}\b")),
]
FIRST = "|".join(sorted((n for g in (FEMALE, MALE, FEMALE_CYRILLIC, MALE_CYRILLIC) for n in g), key=len, reverse=True))
PERSON = re.compile(rf"\b(?:(?:{'|'.join(TITLES)})\.? (?P<titled>{NAME}(?: {NAME}){{0,2}})|(?P<named>(?:{FIRST})(?: {NAME}){{1,2}}))")
DIGIT = re.compile(r"\d")
#: From this round on, the replacement of an e-mail address that still collides gets longer.
WIDEN = 4


def canonical(kind: str, found: str) -> str:
    """The form in which mentions of one entity are equal."""
    if kind in ("phone", "card", "iban", "ssn"):
        digits = re.sub(r"[^0-9A-Za-z]", "", found)
        return digits[-10:] if kind == "phone" and len(digits) > 10 else digits
    return found if kind == "key" else found.lower()


def entities(text: str) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, canonical form) in text order, without overlaps.  A person's names are entities of their own."""
    found: list = []
    has_digit = DIGIT.search(text) is not None
    for kind, needs, pattern in PATTERNS:
        if needs in text and (has_digit or kind == "email"):
            found += [(m.start(), m.end(), kind) for m in pattern.finditer(text)]
    surnames = set()
    for m in PERSON.finditer(text):
        start, names = m.start("titled" if m["titled"] else "named"), (m["titled"] or m["named"]).split(" ")
        for name in names:
            found.append((start, start + len(name), "first name" if name.lower() in FIRST_NAMES else "name"))
            if name.lower() not in FIRST_NAMES:
                surnames.add(name)
            start += len(name) + 1
    if surnames:                                            # later mentions by the surname alone
        again = re.compile(r"\b(?:" + "|".join(map(re.escape, sorted(surnames, key=len, reverse=True))) + r")\b")
        found += [(m.start(), m.end(), "name") for m in again.finditer(text)]
    out: list = []
    for start, end, kind in sorted(found, key=lambda x: (x[0], -x[1], x[2])):
        if not out or start >= out[-1][1]:
            out.append((start, end, kind, canonical(kind, text[start:end])))
    return out


def permuted(number: int, size: int, key: bytes, tweak: str) -> int:
    """A keyed permutation of range(size): Feistel rounds over two halves, walked until inside the range."""
    return _walked(number, size, key, tweak, range(8))


def unpermuted(number: int, size: int, key: bytes, tweak: str) -> int:
    """The inverse of ``permuted``: the rounds backwards, the halves exchanged."""
    return _walked(number, size, key, tweak, range(7, -1, -1))


def _walked(number: int, size: int, key: bytes, tweak: str, turns: range) -> int:
    if size <= 1:
        return number
    half = max(1, (size - 1).bit_length() + 1 >> 1)
    mask = (1 << half) - 1
    back = turns[0] > 0
    while True:
        left, right = number >> half, number & mask
        if back:
            left, right = right, left
        for turn in turns:
            word = f"{tweak}|{turn}|{right}".encode()
            bits = int.from_bytes(hashlib.blake2b(word, key=key[:64], digest_size=min(64, half // 8 + 8)).digest(), "big")
            left, right = right, left ^ bits & mask
        if back:
            left, right = right, left
        number = left << half | right
        if number < size:
            return number


def fixed_places(kind: str, form: str) -> set[int]:
    """Places of the canonical form that a replacement keeps: what tells the kind."""
    if kind == "email":
        return set(range(form.rindex("."), len(form)))
    if kind == "card":
        return {0}
    if kind == "iban":
        return {0, 1}
    if kind == "key":
        return set(range(re.match(r"AKIA|ASIA|ghp_|sk-|xox[bp]-", form).end()))
    return set()


def surrogate(kind: str, form: str, key: bytes, turn: int = 0) -> str:
    """The replacement of a canonical form; each ``turn`` is another permutation, taken where the one before collides."""
    if kind == "email" and turn >= WIDEN:                   # a small shape may be fully used: a longer one has room
        form = "ba" * (turn - WIDEN + 1) + form
    return _surrogate(kind, form, key if not turn else hashlib.blake2b(bytes([turn]), key=key[:64]).digest())


def _surrogate(kind: str, form: str, key: bytes) -> str:
    if kind == "first name":
        group = FIRST_NAMES[form]
        # the next in a keyed order: one to one, and never the name itself
        names = sorted((n.lower() for n in group), key=lambda n: hashlib.blake2b(n.encode(), key=key[:64]).digest())
        return names[(names.index(form) + 1) % len(names)]
    if kind == "ip":
        number = int.from_bytes(bytes(map(int, form.split("."))), "big")
        return ".".join(map(str, permuted(number, 1 << 32, key, kind).to_bytes(4, "big")))
    kept, number, size, shape = fixed_places(kind, form), 0, 1, []
    for i, c in enumerate(form):
        alphabet = KIND_OF.get(c.lower())
        if i in kept or alphabet is None:
            shape.append(c)
        else:
            letters = ALPHABETS[alphabet]
            number, size = number * len(letters) + letters.index(c.lower()), size * len(letters)
            shape.append((alphabet, c.isupper()))
    tweak = f"{kind}|{shape}"
    # a name becomes the next in a keyed order: one to one, and never the name itself
    number = unpermuted((permuted(number, size, key, tweak) + 1) % size, size, key, tweak) if kind == "name" else \
        permuted(number, size, key, tweak)
    out: list[str] = []
    for s in reversed(shape):
        if isinstance(s, str):
            out.append(s)
        else:
            number, at = divmod(number, len(ALPHABETS[s[0]]))
            out.append(ALPHABETS[s[0]][at].upper() if s[1] else ALPHABETS[s[0]][at])
    return "".join(reversed(out))


def written_like(kind: str, mention: str, form: str) -> str:
    """The replacement in the format of the mention: its separators, its case, its leading digits beyond the form."""
    if kind == "ip":
        return form
    if kind in ("phone", "card", "iban", "ssn"):
        out, left = [], list(form)
        for c in reversed(mention):
            out.append(left.pop() if c.isalnum() and left else c)
        return "".join(reversed(out))
    if kind == "first name":
        return form.upper() if mention.isupper() and len(mention) > 1 else form.capitalize() if mention[:1].isupper() else form
    return "".join(f.upper() if m.isupper() else f for m, f in zip(mention, form)) + form[len(mention):]


def rewrite(text: str, key: bytes, turns: dict[tuple[str, str], int]) -> tuple[str, int]:
    """The text with its entities replaced, and their number.  turns: of the entities that need further permutations."""
    out, at, found = [], 0, entities(text)
    for start, end, kind, form in found:
        new = surrogate(kind, form, key, turns.get((kind, form), 0))
        out += [text[at:start], written_like(kind, text[start:end], new)]
        at = end
    return "".join([*out, text[at:]]), len(found)


def exceptions(different: DataFrame, key: bytes, most_rounds: int = 20) -> DataFrame:
    """different: kind, form, each once.  kind, form, turn of those whose first replacement collides."""
    @F.pandas_udf("string")
    def replaced(kind: pd.Series, form: pd.Series, turn: pd.Series) -> pd.Series:
        return pd.Series([surrogate(k, f, key, int(t)) for k, f, t in zip(kind, form, turn)], dtype="object")

    turns = different.select("kind", "form", F.lit(0).alias("turn"))
    for _ in range(most_rounds):
        made = written(turns.select("kind", "form", "turn", replaced("kind", "form", "turn").alias("new")), "pii-surrogates")
        first = made.groupBy("kind", "new").agg(F.min("form").alias("first"))
        meets = made.join(first, ["kind", "new"]).where("form <> first").select("kind", "form")
        # many people share a name: only that a name stays the same is a collision there
        real = made.where("kind not in ('first name', 'name') or new = form").join(
            different.select("kind", F.col("form").alias("new")), ["kind", "new"], "left_semi").select("kind", "form")
        bad = written(meets.unionByName(real).distinct().withColumn("bad", F.lit(1)), "pii-collisions")
        if bad.isEmpty():
            return made.where("turn > 0").select("kind", "form", "turn")
        turns = made.join(bad, ["kind", "form"], "left").select(
            "kind", "form", (F.col("turn") + F.coalesce("bad", F.lit(0))).alias("turn"))
    raise RuntimeError(f"surrogates still collide after {most_rounds} rounds")


def replace_entities(docs: DataFrame, key: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text with surrogates, n_entities for every row of ``docs``."""
    texts = docs.select(F.col(f"`{id_col}`").alias("doc_id"), text_of(text_col).alias("text")).withColumn(
        "content", F.xxhash64("text"))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(c, k, f) for c, t in zip(batch.column(0).to_pylist(), batch.column(1))
                    for k, f in {e[2:] for e in entities(t.as_py())}]
            cols = list(zip(*rows)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.string())],
                                             names=["content", "kind", "form"])

    found = written(texts.select("content", "text").mapInArrow(find, "content long, kind string, form string"), "pii-entities")
    again = exceptions(found.select("kind", "form").distinct(), key)
    fixes = written(found.join(again, ["kind", "form"]).groupBy("content").agg(
        F.collect_set(F.struct("kind", "form", "turn")).alias("fixes")), "pii-fixes")

    def replace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [rewrite(t.as_py(), key, {(x["kind"], x["form"]): x["turn"] for x in f.as_py() or ()})
                    for t, f in zip(batch.column(1), batch.column(2))]
            new, n = zip(*rows) if rows else ((), ())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(new, pa.string()), pa.array(n, pa.int64())],
                                             names=["doc_id", "text", "n_entities"])

    # without exceptions, the usual case, no text is joined
    rows = texts.withColumn("fixes", F.lit(None).cast(fixes.schema["fixes"].dataType)) if fixes.isEmpty() else \
        texts.join(fixes, "content", "left")
    return rows.select("doc_id", "text", "fixes").mapInArrow(
        replace, f"doc_id {dict(texts.dtypes)['doc_id']}, text string, n_entities long")
