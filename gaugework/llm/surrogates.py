"""PII: keyed surrogates for detected entities.

Detected are e-mail addresses, telephone, card and social-security numbers, IBANs, IPv4 addresses, access keys, tokens and
passwords, and names of persons after a form of address. Every distinct entity of the corpus gets one surrogate, so all its mentions, in
whatever document, stay one (coreference). Parts of names are entities of their own, one for each spelling whether it stands first, last
or alone, and the corpus as a whole settles their gender: any form of address that shows one counts, and if both occur the more frequent,
male on a tie. In a second pass, what a document names after a form of address is also replaced where it stands bare, in capitals or
with a capital letter.

A surrogate is drawn from a keyed hash of the entity and keeps its format: letters stay letters of the same script and case,
digits digits, separators as they are; card numbers and IBANs keep valid check digits, a first name keeps the gender settled for it. A draw is refused while another entity holds the same surrogate or the surrogate is itself an entity of the corpus; it is then
drawn anew with the next attempt's number, with one more character from attempt `LONGER` on, so it always ends. The checks
are joins over the table of distinct entities.

Defined results: a null text stays null and has no entities; texts without entities stay as they are. Repeated rows get equal
results. A null doc_id is kept. An empty table gives an empty result; other columns play no role, and `replaced` passes them through.
"""

from __future__ import annotations

import hashlib
import hmac
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugework.functions.names import col
from gaugework.llm.frames import free_name, numbered_columns, stored

LONGER = 8
KEY = "gaugework"
# Forms of address, by gender.
MALE = ("Mr", "Sir", "Herr", "Monsieur", "Señor", "Sr", "Signor", "Господин", "Κύριος")
FEMALE = ("Mrs", "Ms", "Miss", "Madam", "Frau", "Madame", "Mme", "Mademoiselle", "Señora", "Sra", "Señorita", "Signora", "Госпожа", "Κυρία")
NEUTRAL = ("Dr", "Prof", "Professor")
_NAME = r"[^\W\d_][^\W\d_]+(?:-[^\W\d_]+)?"
PATTERNS = {
    "email": re.compile(r"[A-Za-z0-9][A-Za-z0-9._%+-]*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}"),
    "iban": re.compile(r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b"),
    "access_key": re.compile(r"\bA(?:KI|SI)A[A-Z0-9]{16}\b"),
    "token": re.compile(r"(?i)\b(?:token|secret|api[_-]?key)\s*[=:]\s*[\"']?([A-Za-z0-9_\-]{16,})"),
    "password": re.compile(r"(?i)\b(?:password|passwd|pwd)\s*[=:]\s*[\"']?([^\s\"']{4,})"),
    "ip": re.compile(r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?!\.?\d)"),
    "ssn": re.compile(r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])"),
    "card": re.compile(r"(?<!\d)(?:\d[ -]?){12,18}\d(?!\d)"),
    "phone": re.compile(r"(?<![\d(])\+\d{1,3}[ .-]?(?:\(\d{1,4}\)|\d{1,4})(?:[ .-]?\d{2,4}){1,4}(?!\d)|(?<!\d)\(\d{3}\) ?\d{3}-\d{4}(?!\d)|(?<![\d-])\d{3}[.-]\d{3}[.-]\d{4}(?!\d)"),
    "name": re.compile(rf"\b({'|'.join(MALE + FEMALE + NEUTRAL)})(?:\.|\b)[ \t]+({_NAME}(?:[ \t]+{_NAME}){{0,2}})"),
}
_PART = re.compile(r"[^\W\d_]+")
_WORD = re.compile(rf"(?<!\w){_PART.pattern}(?:-{_PART.pattern})*(?!\w)")
_DIGITS = re.compile(r"\d[\d ()+.-]{5,}\d")
_WORDY = re.compile(r"(?i)token|secret|api[_-]?key|passw|pwd")
_KEYED = re.compile(r"[A-Z]{2}\d{2}[ A-Z0-9]{8}")
_ADDRESSED = re.compile(rf"\b(?:{'|'.join(MALE + FEMALE + NEUTRAL)})\b")


def luhn(digits: str) -> int:
    """The sum that is a multiple of ten for a valid card number."""
    return sum(d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(map(int, reversed(digits))))


def detect(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the entities, longest kinds first, without overlaps, in order."""
    numeric = _DIGITS.search(text) is not None
    kinds = []
    if "@" in text:
        kinds.append("email")
    if _KEYED.search(text):
        kinds.append("iban")
    if "KIA" in text or "SIA" in text:
        kinds.append("access_key")
    if _WORDY.search(text):
        kinds += ["token", "password"]
    if numeric:
        kinds += ["ip", "ssn", "phone", "card"]
    if _ADDRESSED.search(text):
        kinds.append("name")
    found: list[tuple[int, int, str]] = []
    for kind in kinds:
        for m in PATTERNS[kind].finditer(text):
            if kind == "name":
                gender = "m" if m[1] in MALE else "f" if m[1] in FEMALE else "n"
                parts = [p for p in re.finditer(_NAME, m[2]) if p[0][0].isupper()]
                spans = [(m.start(2) + p.start(), m.start(2) + p.end(), f"first_{gender}" if i < len(parts) - 1 else "last") for i, p in enumerate(parts)]
            elif kind == "card" and not 13 <= sum(c.isdigit() for c in m[0]) <= 19:
                continue
            else:
                spans = [(*(m.span(1) if m.lastindex else m.span()), kind)]
            found += [s for s in spans if s[0] < s[1] and not any(s[0] < e and b < s[1] for b, e, _ in found)]
    return sorted(found)


def named(kind: str) -> bool:
    return kind == "last" or kind.startswith("first")


def bare(text: str, found: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """`found` with the other places of the names in it."""
    names = {}
    for b, e, kind in found:
        if named(kind):
            names.setdefault(text[b:e].casefold(), kind)
    if not names:
        return found
    taken = bytearray(len(text))
    for b, e, _ in found:
        taken[b:e] = b"\1" * (e - b)
    more = []
    for m in _WORD.finditer(text):
        # A double name as a whole, or else its parts.
        pieces = [m] if m[0].casefold() in names else _PART.finditer(text, *m.span())
        more += [(*p.span(), names[p[0].casefold()]) for p in pieces if p[0][0].isupper() and p[0].casefold() in names and not any(taken[p.start():p.end()])]
    return sorted(found + more)


def entity(kind: str, text: str) -> str:
    """What all mentions of one entity have in common."""
    if kind in ("card", "iban"):
        return re.sub(r"[ -]", "", text)
    if kind == "phone":
        return re.sub(r"[^\d+]", "", text)
    return text.lower() if kind == "email" else text.casefold() if named(kind) else text


class Draw:
    """Numbers from a keyed hash."""

    def __init__(self, key: str, *parts: str):
        self.key, self.seed, self.n, self.pool = key.encode(), "\0".join(parts).encode(), 0, b""

    def below(self, n: int) -> int:
        if len(self.pool) < 4:
            self.pool = hmac.digest(self.key, self.seed + self.n.to_bytes(4, "big"), hashlib.sha256)
            self.n += 1
        value, self.pool = int.from_bytes(self.pool[:4], "big"), self.pool[4:]
        return value % n

    def of(self, letters: str) -> str:
        return letters[self.below(len(letters))]


# Letters by script, lower case: vowels and consonants.
_SCRIPTS = {"latin": ("aeiou", "bdfgklmnprstv"), "cyrillic": ("аеиоу", "бвгдклмнпрст"), "greek": ("αειου", "βγδκλμνπρστ")}


def script(c: str) -> str:
    return "cyrillic" if "Ѐ" <= c <= "ӿ" else "greek" if "Ͱ" <= c <= "Ͽ" else "latin"


def alike(draw: Draw, c: str, hexadecimal: bool = False) -> str:
    """A character of the same kind."""
    if c.isdigit():
        return draw.of("0123456789")
    if not c.isalpha():
        return c
    letters = "abcdef" if hexadecimal else "".join(_SCRIPTS[script(c)])
    return draw.of(letters).upper() if c.isupper() else draw.of(letters)


def person(draw: Draw, kind: str, text: str, more: int) -> str:
    """A pronounceable name of about the same length, in the same script; first names end as their gender's do."""
    vowels, consonants = _SCRIPTS[script(text[0])]
    length = max(4, len(text)) + more
    out = "".join(draw.of(consonants if i % 2 == 0 else vowels) for i in range(length))
    if kind == "first_f":
        out = out[:-1] + vowels[0] if out[-1] not in vowels else out
    elif kind == "first_m":
        out = out[:-1] + draw.of(consonants) if out[-1] in vowels else out
    return out


def surrogate(kind: str, text: str, attempt: int, key: str = KEY) -> str:
    """The surrogate of an entity at the given attempt, in the entity's normal form."""
    draw, more = Draw(key, kind, text, str(attempt)), max(0, attempt - LONGER + 1)
    if kind == "last" or kind.startswith("first"):
        return person(draw, kind, text, more)
    if kind == "email":
        local, _, domain = text.partition("@")
        host, _, top = domain.rpartition(".")
        site = Draw(key, "domain", domain)
        return "".join(alike(draw, c) for c in local) + "".join(draw.of("0123456789") for _ in range(more)) + "@" + "".join(alike(site, c) for c in host) + "." + top
    if kind == "ip":
        return ".".join(str(1 + draw.below(254)) for _ in range(4))
    if kind == "access_key":
        return text[:4] + "".join(draw.of("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567") for _ in text[4:])
    if kind == "phone":
        head = 2 if text[0] == "+" else 0
        return text[:head] + "".join(str(1 + draw.below(9)) if i == 0 else draw.of("0123456789") for i in range(len(text) - head + more))
    if kind == "card":
        body = text[0] + "".join(draw.of("0123456789") for _ in text[1:-1]) + "".join(draw.of("0123456789") for _ in range(more))
        return body + (str(-luhn(body + "0") % 10) if luhn(text) % 10 == 0 else draw.of("0123456789"))
    if kind == "iban":
        body = "".join(alike(draw, c) for c in text[4:]) + "".join(draw.of("0123456789") for _ in range(more))
        number = int("".join(str(int(c, 36)) for c in body + text[:2] + "00"))
        return f"{text[:2]}{98 - number % 97:02d}{body}"
    hexadecimal = re.fullmatch(r"[0-9a-fA-F]+", text) is not None
    return "".join(alike(draw, c, hexadecimal) for c in text) + "".join(draw.of("0123456789") for _ in range(more))


def in_format(kind: str, mention: str, chosen: str) -> str:
    """A surrogate in the spelling of a mention: its separators, its case."""
    if kind in ("card", "iban", "phone"):
        rest, out = list(chosen), []
        for c in mention:
            out.append((rest.pop(0) if rest else "") if c.isalnum() or c == "+" else c)
        return "".join(out + rest)
    if kind == "last" or kind.startswith("first"):
        return chosen.upper() if mention.isupper() else chosen.capitalize()
    return chosen.upper() if kind == "email" and mention.isupper() else chosen


def mentions(docs: DataFrame) -> DataFrame:
    """(id, text_key, start, end, kind, entity, mention) for each mention, of all rows."""
    schema = "doc_id long, text_key long, start int, end int, kind string, entity string, mention string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for i, t in enumerate(b.column(2)):
                text = t.as_py() or ""
                rows += [(i, s, e, kind, entity(kind, text[s:e]), text[s:e]) for s, e, kind in bare(text, detect(text))]
            at = pa.array([r[0] for r in rows], pa.int64())
            kinds = (pa.int32(), pa.int32(), pa.string(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(at), b.column(1).take(at), *[pa.array([r[k + 1] for r in rows], kind) for k, kind in enumerate(kinds)]],
                names=["doc_id", "text_key", "start", "end", "kind", "entity", "mention"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"), "text")
    return rows.mapInArrow(run, schema)


def settled(found: DataFrame) -> DataFrame:
    """(name, settled): what kind the mentions of a name have in all documents; a first name's gender is that of most mentions that show one."""
    counts = found.where(is_name()).groupBy(F.col("entity").alias("name")).agg(
        *[F.count_if(F.col("kind") == k).alias(k) for k in ("first_m", "first_f", "first_n")],
    )
    kind = F.when(F.expr("first_m > 0 and first_m >= first_f"), "first_m").when(F.expr("first_f > 0"), "first_f").when(F.expr("first_n > 0"), "first_n")
    return counts.select("name", F.coalesce(kind, F.lit("last")).alias("settled"))


def is_name() -> Column:
    return F.col("kind").isin("last", "first_m", "first_f", "first_n")


def names_settled(found: DataFrame) -> DataFrame:
    """`found` with `drawn_as`: the kind that its entity is drawn as, one for each name."""
    names = settled(found)
    joined = found.join(names, is_name() & (F.col("entity") == F.col("name")), "left")
    return joined.withColumn("drawn_as", F.coalesce("settled", "kind")).drop("name", "settled")


def assigned(entities: DataFrame, key: str = KEY) -> DataFrame:
    """(kind, entity, chosen) for distinct (kind, entity): surrogates that are distinct within a kind and name no entity of it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            kind, text, attempt = (c.to_pylist() for c in b.columns)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([surrogate(*x, key) for x in zip(kind, text, attempt)], pa.string())], names=["kind", "entity", "attempt", "chosen"])

    schema = "kind string, entity string, attempt int, chosen string"
    space = F.when(is_name(), "name").otherwise(F.col("kind")).alias("space")  # names of all kinds keep apart
    drawn = stored(entities.select("kind", "entity", F.lit(0).alias("attempt")).mapInArrow(run, schema), "drawn")
    taken = entities.select(space, F.col("entity").alias("chosen"))
    while True:
        # Of those with one surrogate the first to have drawn it keeps it; settled ones come first as their attempt is lower.
        spaced = drawn.select("*", space)
        holder = spaced.groupBy("space", "chosen").agg(F.min(F.struct("attempt", "entity")).alias("holder"), F.count("*").alias("n"))
        twice = spaced.join(holder.where("n > 1"), ["space", "chosen"]).where("entity <> holder.entity").select("kind", "entity")
        clash = spaced.join(taken, ["space", "chosen"], "left_semi").select("kind", "entity")
        again = stored(twice.union(clash).distinct(), "again")
        if again.isEmpty():
            return drawn.select("kind", "entity", "chosen")
        redrawn = drawn.join(again, ["kind", "entity"], "left_semi").select("kind", "entity", (F.col("attempt") + 1).alias("attempt")).mapInArrow(run, schema)
        drawn = stored(drawn.join(again, ["kind", "entity"], "left_anti").union(redrawn), "drawn")


def replaced(docs: DataFrame, key: str = KEY) -> DataFrame:
    """The rows of `docs` (doc_id, text and any others) with surrogates in the text, and `entities`, an array of (kind, start, end,
    surrogate) by place in the old text. A column named `entities` is replaced."""
    docs = docs.drop("entities")
    id_, key_, found_ = (free_name(docs, n) for n in ("_id", "_key", "_found"))
    found = stored(names_settled(stored(mentions(docs), "mentions")), "settled")
    chosen = assigned(found.select(F.col("drawn_as").alias("kind"), "entity").distinct(), key).withColumnRenamed("kind", "drawn_as")
    listed = found.join(chosen, ["drawn_as", "entity"]).groupBy("doc_id", "text_key").agg(
        F.array_sort(F.collect_set(F.struct("start", "end", "kind", "mention", "chosen"))).alias(found_),
    ).select(F.col("doc_id").alias(id_), F.col("text_key").alias(key_), found_)
    rows = docs.join(listed, F.col("doc_id").cast("long").eqNullSafe(F.col(id_)) & (F.xxhash64("text") == F.col(key_)), "left").select(*map(col, docs.columns), found_)
    item = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("surrogate", T.StringType())])
    schema = T.StructType([*docs.schema.fields, T.StructField("entities", T.ArrayType(item))])
    text_at = docs.columns.index("text")
    arrow = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("surrogate", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, lists = [], []
            for t, got in zip(b.column(text_at), b.column(b.num_columns - 1)):
                text, out, at, items = t.as_py(), [], 0, []
                for e in got.as_py() or []:
                    new = in_format(e["kind"], e["mention"], e["chosen"])
                    out += [text[at:e["start"]], new]
                    at = e["end"]
                    items.append({"kind": e["kind"], "start": e["start"], "end": e["end"], "surrogate": new})
                texts.append(text if not items else "".join(out) + text[at:])
                lists.append(items)
            columns = [b.column(i) if i != text_at else pa.array(texts, pa.string()) for i in range(b.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(lists, arrow)], names=schema.names)

    return numbered_columns(rows).mapInArrow(run, schema)
