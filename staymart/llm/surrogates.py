"""Personal data replaced by keyed surrogates of the same type, gender, script and format.

Detected: e-mail addresses in any script, phone numbers, IPv4 addresses, card numbers (13 to 19 digits),
social-security and IBAN numbers, and names after a title or with a known first name. An
entity is known by its normal form (digits without separators, lower case), so its mentions
have one surrogate everywhere in the corpus, each in its own layout: separators, letter case,
numbers of digits, a name's gender and script, a card's check digit.

A surrogate is drawn by HMAC from key, type, normal form and attempt. Over the whole corpus,
drawn surrogates are checked: two entities of a type may not share one, and none may be an
entity that occurs. Of those that meet, the smallest keeps the draw and the others draw again,
until no two meet. From the fourth draw on a surrogate gets longer with each (a name with every
fourth), so that few short forms end; only IPv4 addresses keep their form, and need about as
many free addresses as occur. Nearly all keep the first draw, which is computed in place; only documents
with others get the numbers of their draws by a join.

Null texts stay null, empty ones empty. Rows that share an id share the numbers of draws.
Other columns may have any name.
"""

from __future__ import annotations

import hashlib
import hmac
import re
import unicodedata
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .scratch import keep

# Titles and first names by gender and script.
TITLES = {
    "m": ["Mr", "Sir", "Herr", "Señor", "Monsieur", "Don", "Господин"],
    "f": ["Mrs", "Ms", "Miss", "Frau", "Señora", "Señorita", "Madame", "Mme", "Doña", "Госпожа"],
    "n": ["Dr", "Prof"],
}
FIRST = {
    ("m", "latin"): ["James", "Robert", "Michael", "William", "Richard", "Thomas", "Charles", "Daniel", "Matthew", "Anthony", "Steven", "Hans", "Jürgen", "Wolfgang", "Pierre", "Jacques", "François", "Carlos", "Javier", "Alejandro"],
    ("f", "latin"): ["Mary", "Patricia", "Jennifer", "Elizabeth", "Barbara", "Susan", "Jessica", "Karen", "Margaret", "Lisa", "Emily", "Ursula", "Monika", "Sabine", "Chantal", "Isabelle", "Françoise", "Carmen", "Lucía", "Pilar"],
    ("m", "cyrillic"): ["Александр", "Сергей", "Владимир", "Андрей", "Дмитрий", "Николай"],
    ("f", "cyrillic"): ["Елена", "Ольга", "Наталья", "Татьяна", "Ирина", "Светлана"],
}
_SYLLABLES = {"latin": ("ba be bo da de do fa fe ga go ha he ka ko la le lo ma me mo na ne no pa pe ra re ro sa se so ta te to va ve".split(), {"m": "n", "f": "a", "n": "r"}), "cyrillic": ("ба бе бо да де до ка ко ла ле ло ма ме мо на не но па ра ре ро са се со та те то ва ве".split(), {"m": "н", "f": "а", "n": "р"})}
_GENDER = {n: g for (g, _), names in FIRST.items() for n in names}

_TITLE = "|".join(t for g in TITLES.values() for t in g)
_KNOWN = "|".join(n for names in FIRST.values() for n in names)
_CAPITAL = r"[A-ZÀ-ÞА-Я][\w'’-]+"
# Word characters with the marks that may follow them; e-mail labels are made of these.
_W = r"\w\u0300-\u036f"
_TOP = r"(?:xn--[A-Za-z0-9-]+|(?:[^\W\d_][\u0300-\u036f]*){2,})"
#: Every alternative begins with a character the scan can look for. An e-mail address is looked for
#: where a run of its characters begins, which keeps the scan linear; signs in front are no part of it.
_FOUND = re.compile(
    rf"(?<![{_W}.+%-])[.+%-]*(?P<email>\w[{_W}.+%-]*@[{_W}-]+(?:\.[{_W}-]+)*\.{_TOP})"
    rf"|(?P<phone>(?<![\w.])\+\d{{1,3}}[ .-]?\(?\d{{2,4}}\)?(?:[ .-]?\d{{2,4}}){{2,3}}(?!\w)|(?<![\w.(])(?:1[ .-])?\(?\d{{3}}\)?[ .-]\d{{3}}[ .-]\d{{4}}(?!\w))"
    rf"|(?P<ip>(?<![\w.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){{3}}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?!\w|\.\d))"
    rf"|(?P<ssn>(?<![\w-])\d{{3}}-\d{{2}}-\d{{4}}(?![\w-]))"
    rf"|(?P<card>(?<![\w])\d{{4}}(?:[ -]?\d{{4}}){{2}}(?:[ -]?\d{{1,7}})(?!\w))"
    rf"|(?P<iban>\b[A-Z]{{2}}\d{{2}}(?: ?[A-Z0-9]{{4}}){{2,7}}(?: ?[A-Z0-9]{{1,3}})?\b)"
    rf"|(?P<name>\b(?:(?:{_TITLE})\.? {_CAPITAL}(?: {_CAPITAL})?|(?:{_KNOWN})\b(?: {_CAPITAL})?))"
)
_MAYBE = re.compile(rf"[0-9@]|\b(?:{_TITLE})\b|\b(?:{_KNOWN})\b")

#: So many draws have the length of what they replace.
SAME_LENGTH = 3

Entity = tuple[str, str]  # type (with gender and script for names), normal form


_LETTERS = {
    ("LATIN", True): "abcdefghijklmnopqrstuvwxyz",
    ("CYRILLIC", True): "абвгдежзийклмнопрстуфхцчшщъыьэюя",
}


@lru_cache(maxsize=4096)
def _letters(ch: str) -> str:
    """The letters to draw from instead of ``ch``: of its script and case, near it."""
    script = unicodedata.name(ch, "").split(" ")[0]
    if known := _LETTERS.get((script, True)):
        return known.upper() if ch.isupper() else known
    page, kind = ord(ch) & ~0xFF, unicodedata.category(ch)
    near = "".join(
        c for c in map(chr, range(page, page + 256))
        if unicodedata.category(c) == kind and unicodedata.name(c, "").split(" ")[0] == script and len(c.lower()) == 1
    )
    return near if len(near) > 1 else _LETTERS["LATIN", True]


def _script(word: str) -> str:
    return "cyrillic" if "Ѐ" <= word[0] <= "ӿ" else "latin"


def _parts(kind: str, text: str) -> list[tuple[Entity | None, str]]:
    """A mention as (entity, text) pieces; None for what stays as it is."""
    if kind == "email":
        local, _, domain = text.rpartition("@")
        host, _, top = domain.rpartition(".")
        return [(("email", text.lower()), local), (None, "@"), (("domain", domain.lower()), host), (None, f".{top}")]
    if kind != "name":
        return [((kind, re.sub(r"[^0-9A-Za-z.]" if kind == "ip" else r"[^0-9A-Za-z]", "", text).upper()), text)]
    words = text.split(" ")
    titled = words[0].rstrip(".") in _TITLE.split("|")
    out: list[tuple[Entity | None, str]] = []
    gender = "n"
    if titled:
        gender = next(g for g, names in TITLES.items() if words[0].rstrip(".") in names)
        out += [(None, words[0]), (None, " ")]
        words = words[1:]
    first = words[0] if (len(words) > 1 or not titled) else None
    if first:
        gender = _GENDER.get(first, gender)
        out.append(((f"first-{gender}-{_script(first)}", first.lower()), first))
    for word in words[1:] if first else words:
        if first:
            out.append((None, " "))
        out.append(((f"last-{_script(word)}", word.lower()), word))
    return out


def mentions(text: str) -> Iterator[tuple[int, int, list[tuple[Entity | None, str]]]]:
    """(begin, end, pieces) of each mention, in order."""
    if text and _MAYBE.search(text):
        for m in _FOUND.finditer(text):
            kind = m.lastgroup
            yield m.start(kind), m.end(kind), _parts(kind, m.group(kind))


class Draws:
    """Surrogates by key."""

    def __init__(self, key: bytes):
        self.key = key

    def _numbers(self, entity: Entity, attempt: int) -> Iterator[int]:
        block = 0
        while True:
            said = "\x00".join((*entity, str(attempt), str(block))).encode()
            yield from hmac.digest(self.key, said, hashlib.sha256)
            block += 1

    def normal(self, entity: Entity, attempt: int) -> str:
        """The surrogate's normal form."""
        kind, form = entity
        n = self._numbers(entity, attempt)
        if kind == "ip":
            return ".".join(str(1 + next(n) % 254) for _ in range(4))
        if kind.startswith(("first", "last")):
            *_, script = kind.split("-")
            gender = kind.split("-")[1] if kind.startswith("first") else "n"
            if kind.startswith("first") and gender != "n" and attempt < 4:
                names = FIRST[gender, script]
                return names[(next(n) * 256 + next(n)) % len(names)].lower()
            syllables, ends = _SYLLABLES[script]
            return "".join(syllables[next(n) % len(syllables)] for _ in range(3 + attempt // 4)) + ends[gender]
        # An address is drawn as a whole for its local part; the domain has draws of its own.
        local = form.rpartition("@")[0] if kind == "email" else form.rpartition(".")[0] if kind == "domain" else form
        out = []
        for i, ch in enumerate(local):
            if ch.isdigit():
                out.append(str(next(n) % 10) if not (kind == "phone" and i == 0) else ch)
            elif ch.isalpha() and not (kind == "iban" and i < 2):
                letters = _letters(ch)
                out.append(letters[next(n) % len(letters)])
            else:
                out.append(ch)
        # Longer forms where those of this length may have run out.
        longer = max(0, attempt - SAME_LENGTH + 1)
        if kind in ("email", "domain"):
            letters = next((_letters(ch) for ch in reversed(local) if ch.isalpha()), _LETTERS["LATIN", True])
            out += [letters[next(n) % len(letters)] for _ in range(longer)]
        else:
            out += [str(next(n) % 10) for _ in range(longer)]
        drawn = "".join(out)
        if kind == "card" and _checks(form):
            drawn = next(drawn[:-1] + d for d in "0123456789" if _checks(drawn[:-1] + d))
        return drawn + (form[len(local) :] if kind in ("email", "domain") else "")

    def shown(self, entity: Entity, attempt: int, mention: str) -> str:
        """The surrogate in the layout of a mention."""
        kind, form = entity
        drawn = self.normal(entity, attempt)
        if kind == "ip":
            return drawn
        if kind.startswith(("first", "last")):
            return drawn.upper() if mention.isupper() and len(mention) > 1 else drawn[:1].upper() + drawn[1:]
        if kind in ("email", "domain"):
            # Character by character, as the mention writes it; what is longer, as its end.
            drawn = drawn.rpartition("@" if kind == "email" else ".")[0]
            wide = mention + mention[-1] * (len(drawn) - len(mention))
            return "".join(d.upper() if m.isupper() else d for d, m in zip(drawn, wide, strict=False))
        rest = iter(drawn)
        laid = "".join((next(rest).lower() if ch.islower() else next(rest)) if ch.isalnum() else ch for ch in mention)
        return laid + "".join(rest)

    def replaced(self, text: str, attempts: dict[Entity, int]) -> tuple[str, int]:
        """(text with surrogates, number of mentions)."""
        out, at, n = [], 0, 0
        for begin, end, pieces in mentions(text):
            out.append(text[at:begin])
            out += [said if e is None else self.shown(e, attempts.get(e, 0), said) for e, said in pieces]
            at, n = end, n + 1
        return ("".join(out) + text[at:], n) if n else (text, 0)


def _checks(digits: str) -> bool:
    """Whether the last digit is the right check digit (mod 10, every second doubled)."""
    if not digits.isdigit():
        return False
    twice = [int(d) for d in digits[-2::-2]]
    return (sum(map(int, digits[-1::-2])) + sum(2 * d - 9 * (d > 4) for d in twice)) % 10 == 0


def _found_entities(docs: DataFrame) -> DataFrame:
    """(doc_id, kind, form), each once per row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0).cast(pa.int64()), batch.column(1)
            rows, kinds, forms = [], [], []
            for i in range(batch.num_rows):
                text = texts[i].as_py()
                for kind, form in dict.fromkeys(e for _, _, pieces in mentions(text) for e, _ in pieces if e):
                    rows.append(i)
                    kinds.append(kind)
                    forms.append(form)
            yield pa.RecordBatch.from_arrays([ids.take(pa.array(rows, pa.int64())), pa.array(kinds, pa.string()), pa.array(forms, pa.string())], ["doc_id", "kind", "form"])

    return docs.mapInArrow(run, "doc_id long, kind string, form string")


def redrawn(entities: DataFrame, key: bytes, normal: Callable[[bytes, Entity, int], str] | None = None) -> DataFrame:
    """(kind, form, attempt) of the distinct ``entities`` (kind, form) that don't keep draw 0."""

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        draws = Draws(key)
        for batch in batches:
            kinds, forms, attempts = (c.to_pylist() for c in batch.columns)
            drawn = [
                normal(key, (k, f), a) if normal else draws.normal((k, f), a)
                for k, f, a in zip(kinds, forms, attempts, strict=True)
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(drawn, pa.string())], ["kind", "form", "attempt", "drawn"])

    # What is taken: the entities, the first draws that hold, and those of later rounds, which
    # are few and written anew each round, so that plans don't grow with the rounds.
    taken = entities.select("kind", F.col("form").alias("drawn"))
    left = entities.select("kind", "form", F.lit(0).alias("attempt"))
    settled = None
    while True:
        drawn = keep(left.mapInArrow(draw, "kind string, form string, attempt int, drawn string"))
        first = Window.partitionBy("kind", "drawn").orderBy("form")
        marked = drawn.withColumn("place", F.row_number().over(first))
        meets = taken.select("kind", "drawn", F.lit(True).alias("meets")).distinct()
        marked = keep(marked.join(meets, ["kind", "drawn"], "left"))
        bad = F.coalesce("meets", F.lit(False)) | (F.col("place") > 1)
        good = marked.where(~bad).select("kind", "form", "attempt", "drawn")
        if settled is None:
            first_taken = taken.union(good.select("kind", "drawn"))
            settled = good.limit(0)
        else:
            settled = keep(settled.union(good))
        left = marked.where(bad).select("kind", "form", (F.col("attempt") + 1).alias("attempt"))
        if left.isEmpty():
            return settled.select("kind", "form", "attempt")
        taken = first_taken.union(settled.select("kind", "drawn"))


def with_surrogates(docs: DataFrame, key: bytes, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text with surrogates, n_mentions) per row."""
    d = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    found = keep(_found_entities(d))
    # The numbers of draws of documents that have any; hardly any in most corpora.
    other = redrawn(found.select("kind", "form").distinct(), key)
    per_doc = (
        found.join(other, ["kind", "form"])
        .groupBy("doc_id")
        .agg(F.collect_set(F.struct("kind", "form", "attempt")).alias("draws"))
        .withColumnRenamed("doc_id", "found_id")
    )
    joined = d.join(per_doc, d["doc_id"].eqNullSafe(per_doc["found_id"]), "left").select("doc_id", "text", "draws")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        draws = Draws(key)
        for batch in batches:
            texts, counts = [], []
            for i in range(batch.num_rows):
                attempts = {(x["kind"], x["form"]): x["attempt"] for x in batch.column(2)[i].as_py() or ()}
                text = batch.column(1)[i].as_py()
                text, n = draws.replaced(text, attempts) if text is not None else (None, 0)
                texts.append(text)
                counts.append(n)
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(texts, pa.string()), pa.array(counts, pa.int32())], ["doc_id", "text", "n_mentions"])

    return joined.mapInArrow(run, "doc_id long, text string, n_mentions int")
