"""Personal data replaced by keyed surrogates of the same type, format, script and gender.

Detection finds e-mail addresses, phone numbers, card numbers, social
security numbers, IP addresses, secrets (long hexadecimal tokens) and first
names with the family names that follow them. Every distinct entity gets one
surrogate in the whole corpus (coreference), drawn from a keyed hash: digits
stay digits, letters stay letters of their case and script, separators,
country code and network parts of reserved ranges stay, card numbers keep a
valid check digit if they had one, names come from the list of the same script
and gender. A surrogate is accepted only if no other entity has it and no
entity of the corpus is written like it; otherwise the next attempt of the
hash is tried. The attempts run as Spark aggregates over the table of distinct
entities, so distinctness holds for the corpus, not just for a partition.
"""

from __future__ import annotations

import hashlib
import hmac
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperlake.runtime import cut_lineage

from . import bitmaps

STRICT, ATTEMPTS = 48, 192  # rounds without entities as surrogates, and in all
KEY = "documented default key; pass your own"
_NO_ID = -(1 << 63)

# (script, gender) -> first names; a surrogate comes from the list of the name it replaces
FIRST_NAMES = {
    ("latin", "f"): "Anna Maria Laura Emma Sofia Julia Clara Elena Lucy Alice Nora Marta Irene Helen Susan Karen".split(),
    ("latin", "m"): "Peter Paul Thomas Martin David Daniel Simon Lukas Oliver Victor Henry George Frank Hugo Oscar Robert".split(),
    ("cyrillic", "f"): "Анна Мария Елена Ольга Татьяна Наталья Ирина Светлана".split(),
    ("cyrillic", "m"): "Иван Пётр Алексей Сергей Дмитрий Николай Андрей Михаил".split(),
    ("greek", "f"): "Μαρία Ελένη Αικατερίνη Σοφία".split(),
    ("greek", "m"): "Γιώργος Νίκος Δημήτρης Κώστας".split(),
}
FAMILY_NAMES = {
    "latin": "Adler Becker Carver Dalton Ellis Fischer Garner Holm Ivers Jansen Keller Lindner Moreau Novak Olsen Porter".split(),
    "cyrillic": "Иванов Петров Смирнов Соколов Лебедев Морозов Волков Зайцев".split(),
    "greek": "Παππάς Νικολάου Γεωργίου Δήμου".split(),
}
_NAMES = {name: kind for kind, names in FIRST_NAMES.items() for name in names}

PATTERNS = [
    ("email", r"(?<![\w.+-])[\w.+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"),
    ("secret", r"(?<![0-9A-Za-z])(?=[0-9a-fA-F]*[a-fA-F])(?=[0-9a-fA-F]*[0-9])(?:[0-9a-f]{32,}|[0-9A-F]{32,})(?![0-9A-Za-z])"),
    ("ssn", r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])"),
    ("ip", r"(?<![\d.])(?:25[0-5]|2[0-4]\d|1?\d?\d)(?:\.(?:25[0-5]|2[0-4]\d|1?\d?\d)){3}(?![\d]|\.\d)"),
    ("card", r"(?<![\d-])(?:\d[ -]?){12,18}\d(?![\d-])"),
    ("phone", r"(?<![\w+])(?:\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?|\(\d{2,4}\)[ .-]?|(?=\d{3}[ .-]\d{3}[ .-]\d{4}))\d{2,4}(?:[ .-](?!(?:\d{1,3}\.){3}\d)\d{2,4}){1,4}(?!\d)"),
    ("name", r"(?<!\w)(?:" + "|".join(sorted(_NAMES, key=lambda n: (-len(n), n))) + r")(?: [^\W\d_a-zа-яα-ω][^\W\d_]+)?(?!\w)"),
]
FOUND = re.compile("|".join(f"(?P<{kind}>{pattern})" for kind, pattern in PATTERNS))


# a line without a digit, an at sign or a listed name holds nothing; both searches start at a set of characters
_MARK = re.compile("[0-9@]")
_NAME_IN = re.compile("|".join(sorted(_NAMES)))


def entities(text: str):
    """(kind, start, end, value) of each entity, left to right; the first pattern that fits wins. None spans lines."""
    at = 0
    for line in (text or "").split("\n"):
        if _MARK.search(line) or _NAME_IN.search(line):
            for m in FOUND.finditer(line):
                yield m.lastgroup, at + m.start(), at + m.end(), m.group()
        at += len(line) + 1


def normal_form(kind: str, value: str) -> str:
    """What two spellings of one entity have in common; the surrogate belongs to this form."""
    if kind == "email":
        return value.lower()
    if kind in ("card", "phone"):
        return re.sub(r"[^\d+]", "", value)
    return value.lower() if kind == "secret" else value


class Draw:
    """An endless keyed stream of numbers for one entity and attempt."""

    def __init__(self, key: str, kind: str, form: str, attempt: int):
        self.seed = hmac.new(key.encode(), f"{kind}\x00{attempt}\x00{form}".encode(), hashlib.sha256).digest()
        self.pool, self.turn = b"", 0

    def below(self, n: int) -> int:
        if len(self.pool) < 8:
            self.pool += hashlib.sha256(self.seed + self.turn.to_bytes(4, "big")).digest()
            self.turn += 1
        value, self.pool = int.from_bytes(self.pool[:8], "big"), self.pool[8:]
        return value % n


def luhn_ok(digits: str) -> bool:
    total = sum(d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(int(c) for c in reversed(digits)))
    return total % 10 == 0


def surrogate_form(kind: str, form: str, key: str, attempt: int) -> str:
    """Replacement of a normal form."""
    draw = Draw(key, kind, form, attempt)
    if kind == "email":
        local, _, domain = form.partition("@")
        host = re.sub(r"[a-z0-9]", lambda m: _same_kind(m[0], draw), domain.rpartition(".")[0])
        local = re.sub(r"[a-z0-9]", lambda m: _same_kind(m[0], draw), re.sub(r"[^\W\d_]", lambda m: m[0] if m[0].isascii() else "x", local))
        return f"{local}@{host}.example" if attempt < 8 else f"{local}{draw.below(10 ** 6)}@{host}.example"
    if kind == "card":
        body = form[0] + "".join(str(draw.below(10)) for _ in form[1:-1])
        for last in "0123456789":
            if luhn_ok(body + last) == luhn_ok(form):
                return body + last
    if kind == "phone":
        keep = re.match(r"\+\d{1,3}?(?=\d{7,10}$)|", form)[0]  # the country code stays
        return keep + "".join(c if c == "+" else str(draw.below(10)) for c in form[len(keep):])
    if kind == "ssn":
        # a range that is not issued, later any number
        area = 900 + draw.below(100) if attempt < 8 else draw.below(1000)
        return f"{area:03d}-{draw.below(99) + 1:02d}-{draw.below(9999) + 1:04d}"
    if kind == "ip":  # a private network, later any address
        first = 10 if attempt < 8 else 1 + draw.below(223)
        return f"{first}.{draw.below(256)}.{draw.below(256)}.{draw.below(256)}"
    if kind == "secret":
        return "".join("0123456789abcdef"[draw.below(16)] for _ in form)
    first, _, family = form.partition(" ")
    script, gender = _NAMES[first]
    names, families = FIRST_NAMES[script, gender], FAMILY_NAMES[script]
    out = names[draw.below(len(names))]
    # a list is finite: later attempts add initials, so that names never run out
    initials = "" if attempt < 4 else "".join(f" {families[draw.below(len(families))][0]}." for _ in range(1 + attempt // 8))
    return f"{out}{initials} {families[draw.below(len(families))]}" if family else out + initials


def _same_kind(letter: str, draw: Draw) -> str:
    return chr(draw.below(10) + 48) if letter.isdigit() else chr(draw.below(26) + 97)


def dress(kind: str, original: str, surrogate: str) -> str:
    """The surrogate form with the separators and letter case of the original spelling."""
    if kind in ("card", "phone"):
        digits = iter(surrogate.lstrip("+"))
        return "".join(next(digits, "0") if c.isdigit() else c for c in original)
    if kind in ("email", "secret") and original.isupper():
        return surrogate.upper()
    return surrogate


def _propose(key: str):
    def run(batches):
        for batch in batches:
            c = batch.select(["kind", "form", "attempt"]).to_pydict()
            yield pa.RecordBatch.from_pydict(
                {**c, "surrogate": [surrogate_form(k, f, key, a) for k, f, a in zip(c["kind"], c["form"], c["attempt"])]},
                schema=pa.schema([("kind", pa.string()), ("form", pa.string()), ("attempt", pa.int32()), ("surrogate", pa.string())]))

    return run


def assign(found: DataFrame, key: str = KEY) -> DataFrame:
    """(kind, form, surrogate, attempt) for the distinct entities of ``found`` (kind, form).

    Attempts go on until every entity has a surrogate that no other entity
    has and that is no entity itself. Of entities that draw the same one, the
    smallest form gets it. Where a kind has more entities than half of its
    forms, such as short phone numbers, entities become surrogates of others
    after ``STRICT`` attempts; what has none after ``ATTEMPTS`` ends the job with an error.
    """
    todo = cut_lineage(found.distinct().withColumn("attempt", F.lit(0)), "entities")
    known = todo.select("kind", F.col("form").alias("surrogate"))
    done, attempt = None, 0
    while done is None or not todo.isEmpty():
        if attempt >= ATTEMPTS:
            kinds = [r["kind"] for r in todo.select("kind").distinct().orderBy("kind").collect()]
            raise ValueError(f"no free surrogates left for entities of kind {', '.join(kinds)}")
        drawn = cut_lineage(todo.select("kind", "form", "attempt").mapInArrow(
            _propose(key), "kind string, form string, attempt int, surrogate string"), "drawn")
        given = known.limit(0) if done is None else done.select("kind", "surrogate")
        taken = known.unionByName(given) if attempt < STRICT else given
        attempt += 1
        free = drawn.join(taken, ["kind", "surrogate"], "left_anti")
        winners = free.groupBy("kind", "surrogate").agg(F.min_by(F.struct("form", "attempt"), "form").alias("w"))
        won = winners.select("kind", "w.form", "surrogate", "w.attempt")
        done = cut_lineage(won if done is None else done.unionByName(won), "surrogates")
        todo = cut_lineage(drawn.join(done.select("kind", "form"), ["kind", "form"], "left_anti")
                           .select("kind", "form", (F.col("attempt") + 1).alias("attempt")), "entities")
    return done


def _located(batches):
    for batch in batches:
        out = {"doc": [], "h": [], "kind": [], "form": []}
        for doc, h, text in zip(*(batch.column(c).to_pylist() for c in ("doc", "h", "text"))):
            for kind, form in {(kind, normal_form(kind, value)) for kind, _, _, value in entities(text)}:
                out["doc"].append(doc), out["h"].append(h), out["kind"].append(kind), out["form"].append(form)
        yield pa.RecordBatch.from_pydict(out, schema=pa.schema(
            [("doc", pa.int64()), ("h", pa.int64()), ("kind", pa.string()), ("form", pa.string())]))


def _replace(batches):
    for batch in batches:
        texts, counts = [], []
        for text, known in zip(batch.column("text").to_pylist(), batch.column("known").to_pylist()):
            if not known:
                texts.append(text), counts.append(0)
                continue
            given = {(k["kind"], k["form"]): k["surrogate"] for k in known}
            parts, at, n = [], 0, 0
            for kind, start, end, value in entities(text):
                parts += [text[at:start], dress(kind, value, given[kind, normal_form(kind, value)])]
                at, n = end, n + 1
            texts.append("".join([*parts, text[at:]]))
            counts.append(n)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, type=pa.string()), pa.array(counts, type=pa.int64()),
                                          pa.array([len(k or []) for k in batch.column("known").to_pylist()], type=pa.int64())],
                                         names=["doc_id", "text", "n_entities", "n_distinct"])


def pseudonymise(docs: DataFrame, key: str = KEY) -> DataFrame:
    """doc_id, text with surrogates, n_entities and n_distinct for every row of ``docs`` (doc_id, text).

    A null text stays null and an empty one empty. Rows without doc_id and
    repeated rows are treated by their text. One entity has one surrogate
    everywhere, whatever its spelling (spaces, dashes, letter case of
    addresses). Extra columns are ignored. A document is one Arrow row; its
    entities are gathered per document, which its length bounds.
    """
    rows = docs.select("doc_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)).alias("doc"),
                       F.xxhash64(F.coalesce("text", F.lit(""))).alias("h"), "text")
    found = cut_lineage(rows.filter("text is not null").select("doc", "h", "text").mapInArrow(
        _located, "doc bigint, h bigint, kind string, form string"), "found").distinct()
    given = assign(found.select("kind", "form"), key)
    # an entity that a third of all documents share meets one row of `given`; Spark splits that side
    known = (found.join(given.select("kind", "form", "surrogate"), ["kind", "form"])
             .groupBy("doc", "h").agg(F.collect_list(F.struct("kind", "form", "surrogate")).alias("known")))
    # only texts that hold an entity are shuffled
    return (bitmaps.meet(rows, cut_lineage(known, "known"), ["doc", "h"]).select("doc_id", "text", "known")
            .mapInArrow(_replace, "doc_id bigint, text string, n_entities bigint, n_distinct bigint"))
