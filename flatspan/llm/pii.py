"""Personal data and secrets replaced by surrogates.

Entities are found by patterns with checks (check digits, octets).  A surrogate is drawn from a keyed digest of the entity's type,
gender and normalised value, so every mention of an entity, in any document and notation, gets the same one (coreference), and keeps
type, notation, letter case, script, issuer or country prefix, check digits and, for persons, the gender of the title.  Surrogates are
checked for collisions over the whole corpus: of entities that drew the same value one keeps it, and a value that is itself an entity
of the corpus is not used; the others draw again, from the ninth draw on with one more character each time, so the draws end.

Documents that hold no trigger of any pattern (a native filter that lets every entity through) are neither sent to Python nor
shuffled.

Defined results: null and empty texts stay as they are; equal rows stay equal rows; rows are told apart by id and text, ids may be null;
texts of any length are read whole; an empty table gives no rows.  All columns are kept, whatever their names, and only the text changes.
"""

from __future__ import annotations

import hashlib
import hmac
import re
import unicodedata
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flatspan.llm import unused
from flatspan.session import write_stage

#: The key of the surrogates; give your own to make them unpredictable.
KEY = "flatspan surrogates"
#: Draws that keep the length of the value.
SAME_LENGTH_DRAWS = 8

# Titles before names, by the gender they tell.
_MALE = ("Mr", "Herr", "Monsieur", "Señor", "Sr", "Don", "Signor", "господин", "г-н", "κύριος")
_FEMALE = ("Mrs", "Ms", "Miss", "Frau", "Mme", "Madame", "Señora", "Sra", "Doña", "Signora", "госпожа", "г-жа", "κυρία")
_OTHER = ("Dr", "Prof")
_TITLE = "|".join(sorted((*_MALE, *_FEMALE, *_OTHER), key=len, reverse=True))
_NAME = r"[^\W\d_]+(?:['’-][^\W\d_]+)*"

_MORE = re.compile(rf"[ \xa0]({_NAME})")
_WORD = re.compile(_NAME)
#: Small words that begin a name or stand between its parts, and those that only follow one of them.
_PARTICLES = frozenset("van von vom zu de del della di da dos das do du af av ten ter bin ibn al el y e фон де".split())
_SECOND_PARTICLES = frozenset("der den dem la las los le und".split())
_TITLES = frozenset((*_MALE, *_FEMALE, *_OTHER))

_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
_PATTERN = re.compile(
    "|".join(
        (
            r"(?P<email>(?<![\w.%+-])[\w.%+-]++@(?:[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?\.)+[A-Za-z]{2,})",
            r"(?:\b(?i:passwords?|passwd|pwd|secret|token|api[_-]?key)\b\s{0,3}[=:]\s{0,3}[\"']?(?P<secret>[^\s\"'<>,;]{6,}))",
            r"(?P<key>\b(?:AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36,}|sk-[A-Za-z0-9]{20,})\b)",
            r"(?P<iban>\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b)",
            rf"(?P<ip>(?<![\w.])(?:{_OCTET}\.){{3}}{_OCTET}(?!\w|\.[0-9]))",
            r"(?P<phone>(?<![\w+])\+[0-9]{1,3}(?:[ .-]?\([0-9]{1,4}\)|[ .-]?[0-9]{1,4})(?:[ .-]?[0-9]{2,4}){1,4}(?!\w)"
            r"|(?<!\w)\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}(?!\w)|(?<![\w.-])[0-9]{3}(?P<dash>[.-])[0-9]{3}(?P=dash)[0-9]{4}(?![\w]))",
            r"(?P<ssn>(?<![\w-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-]))",
            r"(?P<card>(?<![\w-])(?:[0-9]{4}(?:[ -]?[0-9]{4}){3}|[0-9](?:[ -]?[0-9]){12,18})(?!\w))",
            rf"(?:\b(?P<title>{_TITLE})\.?[ \xa0](?P<person>{_NAME}))",
        )
    )
)
#: Kinds in the order of the pattern.
KINDS = ("email", "secret", "key", "iban", "ip", "phone", "ssn", "card", "person")

#: Every text with an entity holds one of these parts or matches one of these patterns.
TRIGGER_PARTS = ("@", "=", ":", "AKIA", "sk-")
_INITIALS = "".join(sorted({t[0] for t in (*_MALE, *_FEMALE, *_OTHER)}))
TRIGGERS = (r"[0-9][ .-]?[0-9]", "gh[pousr]_", rf"(?=[{_INITIALS}])(?:{_TITLE})\.?[ \x{{a0}}]")


def _passes(digits: str) -> bool:
    total = sum(d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(int(c) for c in reversed(digits)))
    return total % 10 == 0


def _iban_rest(text: str) -> int:
    return int("".join(str(int(c, 36)) for c in text[4:] + text[:4])) % 97


#: Signs of an IBAN by country.
IBAN_SIGNS = {
    c: n
    for n, countries in (
        (15, "NO"), (16, "BE"), (18, "DK FO FI GL NL"), (19, "MK SI"), (20, "AT BA EE KZ LT LU XK"), (21, "CH HR LI LV"), (22, "BG BH CR DE GB GE IE ME RS VA"),
        (23, "AE GI IL IQ OM TL"), (24, "AD CZ ES MD PK RO SA SE SK TN VG"), (25, "LY PT ST"), (26, "IS TR"), (27, "FR GR IT MC MR SM"),
        (28, "AL AZ BY CY DO GT HU LB PL SV"), (29, "BR EG PS QA UA"), (30, "JO KW MU"), (31, "MT SC"),
    )
    for c in countries.split()
}
_DIGITS = re.compile(r"[0-9]+")
#: Digits of a run in which cards are looked for together, and the signs after a phone number in which what it runs into must end.
RUN_DIGITS, BEHIND = 48, 24
_RUN = re.compile(rf"[0-9](?:[ -]?[0-9]){{0,{RUN_DIGITS - 1}}}")


def _name_end(text: str, start: int, stop: int) -> int:
    """The end of the name that starts there: words with a capital and particles before them, up to the first other word or title."""
    end, particle, word = start, False, _WORD.match(text, start, stop)
    while word:
        said = word[word.lastindex or 0]
        if said in _TITLES:
            break
        if any(part[:1].isupper() for part in re.split("['’-]", said)):
            end, particle = word.end(), False
        elif said in _PARTICLES or particle and said in _SECOND_PARTICLES:
            particle = True
        else:
            break
        word = _MORE.match(text, word.end(), stop)
    return end


def _iban_end(said: str) -> int:
    """How much of a match is an IBAN: as much as its country has signs, or else the most groups that pass; 0 if none do."""
    ends = [i for i in range(len(said), 11, -1) if i == len(said) or said[i] == " "]
    ends.sort(key=lambda i: i - said.count(" ", 0, i) != IBAN_SIGNS.get(said[:2]))
    return next((i for i in ends if _iban_rest(said[:i].replace(" ", "")) == 1), 0)


def _issued(digits: str) -> bool:
    """Whether a card network has numbers of this length with this start."""
    return {13: digits[0] == "4", 14: digits[:2] in ("30", "36", "38", "39"), 15: digits[:2] in ("34", "37"), 16: digits[0] in "23456", 19: digits[0] in "46"}.get(len(digits), False)


def _cards(text: str, start: int, end: int) -> tuple[list[tuple[int, int]], list[int]]:
    """Cards (start, end) that do not overlap, best first chosen, and the starts of the groups, in the run of digits that the match
    from ``start`` to ``end`` begins.  Besides the match a card is whole groups: one, or four digits and groups of at least three."""
    run = _RUN.match(text, start)
    groups = [g.span() for g in _DIGITS.finditer(text, start, run.end())]
    if len(groups) > 1 and text[run.end() : run.end() + 1].isdecimal():
        groups.pop()  # cut by the bound
    spans = {(start, end)}
    for i, (a, b) in enumerate(groups):
        size, j = b - a, i
        if size > 12:
            spans.add((a, b))
        while size < 19 and groups[i][1] - a == 4 and j + 1 < len(groups) and groups[j + 1][1] - groups[j + 1][0] >= (1 if size >= 16 else 3):
            j += 1
            size += groups[j][1] - groups[j][0]
            if size > 12:
                spans.add((a, groups[j][1]))
    ranked = []
    for a, b in spans:
        digits = re.sub("[ -]", "", text[a:b])
        if b < len(text) and re.match(r"\w", text[b]) or not 13 <= len(digits) <= 19:
            continue
        if _passes(digits):
            ranked.append((not _issued(digits), (a, b) != (start, end), a, -b))
        elif len(digits) == 16 and digits[0] in "3456":
            ranked.append((2, (a, b) != (start, end), a, -b))
    chosen = []
    for _, _, a, b in sorted(ranked):
        if all(-b <= x or a >= y for x, y in chosen):
            chosen.append((a, -b))
    return sorted(chosen), [a for a, _ in groups]


def _phone_end(text: str, start: int, end: int, stop: int) -> int:
    """How much of a match is a phone number: 7 to 15 digits in whole groups, up to an entity that the match runs into; 0 if none."""
    first = _DIGITS.search(text, start).end()
    many = sum(map(str.isdecimal, text[start:end]))
    met = next(((a, b) for a, b, _, _ in find(text, first, min(stop, end + BEHIND)) if a < end and b >= end + (many <= 15)), None)
    last = met[0] if met else end
    for g in reversed(list(_DIGITS.finditer(text, start, last))):
        if 7 <= sum(map(str.isdecimal, text[start : g.end()])) <= 15:
            return g.end()
    return 0


def find(text: str, at: int = 0, stop: int | None = None) -> Iterator[tuple[int, int, str, str]]:
    """(start, end, kind, normalised value) of every entity; kinds of persons tell the gender, as in "person/f".

    A match that fails its check is tried with fewer groups, and what is left of it is looked at again.
    """
    stop = len(text) if stop is None else stop
    while m := _PATTERN.search(text, at, stop):
        kind = next(k for k in KINDS if m[k])
        said, (start, end) = m[kind], m.span(kind)
        at = m.end()
        if kind == "person":
            at = end = _name_end(text, start, stop)
            if end == start:
                continue
            said = text[start:end]
            title = m["title"]
            kind = "person/" + ("m" if title in _MALE else "f" if title in _FEMALE else "n")
            value = said.replace("\xa0", " ").casefold()
        elif kind == "email":
            value = said.lower()
        elif kind in ("secret", "key", "ip"):
            value = said
        elif kind == "card":
            cards, groups = _cards(text, start, end)
            later = next((g for g in groups[1:] if len(_DIGITS.match(text, g)[0]) > 2), groups[-1])
            if later == start:
                later = end
            if not cards:
                at = later
                continue
            if cards[0][0] > start and (other := _PATTERN.search(text, later, cards[0][0])):
                at = other.start()
                continue
            at = cards[0][0]
            for a, b in cards:
                if a > at + 1:
                    break
                at = b
                yield a, b, kind, re.sub("[ -]", "", text[a:b])
            continue
        else:
            size = end - start
            if kind == "iban":
                size = _iban_end(said)
            elif kind == "phone" and said[0] == "+":
                size = max(0, _phone_end(text, start, end, stop) - start)
            if not size:
                at = start + 4 if kind == "iban" else _DIGITS.search(text, start).end()
                continue
            at = end = start + size
            value = re.sub(r"[^A-Z0-9+]", "", text[start:end])
        yield start, end, kind, value


class Draw:
    """A stream of small numbers from the keyed digest of a text."""

    def __init__(self, key: str, *of: object) -> None:
        self.key, self.of, self.left, self.turn = key.encode(), "\0".join(map(str, of)).encode(), b"", 0

    def below(self, n: int) -> int:
        if len(self.left) < 4:
            self.left = hmac.new(self.key, self.of + self.turn.to_bytes(4), hashlib.sha256).digest()
            self.turn += 1
        x, self.left = int.from_bytes(self.left[:4]), self.left[4:]
        return x % n

    def char(self, c: str, hexadecimal: bool = False) -> str:
        """A sign of the same kind: digit, or letter of the same case and script."""
        if c.isdigit():
            return str(self.below(10))
        if hexadecimal:
            return "abcdef"[self.below(6)] if c.islower() else "ABCDEF"[self.below(6)]
        if not c.isalpha():
            return c
        out = self.letter(script(c))
        return out.upper() if c.isupper() else out

    def letter(self, of: str) -> str:
        return chr({"cyrillic": 0x430, "greek": 0x3B1}.get(of, 0x61) + self.below({"cyrillic": 32, "greek": 17}.get(of, 26)))


def script(c: str) -> str:
    word = unicodedata.name(c, "").split(" ")[0].lower()
    return word if word in ("cyrillic", "greek") else "latin"


def _name(draw: Draw, like: str, gender: str) -> str:
    """A name in the script of ``like``; a man's ends in a consonant, a woman's in an a, others in an o."""
    # Sounds of made-up names.
    hard, soft, ends = {
        "cyrillic": ("бвгдклмнрст", "аеиоу", {"f": "а", "n": "о"}),
        "greek": ("βγδκλμνρστ", "αειου", {"f": "α", "n": "ο"}),
    }.get(script(like[0]), ("bdfgklmnprstvz", "aeiou", {"f": "a", "n": "o"}))
    pick = lambda s: s[draw.below(len(s))]
    out = "".join(pick(hard) + pick(soft) for _ in range(max(2, min(4, len(like) // 2)))) + pick(hard)
    return out + ends.get(gender, "")


def surrogate(key: str, kind: str, value: str, turn: int) -> str:
    """The ``turn``-th draw for an entity: a normalised value of the same kind."""
    draw = Draw(key, kind, value, turn)
    more = max(0, turn - SAME_LENGTH_DRAWS + 1)
    if kind.startswith("person"):
        names = value.split(" ")
        out = [_name(draw, names[0], kind[-1]), *(_name(draw, n, "m") for n in names[1:])]
        return " ".join([*out[:-1], out[-1] + "".join(draw.letter(script(value[0])) for _ in range(more))])
    if kind == "email":
        local, _, domain = value.rpartition("@")
        host = Draw(key, "domain", domain)  # addresses of one domain stay together
        *labels, top = domain.split(".")
        labels = ["".join(host.char(c) for c in x) for x in labels]
        return "".join(draw.char(c) for c in local) + "x" * more + "@" + ".".join([*labels, top])
    if kind == "ip":
        parts = [str(draw.below(254) + 1) for _ in range(4)]
        return ".".join(parts)
    if kind in ("secret", "key"):
        kept = re.match(r"AKIA|gh[pousr]_|sk-|", value)[0]
        rest = value[len(kept) :]
        hexadecimal = bool(re.fullmatch(r"[0-9a-f]+|[0-9A-F]+", rest))
        return kept + "".join(draw.char(c, hexadecimal) for c in rest + rest[-1:] * more)
    if kind == "iban":
        body = "".join(draw.char(c) for c in value[4:]) + "0" * more
        return value[:2] + f"{98 - _iban_rest(value[:2] + '00' + body):02d}" + body
    kept = {"card": 1, "phone": 2 if value[0] == "+" else 0}.get(kind, 0)
    out = value[:kept] + "".join(draw.char(c) for c in value[kept:]) + "".join(str(draw.below(10)) for _ in range(more))
    if kind == "card" and _passes(value):
        out = next(out[:-1] + d for d in "0123456789" if _passes(out[:-1] + d))
    return out


def render(said: str, kind: str, value: str) -> str:
    """The surrogate value written as the mention was: its separators and letter case."""
    if kind.startswith("person"):
        names = value.split(" ")
        return " ".join(n.upper() if s.isupper() and len(s) > 1 else n.title() for n, s in zip(names, re.split(r"[  ]", said), strict=False))
    if kind == "email":
        return "".join(v.upper() if s.isupper() else v for s, v in zip(said, value, strict=False)) + value[len(said) :]
    if kind in ("secret", "key", "ip"):
        return value
    signs = iter(value)
    out = "".join(next(signs, "") if c.isalnum() or c == "+" else c for c in said)
    return out + "".join(signs)


def candidates(text: Column) -> Column:
    tests = [text.contains(x) for x in TRIGGER_PARTS] + [text.rlike(x) for x in TRIGGERS]
    return F.coalesce(reduce(Column.__or__, tests), F.lit(False))


def mentions(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, start, end, kind, value, said) of every entity of the texts."""
    schema = "doc_id string, text_hash long, start long, end long, kind string, value string, said string"
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]
        for batch in batches:
            rows = []
            for doc, text_hash, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                text = text.as_py()
                rows += [(doc, text_hash, a, b, kind, value, text[a:b]) for a, b, kind, value in find(text)]
            if rows:
                arrays = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    some = docs.where(candidates(F.col("text")))
    return some.select(F.col("doc_id").cast("string").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text").mapInArrow(run, schema)


def assign(entities: DataFrame, key: str = KEY, draw=surrogate) -> DataFrame:
    """(kind, value, surrogate): distinct surrogates for distinct entities (kind, value), none of them an entity's own value.

    Persons of all genders share their names, so their surrogates are compared across genders.
    """
    family = lambda c: F.split_part(F.col(c), F.lit("/"), F.lit(1))
    entities = write_stage(entities.select("kind", "value").distinct(), "pii-entities")
    taken = entities.select(family("kind").alias("family"), F.col("value").alias("surrogate")).distinct()
    pending, turn, done = entities, 0, None
    while not pending.isEmpty():

        def run(batches: Iterator[pa.RecordBatch], turn=turn) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                drawn = [draw(key, k, v, turn) for k, v in zip(*(c.to_pylist() for c in batch.columns), strict=True)]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(drawn, pa.string())], names=["kind", "value", "surrogate"])

        drawn = pending.mapInArrow(run, "kind string, value string, surrogate string").withColumn("family", family("kind"))
        drawn = write_stage(drawn, "pii-drawn")
        free = drawn.join(taken, ["family", "surrogate"], "left_anti")
        won = free.groupBy("family", "surrogate").agg(F.min(F.struct("value", "kind")).alias("who"))
        won = write_stage(won.select("who.kind", "who.value", "surrogate", "family"), "pii-won")
        done = won if done is None else done.union(won)
        taken = taken.union(won.select("family", "surrogate"))
        pending = write_stage(pending.join(won, ["kind", "value"], "left_anti"), "pii-pending")
        turn += 1
    return entities.select("*", F.lit("").alias("surrogate")) if done is None else done.select("kind", "value", "surrogate")


def pseudonymise(docs: DataFrame, key: str = KEY, kinds: str = "kinds") -> DataFrame:
    """All columns of ``docs``, texts with surrogates, and as ``kinds`` the kinds replaced, in order."""
    found = write_stage(mentions(docs).distinct(), "pii-mentions")
    names = write_stage(assign(found.select("kind", "value"), key), "pii-surrogates")
    changes = found.join(names, ["kind", "value"]).select("doc_id", "text_hash", F.struct("start", "end", "kind", "said", "surrogate").alias("x"))
    changes = changes.groupBy("doc_id", "text_hash").agg(F.sort_array(F.collect_list("x")).alias("changes"))
    of, text_hash, swaps, mark = (unused(docs, x) for x in ("of", "text_hash", "changes", "candidate"))
    changes = write_stage(changes.select(F.col("doc_id").alias(of), F.col("text_hash").alias(text_hash), F.col("changes").alias(swaps)), "pii-changes")

    marked = docs.withColumn(mark, candidates(F.col("text")))
    none = F.array().cast("array<string>")
    clean = marked.where(~F.col(mark)).drop(mark).withColumn(kinds, none)
    rest = marked.where(mark).drop(mark)
    same = F.col("doc_id").cast("string").eqNullSafe(F.col(of)) & (F.xxhash64("text") == F.col(text_hash))
    rest = rest.join(changes, same, "left").drop(of, text_hash)
    rest = rest.withColumn(kinds, F.coalesce(F.col(swaps)["kind"], none))
    at = rest.columns.index("text"), rest.columns.index(swaps)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [splice(t.as_py(), c.as_py() or []) for t, c in zip(batch.column(at[0]), batch.column(at[1]), strict=True)]
            columns = [pa.array(texts, pa.string()) if i == at[0] else c for i, c in enumerate(batch.columns)]
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return clean.unionByName(rest.mapInArrow(run, rest.schema).drop(swaps))


def splice(text: str, changes: list[dict]) -> str:
    out, at = [], 0
    for c in changes:
        out += [text[at : c["start"]], render(c["said"], c["kind"], c["surrogate"])]
        at = c["end"]
    return "".join([*out, text[at:]])


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return pseudonymise(docs).select("doc_id", "text", F.size("kinds").cast("long").alias("n_entities"), F.array_join("kinds", ",").alias("kinds"))
