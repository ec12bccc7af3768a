"""Surrogates for personal data: keyed, of the same type and form, distinct and coreferent.

Detected (names only after the listed forms of address, so in Latin, Cyrillic and Greek writing; an
account number with letters is not): e-mail addresses, IPv4 addresses, card and account numbers (13 to 19 digits),
social security numbers, phone numbers, and person names after a form of address
(Latin, Cyrillic or Greek script; the form gives the gender).

Digits are those of any script (Unicode ``Nd``); a surrogate is written in the place's own.
An entity is its kind and normal form (digits alone as 0-9, lower case), so all its spellings in
all documents are one entity and get one surrogate, written in each place's own form:
separators, letter case, country code, top-level domain and word count stay; a card's
first digit stays and its check digit is valid again; a public address stays public; a
name follows the script and gender. A phone number's normal form is its national digits:
``+``, ``00``, country code and one trunk 0 are form and stay. A name is keyed by word and
script; its gender is the one that the corpus's forms of address tell (neutral if they
differ) and it counts as a first name if it stands before another once. In the documents
where a name, phone, card or social security number is detected, its further mentions are
replaced too: capitalised words without a form of address (possessives and parts of compounds
included) and the digits in any grouping, with or without the country code. Numbers and addresses pass a keyed Feistel
permutation of their own length and alphabet, so different entities of one form cannot
share a surrogate by design; names are drawn from syllables by a keyed hash.

Collision check: over the table of distinct entities, a candidate is refused when it is
an original of the corpus, when an entity with a smaller normal form claims it too, or
when it was given before; refused entities draw again with the next tweak until none is
left. A form whose strings are all taken (676 addresses ``a@b.co``) is widened from the fifth
attempt on, by one symbol more each time, so every entity finds a place. Only entities are collected by key, with partial aggregation; a very frequent one is
one row there, and its places get it by an equi-join that AQE can split.

Only texts that hold a digit, an ``@`` or a form of address are joined with their
replacements; the others never leave their task. Spans of one text are one document's.
A null text stays null; empty, repeated and null-id rows are handled like any; other
columns are carried along if asked. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import hmac
import ipaddress
import re
import sys
import unicodedata
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._util import staged

# Forms of address and the gender they tell (n: not told).
ADDRESS = {"Mr": "m", "Mrs": "f", "Ms": "f", "Miss": "f", "Dr": "n", "Prof": "n", "Herr": "m", "Frau": "f",
           "Monsieur": "m", "Madame": "f", "Mademoiselle": "f", "Señor": "m", "Señora": "f", "Señorita": "f",
           "господин": "m", "госпожа": "f", "Господин": "m", "Госпожа": "f", "Κύριος": "m", "Κυρία": "f"}
TITLES = "|".join(sorted(ADDRESS, key=len, reverse=True))
# Country calling codes by their first digits (E.164): no code begins another.
COUNTRY = re.compile(r"1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{3}")
WORD = r"[^\W\d_](?:[^\W\d_]|['’-](?=[^\W\d_]))+"
# The zeros of all scripts, each followed by its nine other digits.
ZEROS = [chr(c) for c in range(sys.maxunicode + 1) if unicodedata.decimal(chr(c), None) == 0]


def any_of(first: int, last: int) -> str:
    """A character class of the digits ``first`` to ``last`` of every script."""
    return "[" + "".join(f"{chr(ord(z) + first)}-{chr(ord(z) + last)}" for z in ZEROS) + "]"


FIELD = rf"(?:{any_of(2, 2)}{any_of(5, 5)}{any_of(0, 5)}|{any_of(2, 2)}{any_of(0, 4)}\d|{any_of(1, 1)}?\d?\d)"
PATTERNS = [
    ("email", r"[A-Za-z0-9][A-Za-z0-9._%+-]*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}"),
    ("ip", rf"(?<![\d.])(?=\d)(?:{FIELD}\.){{3}}{FIELD}(?!\.?\d)"),
    ("number", r"(?<![\w.+-])\d(?:[ -]?\d){12,18}(?![\w-]|\.\d)"),
    ("ssn", r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])"),
    ("phone", r"(?<![\w.+-])(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)[ .-]?|\d{2,4}[ .-])\d{3,4}(?:[ .-]?\d{2,4}){1,2}(?![\w-]|\.\d)"
              r"|(?<![\w.+-])\+\d{8,15}(?!\w)"),
    ("name", rf"(?<!\w)(?:{TITLES})\.?\s+(?!(?:{TITLES})\b){WORD}(?:[ ](?!(?:{TITLES})\b){WORD}){{0,2}}"),
]
FOUND = re.compile("|".join(f"(?P<{k}>{p})" for k, p in PATTERNS))


def may_hold(text: Column) -> Column:
    """Whether a text can hold an entity: a digit, an ``@`` or a form of address. Cheap tests first:
    one class of ASCII, then titles by their capitals, then, only in texts beyond ASCII, digits of
    other scripts (``Nd`` as the JVM knows it, and beyond the basic plane those that Python knows)."""
    starts: dict[str, list[str]] = {}
    for t in ADDRESS:
        starts.setdefault(t[0], []).append(t[1:])
    titles = "(?=[" + "".join(starts) + "])(?:" + "|".join(f"{c}(?:{'|'.join(rest)})" for c, rest in starts.items()) + ")"
    far = "".join(f"{z}-{chr(ord(z) + 9)}" for z in ZEROS if ord(z) > 0xFFFF)
    digits = rf"\p{{Nd}}|[\x{{10000}}-\x{{10FFFF}}&&[{far}]]"
    beyond = (F.octet_length(text) > F.length(text)) & text.rlike(digits)
    return F.coalesce(text.rlike("[0-9@]") | text.rlike(titles) | beyond, F.lit(False))


LETTERS, DIGITS = "abcdefghijklmnopqrstuvwxyz", "0123456789"
KEY = "public demonstration key: pass your own"
ROUNDS, NARROW = 40, 4

# Syllables for names by script: (inner, endings by gender, endings of surnames by gender).
SYLLABLES = {
    "latin": ("ba be bo da de do fa fe ga ka ke la le li lo ma me mi mo na ne no ra re ri ro sa se so ta te to va ve vi".split(),
              {"m": ["ron", "mas", "rick", "ton"], "f": ["lia", "nna", "rine", "ella"], "n": ["lin", "ren", "ley", "sha"]},
              {g: ["mann", "well", "ford", "sten", "rini", "court"] for g in "mfn"}),
    "cyrillic": ("ба бо ва ве го да де до ка ко ла ле ли ма ме ми на не но ра ре ри ро са се та те то".split(),
                 {"m": ["мир", "слав", "дрей", "лан"], "f": ["мила", "слава", "рина", "лана"], "n": ["лин", "ша"]},
                 {"m": ["нов", "рин", "цев"], "f": ["нова", "рина", "цева"], "n": ["енко", "чук"]}),
    "greek": ("βα δα δο θε κα κο λα λε λι μα με μι να νε πα ρα ρι ρο σα τα τε το".split(),
              {"m": ["νος", "ρης", "κος"], "f": ["νη", "ρια", "κη"], "n": ["λις", "μι"]},
              {"m": ["ίδης", "πουλος"], "f": ["ίδου", "πούλου"], "n": ["άκη", "έλλη"]}),
}


def script_of(word: str) -> str:
    c = ord(word[0])
    return "greek" if 0x370 <= c < 0x400 else "cyrillic" if 0x400 <= c < 0x530 else "latin"


def draw(key: bytes, *parts: object) -> int:
    return int.from_bytes(hmac.new(key, "\x1f".join(map(str, parts)).encode(), hashlib.sha256).digest(), "big")


def permute(symbols: str, alphabet: str | list[str], key: bytes, tweak: str) -> str:
    """A keyed permutation of all strings of this length over ``alphabet``: eight Feistel
    rounds that add a keyed number to one half and swap the halves."""
    base, n = len(alphabet), len(symbols)
    if not n:
        return symbols
    at = {c: i for i, c in enumerate(alphabet)}
    if n == 1:
        order = sorted(range(base), key=lambda i: draw(key, "one", tweak, base, i))
        return alphabet[order[at[symbols]]]

    def number(part: list[int]) -> int:
        x = 0
        for d in part:
            x = x * base + d
        return x

    def digits(x: int, width: int) -> list[int]:
        out = []
        for _ in range(width):
            x, d = divmod(x, base)
            out.append(d)
        return out[::-1]

    a, b = [at[c] for c in symbols[:n // 2]], [at[c] for c in symbols[n // 2:]]
    for i in range(8):
        a, b = b, digits((number(a) + draw(key, "round", tweak, base, n, i, number(b))) % base ** len(a), len(a))
    return "".join(alphabet[d] for d in a + b)


def shaped(text: str, key: bytes, tweak: str) -> str:
    """Letters for letters and digits for digits, each run of a kind taken together."""
    letters = iter(permute("".join(c for c in text if c in LETTERS), LETTERS, key, tweak + "|a"))
    digits = iter(permute("".join(c for c in text if c in DIGITS), DIGITS, key, tweak + "|0"))
    return "".join(next(letters) if c in LETTERS else next(digits) if c in DIGITS else c for c in text)


def luhn(digits: str) -> int:
    """The check digit that makes ``digits`` plus it valid."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return -total % 10


def extra(alphabet: str, key: bytes, tweak: str, value: str, attempt: int) -> str:
    """Symbols that widen a form whose strings are all taken: none in the first ``NARROW`` attempts,
    then one more an attempt, so that the room grows until everybody has a place."""
    x = draw(key, "wider", tweak, value)
    out = ""
    for _ in range(attempt - NARROW + 1):
        x, i = divmod(x, len(alphabet))
        out += alphabet[i]
    return out


def surrogate(kind: str, value: str, key: bytes, attempt: int) -> str:
    """The candidate for an entity's normal form at an attempt; of the same form, or from the
    fifth attempt on of a longer one (addresses have room enough)."""
    tweak = f"{kind}|{attempt}"
    if kind == "email":
        local, domain = value.rsplit("@", 1)
        rest, top = domain.rsplit(".", 1)
        return f"{shaped(local, key, tweak + '|l')}{extra(LETTERS, key, tweak, value, attempt)}@{shaped(rest, key, tweak + '|d')}.{top}"
    if kind == "ip":
        fields = [chr(i) for i in range(256)]
        public = ipaddress.ip_address(value).is_global
        now = "".join(chr(int(x)) for x in value.split("."))
        while True:  # walk the cycle to the next address of the same class
            now = permute(now, fields, key, tweak)
            out = ".".join(str(ord(c)) for c in now)
            if ipaddress.ip_address(out).is_global == public:
                return out
    more = extra(DIGITS, key, tweak, value, attempt) if not kind.startswith("name") else ""
    if kind == "number":
        if str(luhn(value[:-1])) != value[-1]:
            return value[0] + permute(value[1:], DIGITS, key, tweak) + more
        body = value[0] + permute(value[1:-1], DIGITS, key, tweak) + more
        return body + str(luhn(body))
    if kind == "ssn":
        return permute(value, DIGITS, key, tweak) + more
    if kind == "phone":
        out = permute(value, DIGITS, key, tweak)
        while (out[0] == "0") != (value[0] == "0"):  # a leading zero would read as a trunk prefix
            out = permute(out, DIGITS, key, tweak)
        return out + more
    part, script, gender, word = kind.split(":")[1:] + [value]
    inner, first, last = SYLLABLES[script]
    ends = (first if part == "first" else last)[gender]
    x = draw(key, kind, word, attempt)
    out = []
    for _ in range(2 + attempt // 4):  # later attempts draw longer names
        x, i = divmod(x, len(inner))
        out.append(inner[i])
    return "".join(out) + ends[x % len(ends)]


def plain(text: str) -> str:
    """The digits of a text as 0-9."""
    return "".join(str(unicodedata.decimal(c)) for c in text if c.isdecimal())


def digit_like(place: str, digit: str) -> str:
    """``digit`` in the script of the digit ``place``."""
    return chr(ord(place) - unicodedata.decimal(place) + int(digit))


def national(digits: str, coded: bool) -> str:
    """A phone number's digits without country code (after ``+``, if ``coded``, or 00) and trunk 0."""
    rest = digits
    if coded or digits.startswith("00"):
        rest = digits if coded else digits[2:]
        rest = rest[COUNTRY.match(rest).end():] if COUNTRY.match(rest) else rest
    rest = rest[1:] if rest.startswith("0") else rest
    return rest if len(rest) >= 4 else digits


def bare(word: str) -> str:
    """A word without a possessive 's."""
    return word[:-2] if len(word) > 3 and word[-2] in "'’" and word[-1] in "sS" else word


def parts_of(kind: str, text: str) -> list[tuple[str, str, int, int]]:
    """Entities of a match as (kind, normal form, start, end inside the match)."""
    if kind == "email":
        return [(kind, text.lower(), 0, len(text))]
    if kind == "ip":
        return [(kind, ".".join(str(int(x)) for x in text.split(".")), 0, len(text))]
    if kind == "phone":
        digits = plain(text)
        return [(kind, national(digits, text[0] == "+"), 0, len(text))] if 8 <= len(digits) <= 15 else []
    if kind != "name":
        return [(kind, plain(text), 0, len(text))]
    title = re.match(r"[^\W\d_]+", text)
    words = [w for w in re.finditer(WORD, text) if w.start() >= title.end()]
    taken = []
    for w in words:  # the capitalised words that follow, in one script
        if not w[0][0].isupper() or taken and script_of(w[0]) != script_of(taken[0][0]):
            break
        taken.append(w)
        if bare(w[0]) != w[0]:  # a possessive ends the name
            break
    out = []
    for i, w in enumerate(taken):
        part, word = "first" if i < len(taken) - 1 else "last", bare(w[0])
        out.append((f"name:{part}:{script_of(word)}:{ADDRESS[title[0]]}", word.lower(), w.start(), w.start() + len(word)))
    return out


def written(kind: str, place: str, value: str, size: int | None = None) -> str:
    """A surrogate's normal form in the form of the place it replaces; ``size``: the length of the
    original's normal form, which a widened surrogate exceeds."""
    if kind in ("ssn", "phone", "number"):
        before = plain(place)[:-(size or len(value))]  # country code and trunk prefix stay
        digits = iter(before + value)
        out = "".join(digit_like(c, next(digits)) if c.isdecimal() else c for c in place)
        last = next(c for c in reversed(place) if c.isdecimal())
        return out + "".join(digit_like(last, d) for d in digits)
    if kind == "email":
        cut = place.index("@")
        wider = len(value) - len(place)
        cases = place[:cut] + place[cut - 1] * wider + place[cut:]  # added letters follow the last one's case
        return "".join(v.upper() if c.isupper() else v for c, v in zip(cases, value, strict=True))
    if kind == "ip":
        fields = zip(place.split("."), value.split("."), strict=True)
        return ".".join("".join(digit_like(p[0], d) for d in v) for p, v in fields)
    return value.upper() if place.isupper() else value[0].upper() + value[1:]


def entities(text: str) -> list[tuple[str, str, int, int]]:
    """``(kind, normal form, start, end)`` of a text, left to right, not overlapping: what the
    patterns find, then further mentions of the same names and numbers between them."""
    found = [(k, v, m.start() + a, m.start() + b) for m in FOUND.finditer(text) for k, v, a, b in parts_of(m.lastgroup, m[0])]
    phones = {v for k, v, *_ in found if k == "phone"}
    coded = {v for k, v, a, _ in found if k == "phone" and text[a] == "+"}

    def same(k: str, v: str, a: int, e: int) -> tuple[str, str, int, int]:
        """A phone number with its country code but without a +, or one of 13 digits with 00."""
        digits = plain(text[a:e])
        if k == "phone" and text[a] != "+" and national(digits, True) in coded:
            return k, national(digits, True), a, e
        if k == "number" and digits.startswith("00") and national(digits, False) in phones:
            return "phone", national(digits, False), a, e
        return k, v, a, e

    found = [same(*f) for f in found] if phones else found
    names = {(script_of(v), v): k for k, v, *_ in reversed(found) if k.startswith("name:")}
    numbers = {v: k for k, v, *_ in found if k in ("number", "ssn")}
    phones = {v for k, v, *_ in found if k == "phone"}
    if not (names or numbers or phones):
        return found
    out, at = [], 0
    for f in [*found, ("", "", len(text), len(text))]:
        if names:
            out += [(k, v, at + a, at + e) for k, v, a, e in name_mentions(text[at:f[2]], names)]
        if numbers or phones:
            out += [(k, v, at + a, at + e) for k, v, a, e in number_mentions(text[at:f[2]], numbers, phones)]
        at = f[3]
    return sorted(found + out, key=lambda f: f[2])


def name_mentions(text: str, names: dict[tuple[str, str], str]) -> Iterator[tuple[str, str, int, int]]:
    """Capitalised words, or parts of compound words, that are among ``names``."""
    for m in re.finditer(r"[^\W\d_]+(?:['’-][^\W\d_]+)*", text):
        whole = bare(m[0])
        parts = [(whole, m.start())]
        if (script_of(whole), whole.lower()) not in names:
            parts = [(w[0], m.start() + w.start()) for w in re.finditer(r"[^\W\d_]+", m[0])]
        for word, a in parts:
            kind = names.get((script_of(word), word.lower()))
            if kind and word[0].isupper():
                yield kind, word.lower(), a, a + len(word)


def number_mentions(text: str, numbers: dict[str, str], phones: set[str]) -> Iterator[tuple[str, str, int, int]]:
    """Runs of digits, up to three marks apart, that together are one of ``numbers`` or ``phones``."""
    least, most = min(map(len, [*numbers, *phones])), max([*map(len, numbers), *(len(p) + 6 for p in phones)])
    for m in re.finditer(r"\d(?:\W{0,3}\d)*", text):
        runs = [(r[0], m.start() + r.start(), m.start() + r.end()) for r in re.finditer(r"\d+", m[0])]
        i = 0
        while i < len(runs):
            digits, j, hit = "", i, None
            while j < len(runs) and len(digits) + len(runs[j][0]) <= most:
                digits += plain(runs[j][0])
                j += 1
                if len(digits) < least:
                    continue
                phone = next((v for v in (digits, national(digits, False), national(digits, True)) if v in phones), None)
                if digits in numbers or phone:
                    hit = (numbers.get(digits, "phone"), digits if digits in numbers else phone, runs[i][1], runs[j - 1][2], j)
            if hit:
                yield hit[:4]
            i = hit[4] if hit else i + 1


def assign(found: DataFrame, key: str) -> DataFrame:
    """``(kind, value, new)`` for each distinct ``(kind, value)`` of ``found``; see the collision check above."""
    secret = key.encode()
    kind_of = F.split("kind", ":")[0]  # names collide across parts and genders too
    originals = staged(found.select("kind", "value").distinct(), "entities")
    taken_from = originals.select(kind_of.alias("family"), F.col("value").alias("new")).distinct()
    pending, done = originals, None
    for attempt in range(ROUNDS):
        def run(batches: Iterator[pd.DataFrame], attempt: int = attempt) -> Iterator[pd.DataFrame]:
            for b in batches:
                yield b.assign(new=[surrogate(k, v, secret, attempt) for k, v in zip(b["kind"], b["value"], strict=True)])

        drawn = staged(pending.select("kind", "value").mapInPandas(run, "kind string, value string, new string")
                       .withColumn("family", kind_of), "drawn")
        first = drawn.groupBy("family", "new").agg(F.min(F.struct("kind", "value")).alias("owner"))
        ok = (drawn.join(first, ["family", "new"]).where(F.struct("kind", "value") == F.col("owner"))
              .join(taken_from, ["family", "new"], "left_anti"))
        if done is not None:
            ok = ok.join(done, ["family", "new"], "left_anti")
        ok = staged(ok.select("kind", "value", "new", "family"), "accepted")
        done = ok if done is None else done.unionByName(ok)
        pending = staged(drawn.join(ok.select("kind", "value"), ["kind", "value"], "left_anti"), "pending")
        if pending.isEmpty():
            return done.select("kind", "value", "new")
    raise RuntimeError(f"surrogates still collide after {ROUNDS} attempts")


def pseudonymise(docs: DataFrame, secret: str = KEY, key: str = "doc_id", text: str = "text",
                 carry: Sequence[str] = ()) -> DataFrame:
    """``(key, *carry, text, n_entities, spans)``: the text with surrogates, and the replaced
    places of the original as ``kind:start:end`` (code points, end exclusive). Columns named
    like an output are not carried; names that start with two underscores are reserved."""
    cols = [c for c in carry if c not in (key, text, "text", "n_entities", "spans")]
    rows = docs.select(key, *cols, F.col(text).alias("text"))
    maybe = may_hold(F.col("text"))
    some = rows.where(maybe)

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = [(k, f, v, a, e, t[a:e]) for k, t in zip(b["__tkey"], b["text"], strict=True) for f, v, a, e in entities(t)]
            yield pd.DataFrame(out, columns=["__tkey", "kind", "value", "lo", "hi", "place"])

    tkey = F.sha2("text", 256)
    found = staged(some.select(tkey.alias("__tkey"), "text").mapInPandas(
        find, "__tkey string, kind string, value string, lo int, hi int, place string").distinct(), "found")

    # a name's key is its word and script; part and gender are settled over all its places
    is_name, at = F.col("kind").startswith("name:"), F.split("kind", ":")
    keyed = F.when(is_name, F.concat(F.lit("name:"), at[2])).otherwise(F.col("kind")).alias("__e")
    told = [F.max(at[i] == v).alias(f"__{v}") for i, v in ((1, "first"), (3, "m"), (3, "f"))]
    settled = F.concat(F.lit("name:"), F.when(F.col("__first"), "first").otherwise("last"), F.lit(":"), F.split("__e", ":")[1], F.lit(":"),
                       F.when(F.col("__m") == F.col("__f"), "n").when(F.col("__m"), "m").otherwise("f"))
    distinct = (found.where(is_name).groupBy(keyed, "value").agg(*told).select(settled.alias("kind"), "value")
                .unionByName(found.where(~is_name).select("kind", "value").distinct()))
    given = assign(distinct, secret).select(keyed, "value", "new")

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield b.assign(new=[written(k, p, v, n) for k, p, v, n in zip(b["kind"], b["place"], b["new"], b["n"], strict=True)])[
                ["__tkey", "lo", "hi", "kind", "new"]]

    placed = (found.withColumn("__e", keyed).join(given, ["__e", "value"]).select("__tkey", "lo", "hi", "kind", "place", "new", F.length("value").alias("n"))
              .mapInPandas(write, "__tkey string, lo int, hi int, kind string, new string")
              .groupBy("__tkey").agg(F.array_sort(F.collect_list(F.struct("lo", "hi", "kind", "new"))).alias("__r")))
    init = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def add(acc, r):
        kept = F.substring(F.col("text"), acc["at"] + 1, r["lo"] - acc["at"])
        return F.struct(r["hi"].alias("at"), F.concat(acc["out"], F.array(kept, r["new"])).alias("out"))

    def end(acc):
        return F.concat(F.array_join(acc["out"], ""), F.substring(F.col("text"), acc["at"] + 1, F.length("text")))

    spans = F.array_join(F.transform("__r", lambda r: F.concat_ws(
        ":", F.split(r["kind"], ":")[0], r["lo"].cast("string"), r["hi"].cast("string"))), ",")
    joined = some.withColumn("__tkey", tkey).join(placed, "__tkey", "left")
    changed = joined.select(key, *cols, F.when(F.col("__r").isNotNull(), F.aggregate("__r", init, add, end))
                            .otherwise(F.col("text")).alias(text),
                            F.coalesce(F.size("__r"), F.lit(0)).cast("long").alias("n_entities"),
                            F.coalesce(spans, F.lit("")).alias("spans"))
    same = rows.where(~maybe).select(key, *cols, F.col("text").alias(text), F.lit(0).cast("long").alias("n_entities"),
                                     F.lit("").alias("spans"))
    return changed.unionByName(same)
