"""Secret scans: trigram postings choose which documents each rule's expression reads.

The Boolean trigram query of a rule is derived from its expression (``trigram_query``): the
expression's syntax tree is walked for the strings that every match must hold, alternatives and
optional parts included, and each gives one conjunction of trigrams; a document can only match
when it holds all trigrams of one of them. Letters count in lower case, so a rule that takes
either case is indexed all the same. Of a conjunction the trigrams that look rarest (by the
letters in them) are asked for until they are selective enough: fewer conditions are still
necessary ones. The
inverted index is a postings table ``(trigram, doc_id)`` over the trigrams asked for, each posted at
most once per document. Intersecting the postings (a document's count of a conjunction's
trigrams equals the conjunction's size) yields the candidate ``(doc_id, rule)`` pairs; only these
run the expression. A rule without a mandatory trigram (a bare run of hexadecimal digits) scans
every document in full. Texts without any posting never leave their task.

Spans come from DataFrame functions alone: splitting a text at the matches and
extracting the matches gives the lengths of both, whose running sums are the
offsets (code points, end exclusive).

The postings are only a filter: a candidate is verified on the row's own text,
so repeated ids with different texts each keep their own result. Texts of any
length are read whole. A null text counts as empty; an empty table gives an
empty result; rows with a null id scan with every rule; other columns are kept
out. All work is per document or an equi-join on the document id, so no key can
gather more rows than one document has trigrams.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass, field
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """``kind``; ``pattern`` (leftmost non-overlapping matches); ``group`` / ``least``: matches whose
    group is shorter are dropped."""
    kind: str
    pattern: str
    group: int = 0
    least: int = 0
    base: bool = field(default=False)


def either(words: str) -> str:
    """The expression with each letter in either case: A-Z and a-z only, in every engine."""
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in words)


# The base rules of the contract, in their order.
BASE_RULES = (
    Rule("assign", f"({either('password|passwd|secret|token|api_?key')})" + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6, True),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20, True),
    # a run of 24+ is exactly a maximal run that is not dropped
    Rule("hex", r"[0-9a-f]{24,}", 0, 24, True),
)
# Rules of the method itself (token formats that their issuers publish).
MORE_RULES = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}[.]eyJ[A-Za-z0-9_-]{8,}[.][A-Za-z0-9_-]{8,}"),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
)
RULES = BASE_RULES + MORE_RULES
# How many strings or conjunctions a part of an expression may stand for, how many characters a class,
# and the rarity that the trigrams asked for of a conjunction have together.
MOST, CLASS, SELECTIVE = 64, 8, 40
COMMON = "etaoinsrhldcumfpgwybvkxjqz"  # letters of running text, the commonest first


def trigrams(text: str) -> frozenset[str]:
    return frozenset(text[i:i + 3] for i in range(len(text) - 2))


def rarity(trigram: str) -> int:
    """Higher: rarer in running text (marks and digits before rare letters before common ones; a
    blank, and a mark that repeats, are common)."""
    each = sum(COMMON.index(c) if c in COMMON else 0 if c.isspace() else 30 for c in trigram)
    return each // 3 if len(set(trigram)) == 1 else each


def asked(conjunction: frozenset[str], query: frozenset[frozenset[str]]) -> tuple[str, ...]:
    """Of a conjunction the trigrams that are asked for: rare ones, and of those the ones that other
    conjunctions of the query share, until they are ``SELECTIVE`` together."""
    worth = {t: rarity(t) + 10 * sum(t in c for c in query) for t in conjunction}
    out, total = [], 0
    for t in sorted(conjunction, key=lambda t: (-worth[t], t)):
        out.append(t)
        total += rarity(t)
        if total >= SELECTIVE:
            break
    return tuple(sorted(out))


# A query is a set of conjunctions, of which one must hold; a conjunction is a set of trigrams.
# The empty conjunction always holds, so ANY is the query that excludes nothing.
ANY = frozenset([frozenset()])


def absorbed(query: set[frozenset]) -> frozenset:
    """Without the conjunctions that a weaker one makes needless."""
    return frozenset(c for c in query if not any(d < c for d in query))


def both(a: frozenset, b: frozenset) -> frozenset:
    """Both queries; where that would be too many conjunctions, the one with fewer."""
    if len(a) * len(b) > MOST:
        return min(a, b, key=len) if ANY not in (a, b) else (a if b == ANY else b)
    return absorbed({x | y for x in a for y in b})


def any_of(queries: Sequence[frozenset]) -> frozenset:
    out = absorbed(set().union(*queries))
    return out if len(out) <= MOST else ANY


def of_strings(strings: frozenset[str]) -> frozenset:
    return any_of([frozenset([trigrams(s)]) for s in strings])


def walk(nodes) -> tuple[frozenset[str] | None, frozenset]:
    """Of a part of a syntax tree: all strings it stands for in lower case (None: too many, or
    unknown) and the query that its matches satisfy."""
    now, query, whole = frozenset([""]), ANY, True  # the strings since the last unknown part; what was before
    for op, arg in nodes:
        strings, more = part(str(op), arg)
        if strings is not None and len(now) * len(strings) <= MOST:
            now = frozenset(a + b for a, b in product(now, strings))
            continue
        query, whole = both(both(query, of_strings(now)), more), False
        now = frozenset([""]) if strings is None else strings
    return (now, ANY) if whole else (None, both(query, of_strings(now)))


def part(op: str, arg) -> tuple[frozenset[str] | None, frozenset]:
    """``walk`` for one node."""
    unknown = (None, ANY)
    if op == "LITERAL":
        return frozenset([chr(arg).lower()]), ANY
    if op in ("AT", "ASSERT", "ASSERT_NOT"):  # no width
        return frozenset([""]), ANY
    if op == "IN":
        held: set[str] = set()
        for kind, value in arg:
            if str(kind) == "LITERAL":
                held.add(chr(value).lower())
            elif str(kind) == "RANGE" and value[1] - value[0] < 2 * CLASS:
                held |= {chr(c).lower() for c in range(value[0], value[1] + 1)}
            else:
                return unknown
        return (frozenset(held), ANY) if len(held) <= CLASS else unknown
    if op == "SUBPATTERN":
        return walk(arg[3])
    if op == "ATOMIC_GROUP":
        return walk(arg)
    if op == "BRANCH":
        ways = [walk(w) for w in arg[1]]
        if all(strings is not None for strings, _ in ways) and sum(len(strings) for strings, _ in ways) <= MOST:
            return frozenset().union(*(strings for strings, _ in ways)), ANY
        return None, any_of([q if strings is None else of_strings(strings) for strings, q in ways])
    if op in ("MAX_REPEAT", "MIN_REPEAT", "POSSESSIVE_REPEAT"):
        least, most, inner = arg
        strings, query = walk(inner)
        if strings is not None and least == 0 and most == 1:
            return strings | {""}, ANY
        if strings is not None and least == most and len(strings) ** least <= MOST:
            return frozenset("".join(t) for t in product(strings, repeat=least)), ANY
        return (None, query if strings is None else of_strings(strings)) if least else unknown
    return unknown


def trigram_query(rule: Rule) -> list[list[str]] | None:
    """Disjunction of conjunctions of lower-case trigrams, derived from the rule's expression, or
    None when the rule must scan fully (nothing mandatory, or an expression that cannot be read)."""
    try:
        strings, query = walk(re._parser.parse(rule.pattern))
    except (re.error, OverflowError):
        return None
    query = query if strings is None else of_strings(strings)
    if frozenset() in query or not query:
        return None
    return sorted({asked(c, query) for c in query})


def posted(text: str, wanted: Sequence[str]) -> Column:
    """The wanted trigrams that a text holds in lower case. The lower-cased text is bound as a lambda's
    variable: it is made once, wherever the optimizer moves the expression."""
    if not wanted:
        return F.array().cast("array<string>")
    held = F.transform(F.array(F.lower(F.col(text))), lambda low: F.filter(
        F.array(*map(F.lit, wanted)), lambda t: F.contains(low, t)))
    return F.element_at(held, 1)


def candidates(docs: DataFrame, rules: Sequence[Rule], key: str, text: str) -> DataFrame:
    """``(key, rules)``: the indexed rules whose trigram query each document satisfies."""
    clauses = clauses_of(rules)
    wanted = sorted({t for *_, t in clauses})
    if not wanted:
        return docs.select(key, F.array().cast("array<string>").alias("rules")).limit(0)
    query = docs.sparkSession.createDataFrame(clauses, "kind string, clause int, size int, trigram string")
    postings = docs.select(key, F.explode(posted(text, wanted)).alias("trigram"))
    met = (postings.join(F.broadcast(query), "trigram")  # a few dozen literal rows
           .groupBy(key, "kind", "clause").agg(F.max("size").alias("size"), F.collect_set("trigram").alias("held"))
           .where(F.size("held") == F.col("size")))
    return met.groupBy(key).agg(F.collect_set("kind").alias("rules"))


def clauses_of(rules: Sequence[Rule]) -> list[tuple[str, int, int, str]]:
    """``(kind, clause, size, trigram)`` of the rules' queries."""
    return [(r.kind, i, len(c), t) for r in rules for i, c in enumerate(trigram_query(r) or []) for t in c]


def spans_of(text: Column, rule: Rule) -> Column:
    """``array<struct<start, end>>`` of the rule's matches in ``text``."""
    p = F.lit(rule.pattern)
    gaps = F.transform(F.split(text, rule.pattern, -1), F.length)
    found = F.regexp_extract_all(text, p, F.lit(0))
    held = F.regexp_extract_all(text, p, F.lit(rule.group)) if rule.group else found
    step = F.arrays_zip(F.slice(gaps, 1, F.size(found)).alias("gap"),
                        F.transform(found, F.length).alias("len"), F.transform(held, F.length).alias("held"))
    start = F.struct(F.lit(0).alias("at"),
                     F.array().cast("array<struct<start:int,end:int>>").alias("out"))

    def add(acc, s):
        lo = acc["at"] + s["gap"]
        hi = lo + s["len"]
        span = F.array(F.struct(lo.cast("int").alias("start"), hi.cast("int").alias("end")))
        return F.struct(hi.cast("int").alias("at"),
                        F.when(s["held"] >= rule.least, F.concat(acc["out"], span)).otherwise(acc["out"]).alias("out"))

    none = F.array().cast("array<struct<start:int,end:int>>")
    return F.when(F.size(found) > 0, F.aggregate(step, start, add, lambda acc: acc["out"])).otherwise(none)


def labelled(spans: Column, order: int, kind: str) -> Column:
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(order).alias("ord"),
                                                 F.lit(kind).alias("kind"), s["end"].alias("end")))


def find_secrets(docs: DataFrame, rules: Sequence[Rule] = RULES, key: str = "doc_id", text: str = "text",
                 carry: Sequence[str] = ()) -> DataFrame:
    """``(key, *carry, text, spans)`` with spans an array of ``(start, ord, kind, end)`` in
    order of start, then rule. ``carry`` names columns to take along (not one called ``spans``)."""
    cols = [c for c in carry if c not in (key, text, "spans")]
    rows = docs.select(key, *cols, F.coalesce(F.col(text), F.lit("")).alias(text))
    queries = {r.kind: trigram_query(r) for r in rules}
    wanted = sorted({t for *_, t in clauses_of(rules)})
    flagged = rows.withColumn("__some", (F.size(posted(text, wanted)) > 0) & F.col(key).isNotNull())
    hit = candidates(rows.where(F.col(key).isNotNull()), rules, key, text)
    none = F.array().cast("array<struct<start:int,end:int>>")

    def spans(df: DataFrame, asked) -> DataFrame:
        marked = []
        for i, r in enumerate(rules):
            found = spans_of(F.col(text), r)
            if queries[r.kind] is not None:
                found = F.when(asked(r.kind), found).otherwise(none)
            marked.append(labelled(found, i, r.kind))
        return df.select(key, *cols, text, F.array_sort(F.concat(*marked)).alias("spans"))

    # only texts with a posting meet their candidates; the others run the rules without a query
    joined = flagged.where("__some").join(hit.withColumnRenamed(key, "__key").withColumnRenamed("rules", "__rules"),
                                          F.col(key) == F.col("__key"), "left")
    held = F.coalesce("__rules", F.array().cast("array<string>"))
    return spans(joined, lambda kind: F.array_contains(held, kind)).unionByName(
        spans(flagged.where(~F.col("__some")), lambda kind: F.col(key).isNull()))


def span_text(spans: Column) -> Column:
    """``kind:start:end`` comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(found: DataFrame, text: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """Replace every maximal run of overlapping spans of ``find_secrets`` by ``mark``."""
    init = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def add(acc, s):
        kept = F.substring(F.col(text), acc["at"] + 1, s["start"] - acc["at"])
        more = F.when(s["start"] >= acc["at"], F.concat(acc["out"], F.array(kept, F.lit(mark)))).otherwise(acc["out"])
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), more.alias("out"))

    def done(acc):
        return F.concat(F.array_join(acc["out"], ""), F.substring(F.col(text), acc["at"] + 1, F.length(text)))

    new = F.when(F.size("spans") > 0, F.aggregate("spans", init, add, done)).otherwise(F.col(text))
    return found.withColumn(text, new)


def secret_digest(docs: DataFrame) -> DataFrame:
    """The contract's columns for ``documents``."""
    found = find_secrets(docs)
    base = [r.kind for r in RULES if r.base]
    only = F.filter("spans", lambda s: s["kind"].isin(base))

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *[count(k) for k in base], F.sha2(span_text(only), 256).alias("base_sha256"),
                        span_text(F.col("spans")).alias("spans"))


def oracle_sql() -> str:
    """Every rule over every text, offsets from the gaps between matches."""
    parts = []
    for i, r in enumerate(RULES):
        p = r.pattern.replace("'", "''")
        parts.append(f"""SELECT rid, '{r.kind}' AS kind, {i} AS ord, unnest(regexp_extract_all(t, '{p}')) AS m,
  unnest(regexp_extract_all(t, '{p}', {r.group})) AS held,
  unnest(string_split_regex(t, '{p}')[:len(regexp_extract_all(t, '{p}'))]) AS gap,
  unnest(range(len(regexp_extract_all(t, '{p}')))) AS i, {r.least} AS least FROM docs""")
    base = ", ".join(f"'{r.kind}'" for r in RULES if r.base)
    counts = ", ".join(f"CAST(count(*) FILTER (WHERE kind = '{r.kind}') AS BIGINT) AS n_{r.kind}" for r in RULES if r.base)
    return f"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
raw AS ({' UNION ALL '.join(parts)}),
placed AS (SELECT *, sum(length(gap) + length(m)) OVER (PARTITION BY rid, ord ORDER BY i) AS hi FROM raw),
spans AS (SELECT rid, kind, ord, hi - length(m) AS lo, kind || ':' || (hi - length(m)) || ':' || hi AS s FROM placed
  WHERE length(held) >= least),
agg AS (SELECT rid, {counts}, coalesce(string_agg(s, ',' ORDER BY lo, ord) FILTER (WHERE kind IN ({base})), '') AS b,
  string_agg(s, ',' ORDER BY lo, ord) AS a FROM spans GROUP BY rid)
SELECT d.doc_id, {', '.join(f'CAST(coalesce(n_{r.kind}, 0) AS BIGINT) AS n_{r.kind}' for r in RULES if r.base)},
  sha256(coalesce(b, '')) AS base_sha256, coalesce(a, '') AS spans
FROM docs d LEFT JOIN agg USING (rid)
"""
