"""URL filters: pattern rules found through their rarest literal token.

Two kinds of rules judge a url, both with DataFrame operations only.

* Site rules ``(host, path, action)``: a rule fits its host and every subdomain
  of it when the url's path starts with the rule's path; the longest rule wins.
  The url's host is cut into its suffixes, which look the rules up by equality.
* Pattern rules ``(rule_id, pattern)``: a regular expression over the lower-cased
  url. The tokens that every url it matches must hold are derived from the
  expression (``mandatory_tokens``): its branches and short optional letters are
  written out as alternatives, and of each the runs of letters and digits that
  stand between marks are whole tokens. Each alternative files the rule under its
  rarest token: the one that the fewest distinct urls hold (ties: the longer, then the
  alphabetically first). The distinct tokens of a url fetch candidate rules by
  equality and only those run their expression; a rule with an alternative that has
  no such token is judged against every url.

A site rule's verdict stands; without one, any matching pattern rule blocks,
else the url is allowed. A verdict depends on the url alone, so it is computed
once per distinct url (partially aggregated before the shuffle) and joined back;
a url that a third of all rows carry is one row there, and the join back is an
equi-join whose skewed partitions AQE splits. The rule tables are small literal
relations that Spark broadcasts on their known size.

Cases: a null url, or one without ``://``, has empty host and path, no site rule
and the verdict ``allow``; an empty table gives an empty result; repeated rows
are all judged; further columns of the table are not looked at.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The site rules of the contract (host, path, action).
SITE_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"),
              ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]

# Pattern rules: (rule id, regular expression over the lower-cased url).
PATTERN_RULES = [
    ("adult-host", r"://([^/?#]*[.])?adult-[a-z0-9]+[.]"),
    ("ads-host", r"://([^/?#]*[.])?ads?-track[.]"),
    ("bets-host", r"://([^/?#]*[.])?free-bets?[.]"),
    ("casino-host", r"://([^/?#]*[.-])?casino[.-]"),
    ("pills-host", r"://([^/?#]*[.])?cheap-(pills|meds)[.]"),
    ("spam-farm-host", r"://([^/?#]*[.])?spam-farm[.]"),
    ("tracking-feed", r"[?&]utm_source=feed&.*utm_medium="),
    ("ad-click", r"/ads?/click[?/]"),
    ("session-trap", r"[?&](phpsessid|jsessionid)="),
]
MOST_WAYS = 64  # an expression of more alternatives is judged against every url

TOKEN = "abcdefghijklmnopqrstuvwxyz0123456789"
NO_TOKEN = "[^a-z0-9]+"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z
    lower-cased; path: from there up to ``?``, ``#`` or the end."""
    u = F.coalesce(url, F.lit(""))
    at = F.instr(u, "://")
    rest = F.when(at > 0, F.substring(u, at + 3, F.length(u))).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(u)), r"^[^?#]*", 0)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def ways_of(nodes) -> list[list]:
    """A syntax tree as sequences without branches, groups and optional parts (``MOST_WAYS`` + 1 at most)."""
    out: list[list] = [[]]
    for op, arg in nodes:
        name = str(op)
        if name == "SUBPATTERN":
            more = ways_of(arg[3])
        elif name == "BRANCH":
            more = [w for branch in arg[1] for w in ways_of(branch)]
        elif name in ("MAX_REPEAT", "MIN_REPEAT") and arg[1] == 1:
            more = ([[]] if arg[0] == 0 else []) + ways_of(arg[2])
        else:
            more = [[(name, arg)]]
        out = [a + b for a in out for b in more][:MOST_WAYS + 1]
    return out


def letters_of(name: str, arg) -> set[str] | None:
    """The characters that a node of one character stands for; None: unknown."""
    if name == "LITERAL":
        return {chr(arg).lower()}
    if name == "IN" and all(str(k) in ("LITERAL", "RANGE") for k, _ in arg):
        return {chr(c).lower() for k, v in arg for c in ((v,) if str(k) == "LITERAL" else range(v[0], min(v[1], v[0] + 300) + 1))}
    return None


def whole_tokens(way: list) -> set[str]:
    """Tokens of a branch-free sequence that are bounded by marks on both sides."""
    out: set[str] = set()
    run, bounded = "", False  # letters so far, and whether a mark stands before them
    for name, arg in way:
        repeat = name in ("MAX_REPEAT", "MIN_REPEAT")
        inner = list(arg[2]) if repeat else [(name, arg)]
        held = letters_of(str(inner[0][0]), inner[0][1]) if len(inner) == 1 else None
        if name == "AT":  # the url's begin or end bounds a token
            if run and bounded and str(arg) in ("AT_END", "AT_END_STRING"):
                out.add(run)
            run, bounded = "", str(arg) in ("AT_BEGINNING", "AT_BEGINNING_STRING")
        elif held and not any(c in TOKEN for c in held) and not (repeat and arg[0] == 0):
            if run and bounded:
                out.add(run)
            run, bounded = "", True
        elif held and len(held) == 1 and not repeat:
            run += next(iter(held))
        else:  # something that may or may not go on with the token
            run, bounded = "", False
    return out


def mandatory_tokens(pattern: str) -> list[list[str]]:
    """Alternatives of tokens: a url that the expression matches holds all tokens of one of them.
    Empty: nothing is mandatory (or the expression cannot be read), every url must be tried."""
    try:
        ways = ways_of(re._parser.parse(pattern))
    except re.error:
        return []
    tokens = [sorted(whole_tokens(w)) for w in ways]
    if len(ways) > MOST_WAYS or not all(tokens):
        return []
    return sorted({tuple(t) for t in tokens})


def filed(urls: DataFrame, rules: Sequence[tuple[str, str]], url: str = "url") -> DataFrame:
    """``(token, rule_id, pattern)``: each alternative of each rule under its rarest token among ``urls``."""
    rows = [(rule, pattern, i, t) for rule, pattern in rules for i, ts in enumerate(mandatory_tokens(pattern)) for t in ts]
    asked = urls.sparkSession.createDataFrame(rows, "rule_id string, pattern string, way int, token string")
    # how many distinct urls hold each token that a rule could be filed under
    held = (urls.select(F.explode(tokens_of(F.col(url))).alias("token")).join(asked.select("token").distinct(), "token")
            .groupBy("token").agg(F.count(F.lit(1)).alias("n")))
    rank = F.struct(F.coalesce("n", F.lit(0)).alias("n"), (-F.length("token")).alias("size"), F.col("token"))
    return (asked.join(held, "token", "left").groupBy("rule_id", "pattern", "way").agg(F.min(rank).alias("r"))
            .select(F.col("r.token").alias("token"), "rule_id", "pattern").distinct())


def tokens_of(url: Column) -> Column:
    return F.array_distinct(F.split(F.lower(url), NO_TOKEN))


def pattern_hits(urls: DataFrame, rules: Sequence[tuple[str, str]], url: str = "url") -> DataFrame:
    """``(url, pattern_rule)``: the first rule id (alphabetically) that matches each matched url."""
    index = filed(urls, rules, url)
    runs = (urls.select(url, F.explode(tokens_of(F.col(url))).alias("token"))
            .join(index, "token").select(url, "rule_id", "pattern").distinct())
    everywhere = [F.struct(F.lit(rule).alias("rule_id"), F.lit(pattern).alias("pattern"))
                  for rule, pattern in rules if not mandatory_tokens(pattern)]
    if everywhere:
        runs = runs.unionByName(urls.select(url, F.explode(F.array(*everywhere)).alias("r"))
                                .select(url, "r.rule_id", "r.pattern"))
    return (runs.where(F.expr(f"lower(`{url}`) rlike pattern"))
            .groupBy(url).agg(F.min("rule_id").alias("pattern_rule")))


def site_hits(urls: DataFrame, rules: DataFrame, url: str = "url") -> DataFrame:
    """``(url, rule, action)``: the longest fitting site rule of each url that has one.

    Rules are ``(host, path, action)``; equal lengths go to the alphabetically last rule.
    """
    host, path = host_and_path(F.col(url))
    labels = F.split(F.col("host"), "[.]")
    # every suffix of the host that starts at a label
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)),
                           lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    cut = urls.select(url, host.alias("host"), path.alias("path"))
    fits = (cut.select(url, "path", F.explode(F.array_distinct(suffixes)).alias("at"))
            .join(rules.select(F.col("host").alias("at"), F.col("path").alias("start"), "action"), "at")
            .where(F.col("path").startswith(F.col("start"))))
    rule = F.concat("at", "start")
    best = F.max(F.struct(F.length(rule).alias("n"), rule.alias("rule"), F.col("action").alias("action")))
    return fits.groupBy(url).agg(best.alias("b")).select(url, "b.rule", "b.action")


def judge_urls(pages: DataFrame, site_rules: Sequence[tuple[str, str, str]] = tuple(SITE_RULES),
               pattern_rules: Sequence[tuple[str, str]] = tuple(PATTERN_RULES),
               key: str = "page_id", url: str = "url") -> DataFrame:
    """One row per row of ``pages``: key, host, path, rule, verdict, pattern_rule."""
    spark = pages.sparkSession
    rows = pages.select(F.col(key).alias(key), F.col(url).alias("url"))
    urls = rows.where(F.col("url").isNotNull()).select("url").distinct()
    sites = spark.createDataFrame(list(site_rules), "host string, path string, action string")
    by_site = site_hits(urls, sites)
    by_pattern = pattern_hits(urls, pattern_rules)
    # only urls that some rule hit need joining back
    hits = (by_site.join(by_pattern, "url", "full"))
    host, path = host_and_path(F.col("url"))
    verdict = F.coalesce("action", F.when(F.col("pattern_rule").isNotNull(), "block").otherwise("allow"))
    return (rows.join(hits, "url", "left")
            .select(key, host.alias("host"), path.alias("path"), "rule", verdict.alias("verdict"), "pattern_rule"))


def oracle_sql() -> str:
    """The same verdicts by running every rule on every url."""
    low = "lower(coalesce(c.url, ''))"
    fits = " ".join(
        f"UNION ALL SELECT page_id, url, host, path, '{h}{p}' AS r, '{a}' AS act FROM cut "
        f"WHERE (host = '{h}' OR host LIKE '%.{h}') AND starts_with(path, '{p}')" for h, p, a in SITE_RULES)
    pats = ", ".join(f"CASE WHEN regexp_matches({low}, '{p}') THEN '{r}' END" for r, p in PATTERN_RULES)
    return f"""
WITH rest AS (SELECT page_id, url, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
hosts AS (SELECT *, regexp_extract(rest, '^[^/?#]*') AS h0 FROM rest),
cut AS (SELECT DISTINCT page_id, url,
  translate(h0, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(substr(rest, length(h0) + 1), '^[^?#]*') AS path FROM hosts),
fits AS (SELECT page_id, url, host, path, NULL AS r, NULL AS act FROM cut WHERE false {fits}),
best AS (SELECT page_id, url, arg_max(r, length(r)) AS rule, arg_max(act, length(r)) AS act FROM fits GROUP BY page_id, url)
SELECT c.page_id, c.host, c.path, b.rule AS rule,
  coalesce(b.act, CASE WHEN least({pats}) IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict,
  least({pats}) AS pattern_rule
FROM cut c LEFT JOIN best b ON c.page_id = b.page_id AND c.url IS NOT DISTINCT FROM b.url
"""
