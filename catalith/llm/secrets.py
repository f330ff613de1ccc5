"""Secret scan over a trigram inverted index, in DataFrame functions only.

Each rule's regular expression is turned into a Boolean trigram query: alternatives, each
a set of trigrams that every match of it must hold.  The index has one posting per text
and trigram (of those that rules ask for), ordered by trigram, so a query reads only the
row groups of its own trigrams; a long posting list is dealt over many partitions.  Postings are intersected per alternative by combining
bits, which Spark does inside each task first; a trigram that a third of all texts hold is
just more postings, spread by the text.  Only texts that fulfil some alternative of a rule
are searched with its expression.  A rule without mandatory trigrams has no query and
scans every text.

Spans come from the expression itself: the text split at its matches and the matches
give, by running lengths, code-point offsets of the leftmost non-overlapping matches.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce
from itertools import product
from re import _parser  # the standard library's own parse of an expression

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalith.durable import materialize
from catalith.layout import dictionary_join
from catalith.llm.common import ascii_lower
from catalith.llm.registry import query


@dataclass(frozen=True)
class Rule:
    """A kind of secret: matches of ``pattern`` whose group ``group`` has ``least`` characters or more."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


# The three base kinds.  A run of hexadecimal digits or of access-key characters is taken whole, so
# asking for its least length in the expression finds the same matches as dropping the short ones.
BASE = (
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    Rule("access", r"AKIA[A-Z0-9]{12,}"),
    Rule("hex", r"[0-9a-f]{32,}"),
)
#: Public formats of further credentials.
FURTHER = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{4,}"),
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
)
RULES = BASE + FURTHER
#: Strings spelled out for a part of an expression, and alternatives of a query, at most; beyond, a part asks for nothing.
EXACT, ALTERNATIVES, CLASS = 64, 64, 16
#: Trigrams of one alternative that are asked for (bits of a long).
ASKED = 62
#: Pieces a trigram's posting list is dealt into.
PIECES = 64

Query = frozenset  # of alternatives; an alternative is a frozenset of trigrams, all needed
ANYTHING: Query = frozenset({frozenset()})


def _fold(text: str) -> str:
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def _simple(q: Query) -> Query:
    """Without alternatives that need more than another one does."""
    least = frozenset(a for a in q if not any(b < a for b in q))
    return ANYTHING if len(least) > ALTERNATIVES or frozenset() in least else least


def _both(a: Query, b: Query) -> Query:
    joint = _simple(frozenset(x | y for x, y in product(a, b)))
    return joint if joint != ANYTHING else (a if b == ANYTHING else b if a == ANYTHING else min(a, b, key=len))


def _of_strings(strings: set[str]) -> Query:
    return _simple(frozenset(frozenset(s[i:i + 3] for i in range(len(s) - 2)) for s in strings))


def _chars(items: list) -> set[str] | None:
    """The characters of a class, folded; None for a negated or large one."""
    out: set[str] = set()
    for op, value in items:
        if op is _parser.LITERAL:
            out.add(_fold(chr(value)))
        elif op is _parser.RANGE and value[1] - value[0] < CLASS:
            out |= {_fold(chr(c)) for c in range(value[0], value[1] + 1)}
        else:
            return None
    return out if len(out) <= CLASS else None


def _part(op: object, value: object) -> tuple[set[str] | None, Query]:
    """What one part of an expression matches: its strings if they are few, and the query all of them fulfil."""
    if op is _parser.LITERAL:
        return {_fold(chr(value))}, ANYTHING
    if op is _parser.IN:
        return _chars(value), ANYTHING
    if op is _parser.AT:
        return {""}, ANYTHING
    if op is _parser.SUBPATTERN:
        return _sequence(value[-1])
    if op is _parser.BRANCH:
        parts = [_sequence(b) for b in value[1]]
        strings = [s for s, _ in parts]
        if all(s is not None for s in strings) and sum(map(len, strings)) <= EXACT:
            return set().union(*strings), ANYTHING
        return None, _simple(frozenset().union(*(q if s is None else _of_strings(s) for s, q in parts)))
    if op in (_parser.MAX_REPEAT, _parser.MIN_REPEAT, getattr(_parser, "POSSESSIVE_REPEAT", None)):
        low, high, inner = value
        strings, q = _sequence(inner)
        if strings is not None and high <= 4:
            spelled = set()
            for n in range(low, high + 1):
                spelled |= {"".join(p) for p in product(strings, repeat=n)} if len(strings) ** n <= EXACT else {None}
            if None not in spelled and len(spelled) <= EXACT:
                return spelled, ANYTHING
        return None, (ANYTHING if not low else q if strings is None else _of_strings({s * low for s in strings}) if len(strings) == 1 else _of_strings(strings))
    return None, ANYTHING


def _sequence(parts: object) -> tuple[set[str] | None, Query]:
    run, q, whole = {""}, ANYTHING, True
    for op, value in parts:
        strings, inner = _part(op, value)
        if strings is not None and len(run) * len(strings) <= EXACT:
            run = {a + b for a in run for b in strings}
            continue
        q, whole = _both(_both(q, _of_strings(run)), inner), False
        run = {""} if strings is None else strings
    return (run, ANYTHING) if whole else (None, _both(q, _of_strings(run)))


def trigram_query(pattern: str) -> Query:
    """Alternatives of trigrams (A-Z lower-cased) of which one is wholly in every text that ``pattern`` matches; ``ANYTHING`` if none is mandatory."""
    strings, q = _sequence(_parser.parse(pattern))
    return q if strings is None else _of_strings(strings)


def query_rows(rules: tuple[Rule, ...]) -> list[tuple[str, int, int, int, int]]:
    """``(trigram, rule, alternative, bit, all bits)`` for the rules that have a query."""
    rows = []
    for r, rule in enumerate(rules):
        if (q := trigram_query(rule.pattern)) == ANYTHING:
            continue
        for n, needed in enumerate(sorted(map(sorted, q))):
            asked = needed[:ASKED]
            rows += [(t, r, n, 1 << b, (1 << len(asked)) - 1) for b, t in enumerate(asked)]
    return rows


def _one_of(trigrams: list[str]) -> str:
    """An expression that finds, at each place, whether a trigram starts there (branching on its first character)."""
    by_first: dict[str, list[str]] = {}
    for t in trigrams:
        by_first.setdefault(t[0], []).append(re.escape(t[1:]))
    return "(?i)(?=(" + "|".join(f"{re.escape(c)}(?:{'|'.join(rest)})" for c, rest in sorted(by_first.items())) + "))"


def text_key(key: Column, text: Column) -> Column:
    """A row's name in the index; two rows that share one by chance become candidates together and are then searched."""
    return F.xxhash64(key.cast("string"), text)


def inverted_index(docs: DataFrame, trigrams: list[str], key: str = "doc_id", text: str = "text") -> DataFrame:
    """Stored postings ``(trigram, k)``, ordered by trigram: the texts that hold each of ``trigrams``, upper case A-Z taken as lower."""
    found = F.array_distinct(F.regexp_extract_all(F.col(text), F.lit(_one_of(trigrams)), 1))
    held = F.array_distinct(F.transform(found, ascii_lower))
    rows = docs.select(F.explode(held).alias("trigram"), text_key(F.col(key), F.col(text)).alias("k"))
    # By hash, not by range: range bounds would have to be sampled, by reading all texts once more.
    return materialize(rows.repartition("trigram", F.pmod("k", F.lit(PIECES))).sortWithinPartitions("trigram", "k"), "trigrams")


def candidates(index: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """``(k, rules)``: the texts whose postings fulfil a rule's query, with one bit per such rule."""
    rows = query_rows(rules)
    asked = index.sparkSession.createDataFrame(rows, "trigram string, rule int, alternative int, bit long, want long")
    wanted = index.filter(F.col("trigram").isin(sorted({r[0] for r in rows})))
    met = (wanted.join(F.broadcast(asked), "trigram").groupBy("k", "rule", "alternative", "want").agg(F.bit_or("bit").alias("got"))
           .filter("got = want"))
    return met.groupBy("k").agg(F.bit_or(F.expr("shiftleft(1L, rule)")).alias("rules"))


def matches(text: Column, rule: Rule, number: int) -> Column:
    """Spans ``{start, kind, end}`` of the rule's matches in ``text``, left to right."""
    expr = F.lit(rule.pattern)
    found = [F.split(text, rule.pattern, -1).alias("before"), F.regexp_extract_all(text, expr, 0).alias("match")]
    if rule.group:
        found.append(F.regexp_extract_all(text, expr, rule.group).alias("part"))
    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")

    def step(state: Column, m: Column) -> Column:
        start = state["at"] + F.length(m["before"])
        end = start + F.coalesce(F.length(m["match"]), F.lit(0))
        long = F.coalesce(F.length(m["part" if rule.group else "match"]) >= rule.least, F.lit(False))
        span = F.struct(start.alias("start"), F.lit(number).alias("kind"), end.alias("end"))
        return F.struct(end.alias("at"), F.when(long, F.array_append(state["spans"], span)).otherwise(state["spans"]).alias("spans"))

    first = F.struct(F.lit(0).alias("at"), none.alias("spans"))
    # Texts without a match, by far the most, are neither split nor folded.
    return F.when(F.regexp_like(text, expr), F.aggregate(F.arrays_zip(*found), first, step, lambda s: s["spans"])).otherwise(none)


def find_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(k, spans)`` for every row of ``docs``: all spans ``{start, kind, end}`` by start, then rule number.

    Offsets are code points, the end exclusive; rules count from 0 and do not exclude each other.
    Null and empty texts have none.  Repeated rows each get a row; null keys are kept; other columns are not read.
    """
    if len(rules) > 63:
        raise ValueError("at most 63 rules")
    table = docs.select(F.col(key).alias("k"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    table = table.withColumn("name", text_key(F.col("k"), F.col("text")))
    asked = sorted({r[0] for r in query_rows(rules)})
    if asked:
        hits = materialize(candidates(inverted_index(table, asked, "k"), rules), "candidates").withColumnRenamed("k", "name")
        table = dictionary_join(table, hits, ["name"], "left")
    else:
        table = table.withColumn("rules", F.lit(None).cast("long"))
    held = {r[1] for r in query_rows(rules)}
    parts = []
    for n, rule in enumerate(rules):
        spans = matches(F.col("text"), rule, n)
        if n in held:
            asked_for = F.coalesce(F.col("rules").bitwiseAND(F.lit(1 << n)) != 0, F.lit(False))
            spans = F.when(asked_for, spans).otherwise(F.array().cast("array<struct<start:int,kind:int,end:int>>"))
        parts.append(spans)
    return table.select("k", F.array_sort(F.concat(*parts)).alias("spans"))


def written(spans: Column, rules: tuple[Rule, ...]) -> Column:
    """``kind:start:end`` of all spans, joined by commas."""
    kinds = F.array(*(F.lit(r.kind) for r in rules))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(kinds, s["kind"] + 1), s["start"], s["end"])), ",")


def _sql_kind(n: int, rule: Rule) -> str:
    p = rule.pattern.replace("'", "''")
    return (f"SELECT doc_id, {n} AS n, '{rule.kind}' AS kind, {rule.least} AS least, string_split_regex(x, '{p}') AS p, "
            f"regexp_extract_all(x, '{p}', 0) AS m, regexp_extract_all(x, '{p}', {rule.group}) AS v FROM d")


SQL = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS x FROM documents),
f AS ({reduce(lambda a, b: f"{a} UNION ALL {b}", (_sql_kind(n, r) for n, r in enumerate(RULES)))}),
g AS (SELECT *, unnest(generate_series(1, len(m))) AS i FROM f),
s AS (SELECT doc_id, n, kind, len(m[i]) AS size,
             CAST(length(array_to_string(p[1:i], '')) + length(array_to_string(m[1:i - 1], '')) AS BIGINT) AS start
      FROM g WHERE length(v[i]) >= least),
t AS (SELECT doc_id, n, kind, start, kind || ':' || start || ':' || (start + size) AS one FROM s),
r AS (SELECT doc_id, count(*) FILTER (kind = 'assign') AS a, count(*) FILTER (kind = 'access') AS c, count(*) FILTER (kind = 'hex') AS h,
             string_agg(one, ',' ORDER BY start, n) FILTER (n < {len(BASE)}) AS base, string_agg(one, ',' ORDER BY start, n) AS spans
      FROM t GROUP BY doc_id)
SELECT doc_id, coalesce(a, 0) AS n_assign, coalesce(c, 0) AS n_access, coalesce(h, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN r USING (doc_id)
"""


def _count(number: int) -> Column:
    return F.size(F.filter("spans", lambda s: s["kind"] == number)).cast("long")


@query("op12_secrets", SQL)
def op12(spark: SparkSession, folder: str) -> DataFrame:
    rows = find_secrets(spark.read.parquet(f"{folder}/documents.parquet"))
    counts = [_count(n).alias(f"n_{r.kind}") for n, r in enumerate(BASE)]
    base = F.filter("spans", lambda s: s["kind"] < len(BASE))
    return rows.select(F.col("k").alias("doc_id"), *counts, F.sha2(written(base, RULES), 256).alias("base_sha256"),
                       written(F.col("spans"), RULES).alias("spans"))
