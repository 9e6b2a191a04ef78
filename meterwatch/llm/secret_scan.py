"""Secret scan with a trigram inverted index, in DataFrame operations only.

From the pattern of each rule a Boolean query over trigrams is derived: the strings that a
match must contain, as an OR of ANDs. The index holds a posting (trigram, document) for every
trigram that some rule asks for. Postings are intersected per document, and only candidates
are verified with the rule's pattern. A rule without a mandatory trigram scans every text.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterwatch.llm.common import keyed

try:  # the standard library's own reading of a pattern
    from re import _constants as sre
    from re import _parser as sre_parse
except ImportError:  # before Python 3.11
    import sre_constants as sre
    import sre_parse


@dataclass(frozen=True)
class Rule:
    """A kind of secret: a match of ``pattern`` counts if its ``group`` has ``least`` characters."""
    kind: str
    pattern: str
    group: int = 0
    least: int = 0


#: The base rules. Matches are found first and short ones dropped then.
BASE_RULES = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]+", 0, 24),
)

#: Type of the spans of a text.
SPANS = "array<struct<start:int,order:int,kind:string,end:int>>"
#: A query is a set of alternatives; each is a set of trigrams that must all be there.
Query = frozenset[frozenset[str]]
#: Alternatives of a literal that are followed; beyond it the literal is cut, which only widens the candidates.
ALTERNATIVES = 64


def mandatory_strings(pattern: str) -> list[list[str]]:
    """For each piece that every match holds: the lower-case strings of which one is there.

    Repetitions from zero and classes end a piece; an optional literal or a branch
    multiplies its alternatives.
    """
    pieces: list[list[str]] = []
    open_piece = [""]

    def close() -> None:
        nonlocal open_piece
        if all(open_piece):
            pieces.append(open_piece)
        open_piece = [""]

    def extend(options: list[str]) -> None:
        nonlocal open_piece
        grown = sorted({a + b for a in open_piece for b in options})
        if len(grown) > ALTERNATIVES:
            close()
            grown = options
        open_piece = grown

    def simple(items) -> list[str] | None:
        """All strings that ``items`` can match, or None if they are not a short list."""
        found = [""]
        for op, value in items:
            if op is sre.LITERAL:
                options = [chr(value).lower()]
            elif op is sre.SUBPATTERN:
                options = simple(value[-1])
            elif op is sre.BRANCH:
                branches = [simple(x) for x in value[1]]
                options = None if None in branches else [s for x in branches for s in x]
            elif op is sre.MAX_REPEAT and value[1] is not sre.MAXREPEAT and value[1] <= 2:
                inner = simple(value[2])
                options = None if inner is None else [s * k for s in inner for k in range(value[0], value[1] + 1)]
            else:
                options = None
            if options is None or len(found) * len(options) > ALTERNATIVES:
                return None
            found = sorted({a + b for a in found for b in options})
        return found

    def walk(items) -> None:
        for item in items:
            options = simple([item])
            if options is not None:
                extend(options)
            elif item[0] is sre.SUBPATTERN:
                walk(item[1][-1])
            else:
                close()

    walk(sre_parse.parse(pattern))
    close()
    return pieces


def trigram_query(pattern: str) -> Query | None:
    """The Boolean trigram query of a pattern, None if no trigram is mandatory."""
    best: Query | None = None
    for piece in mandatory_strings(pattern):
        if min(map(len, piece)) < 3:
            continue
        query = frozenset(frozenset(s[i:i + 3] for i in range(len(s) - 2)) for s in piece)
        # an alternative that asks for more than another one adds nothing
        query = frozenset(a for a in query if not any(b < a for b in query))
        if best is None or min(map(len, query)) > min(map(len, best)):
            best = query
    return best


def postings(docs: DataFrame, trigrams: list[str]) -> DataFrame:
    """(trigram, doc_id, text_key) for the asked trigrams that the lower-cased text holds."""
    text = F.lower("text")
    held = F.array_compact(F.array(*[F.when(F.contains("low", F.lit(t)), F.lit(t)) for t in trigrams]))
    return docs.select("doc_id", "text_key", text.alias("low")).select(
        F.explode(held).alias("trigram"), "doc_id", "text_key")


def candidates(index: DataFrame, queries: dict[str, Query]) -> DataFrame:
    """doc_id, text_key, kinds: the rules whose query the document's postings satisfy.

    The postings meet per document, so a trigram that lies in a third of all
    documents is spread like any other; they are combined before the shuffle.
    """
    def holds(query: Query) -> Column:
        alternatives = [reduce(lambda a, b: a & b, [F.array_contains("held", t) for t in sorted(a)]) for a in sorted(query, key=sorted)]
        return reduce(lambda a, b: a | b, alternatives)

    met = index.groupBy("doc_id", "text_key").agg(F.collect_set("trigram").alias("held"))
    kinds = F.array_compact(F.array(*[F.when(holds(q), F.lit(k)) for k, q in queries.items()]))
    return met.select("doc_id", "text_key", kinds.alias("kinds")).filter(F.size("kinds") > 0)


def _bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once however often it is used."""
    return F.transform(F.array(value), body)[0]


def _spans(rule: Rule, order: int) -> Column:
    """array<struct<start, order, kind, end>> of a rule's matches that are long enough, in code points.

    Pieces between matches and matches, in turn, add up to the places. Matches are
    walked in blocks of the square root of their number, as appending to an array copies it.
    """
    none = F.array().cast(SPANS)
    whole = F.regexp_extract_all("text", F.lit(rule.pattern), F.lit(0))
    value = F.regexp_extract_all("text", F.lit(rule.pattern), F.lit(rule.group)) if rule.group else F.array().cast("array<string>")
    found = F.struct(F.split("text", rule.pattern, -1).alias("between"), whole.alias("whole"), value.alias("value"))

    def steps(found: Column) -> Column:
        lengths = F.zip_with(F.slice(found["between"], 1, F.size(found["whole"])), found["whole"], lambda gap, m: F.struct(
            F.char_length(gap).alias("gap"), F.char_length(m).alias("long")))
        if not rule.group:
            return F.transform(lengths, lambda s: F.struct(s["gap"].alias("gap"), s["long"].alias("long"), s["long"].alias("value")))
        return F.zip_with(lengths, found["value"], lambda s, v: F.struct(
            s["gap"].alias("gap"), s["long"].alias("long"), F.char_length(v).alias("value")))

    def walk(steps: Column) -> Column:
        block = F.ceil(F.sqrt(F.size(steps))).cast("int")

        def step(acc: Column, s: Column) -> Column:
            start, end = acc["at"] + s["gap"], acc["at"] + s["gap"] + s["long"]
            hit = F.struct(start.alias("start"), F.lit(order).alias("order"), F.lit(rule.kind).alias("kind"), end.alias("end"))
            return F.struct(end.alias("at"), F.when(s["value"] >= rule.least, F.array_append(acc["out"], hit)).otherwise(acc["out"]).alias("out"))

        def run(acc: Column, first: Column) -> Column:
            return F.aggregate(F.slice(steps, first, block), F.struct(acc["at"].alias("at"), none.alias("out")), step,
                               lambda r: F.struct(r["at"].alias("at"), F.array_append(acc["out"], r["out"]).alias("out")))

        firsts = F.when(F.size(steps) > 0, F.sequence(F.lit(1), F.size(steps), F.greatest(block, F.lit(1)))).otherwise(F.array().cast("array<int>"))
        start = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{SPANS}>").alias("out"))
        return F.aggregate(firsts, start, run, lambda acc: F.flatten(acc["out"]))

    return _bound(found, lambda f: _bound(steps(f), walk))


def _cheap_test(rule: Rule) -> str:
    """A pattern that every text with a counting match holds, for texts that are scanned."""
    run = re.fullmatch(r"(\[[^\]]+\])\+", rule.pattern)
    return f"{run[1]}{{{rule.least}}}" if run and rule.group == 0 else rule.pattern


def scan_secrets(docs: DataFrame, rules: tuple[Rule, ...] = BASE_RULES, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """doc_id, text_key, spans (array<struct<start, order, kind, end>>) for every row of ``docs``.

    Spans of all rules by start, then by the order of the rules; leftmost matches
    that do not overlap within a rule, places in code points, end exclusive. NULL
    and empty texts have no spans; rows with a NULL id and repeated rows are
    scanned like any other. A text is scanned whole however long it is; its spans are
    one array, found in time near the number of its matches.
    """
    docs = keyed(docs, id_col, text_col)
    queries = {r.kind: q for r in rules if (q := trigram_query(r.pattern)) is not None}
    if queries:
        asked = sorted({t for q in queries.values() for a in q for t in a})
        found = candidates(postings(docs, asked), queries).withColumnRenamed("doc_id", "found_id")
        docs = docs.join(found.withColumnRenamed("text_key", "found_key"), F.expr(
            "text_key = found_key and doc_id <=> found_id"), "left").select("doc_id", "text_key", "text", "kinds")
    none = F.array().cast(SPANS)
    parts = []
    for k, rule in enumerate(rules):
        if rule.kind in queries:
            wanted = F.coalesce(F.array_contains("kinds", rule.kind), F.lit(False))
        else:
            wanted = F.col("text").rlike(_cheap_test(rule))
        parts.append(F.when(wanted, _spans(rule, k)).otherwise(none))
    return docs.select("doc_id", "text_key", F.array_sort(F.concat(*parts)).alias("spans"))


def secret_digest(docs: DataFrame, rules: tuple[Rule, ...] = BASE_RULES) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans (text) for every row of ``docs``."""
    def written(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    base = [r.kind for r in BASE_RULES]
    found = scan_secrets(docs, rules)
    counts = [F.size(F.expr(f"filter(spans, s -> s.kind = '{k}')")).cast("long").alias(f"n_{k}") for k in base]
    return found.select("doc_id", *counts, F.sha2(written(F.filter("spans", lambda s: s["kind"].isin(base))), 256).alias("base_sha256"),
                        written(F.col("spans")).alias("spans"))


SQL = r"""
with t as (select doc_id, coalesce(text, '') as text from documents),
m as (
  select doc_id, text, 'assign' as kind, 0 as o,
         '((?i:password|passwd|secret|token|api_?key))["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)' as p, 2 as g, 6 as least from t
  union all select doc_id, text, 'access', 1, 'AKIA[A-Z0-9]+', 0, 20 from t
  union all select doc_id, text, 'hex', 2, '[0-9a-f]+', 0, 24 from t),
f as (
  select doc_id, kind, o, least,
         case kind when 'assign' then string_split_regex(text, '((?i:password|passwd|secret|token|api_?key))["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)')
                   when 'access' then string_split_regex(text, 'AKIA[A-Z0-9]+') else string_split_regex(text, '[0-9a-f]+') end as gaps,
         case kind when 'assign' then regexp_extract_all(text, '((?i:password|passwd|secret|token|api_?key))["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 0)
                   when 'access' then regexp_extract_all(text, 'AKIA[A-Z0-9]+') else regexp_extract_all(text, '[0-9a-f]+') end as hits,
         case kind when 'assign' then regexp_extract_all(text, '((?i:password|passwd|secret|token|api_?key))["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 2)
                   when 'access' then regexp_extract_all(text, 'AKIA[A-Z0-9]+') else regexp_extract_all(text, '[0-9a-f]+') end as vals
  from m),
u as (select doc_id, kind, o, least, unnest(hits) as hit, unnest(vals) as val, unnest(gaps[1:len(hits)]) as gap,
             generate_subscripts(hits, 1) as k from f where len(hits) > 0),
s as (select doc_id, kind, o, least, length(val) as n,
             sum(length(gap) + length(hit)) over (partition by doc_id, kind order by k) as e, length(hit) as l from u),
j as (select doc_id, count(*) filter (where kind = 'assign') as n_assign, count(*) filter (where kind = 'access') as n_access,
             count(*) filter (where kind = 'hex') as n_hex,
             string_agg(kind || ':' || cast(e - l as bigint) || ':' || cast(e as bigint), ',' order by e - l, o) as spans
      from s where n >= least group by doc_id)
select doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access, coalesce(n_hex, 0) as n_hex,
       sha256(coalesce(spans, '')) as base_sha256, coalesce(spans, '') as spans
from t left join j using (doc_id)
"""
