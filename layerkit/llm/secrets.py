"""Secret scans over a trigram inverted index.

Each rule is a regular expression. From its parse tree comes a Boolean query
of trigrams that any match must contain (after Cox 2012). The index holds,
for the trigrams the rules ask for, which documents contain them
(case-folded); grouping the postings by document intersects them, and a
document is a candidate of a rule when its trigrams satisfy the rule's query.
Candidates are verified with the expression itself. Rules without mandatory
trigrams (long hexadecimal runs) scan every document.

Matches are leftmost and non-overlapping per rule, as code-point spans, end
exclusive.

Defined cases: a NULL text counts as empty; rows of equal id and text share
their postings and each get their own result; NULL ids are ids like any
other; an empty table gives an empty index and no rows; other columns are
ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from re import _constants as op
from re import _parser as parser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerkit.llm.common import col, let, small, stage

# Strings an exact set may hold before it is turned into a query.
EXACT = 64


@dataclass(frozen=True)
class Rule:
    """A kind of secret. ``group`` must have ``shortest`` characters at least,
    or the match is dropped."""

    kind: str
    pattern: str
    ignore_case: bool = False
    group: int = 0
    shortest: int = 0
    flags: int = field(init=False)

    def __post_init__(self):
        object.__setattr__(self, "flags", re.ASCII | (re.IGNORECASE if self.ignore_case else 0))

    def compiled(self) -> re.Pattern:
        return re.compile(self.pattern, self.flags)


# The base rules, in the order of their kinds. Runs too short
# are dropped as matches; for ``access`` and ``hex`` that equals asking for
# the length in the pattern, since a later start in the same run is shorter.
BASE_RULES = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", True, 2, 6),
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
)
# Further kinds the scan adds.
MORE_RULES = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[0-9A-Za-z_-]{35}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("private_key", r"-----BEGIN (?:[A-Z]+ ){0,4}PRIVATE KEY-----"),
)
RULES = BASE_RULES + MORE_RULES


# ---- Boolean trigram queries --------------------------------------------------
# A query is True (nothing is mandatory), a trigram, or ("and" | "or", parts).


def _all(parts) -> object:
    parts = list(dict.fromkeys(p for p in parts if p is not True))
    return True if not parts else parts[0] if len(parts) == 1 else ("and", tuple(parts))


def _any(parts) -> object:
    parts = list(dict.fromkeys(parts))
    if True in parts or not parts:
        return True
    return parts[0] if len(parts) == 1 else ("or", tuple(parts))


def _of_strings(strings: set[str]) -> object:
    sets = {frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings}
    # a set that holds another adds nothing beside it
    least = sorted(sorted(a) for a in sets if not any(b < a for b in sets))
    return _any(_all(a) for a in least)


def _fold(code: int) -> str | None:
    c = chr(code).lower()
    return c if len(c) == 1 else None


def _members(items) -> set[str] | None:
    """The folded characters of a class, None when there are too many."""
    out = set()
    for kind, arg in items:
        if kind is op.LITERAL:
            codes = [arg]
        elif kind is op.RANGE and arg[1] - arg[0] < EXACT:
            codes = range(arg[0], arg[1] + 1)
        else:
            return None
        out |= {_fold(c) for c in codes}
    return out if None not in out and len(out) <= 8 else None


def _walk(seq) -> tuple[set[str] | None, object]:
    """(the exact strings, or None; the query) of a parsed sequence."""
    exact, query, whole = {""}, True, True

    def spend():
        nonlocal exact, query, whole
        query, exact, whole = _all([query, _of_strings(exact)]), {""}, False

    for kind, arg in seq:
        strings, sub = None, True
        if kind is op.LITERAL:
            c = _fold(arg)
            strings = {c} if c else None
        elif kind is op.IN:
            strings = _members(arg)
        elif kind is op.SUBPATTERN:
            strings, sub = _walk(arg[3])
        elif kind is op.BRANCH:
            each = [_walk(s) for s in arg[1]]
            if all(s is not None for s, _ in each):
                strings = set().union(*(s for s, _ in each))
            sub = _any(_of_strings(s) if s is not None else q for s, q in each)
        elif kind in (op.MAX_REPEAT, op.MIN_REPEAT, op.POSSESSIVE_REPEAT):
            lo, hi, body = arg
            s, q = _walk(body)
            if s is not None and (lo, hi) == (0, 1):
                strings = s | {""}
            elif s is not None and lo == hi and lo <= 4 and len(s) ** lo <= EXACT:
                strings = {""}
                for _ in range(lo):
                    strings = {a + b for a in strings for b in s}
            elif lo:
                sub = _of_strings(s) if s is not None else q
        elif kind in (op.AT, op.ASSERT, op.ASSERT_NOT):
            continue
        if strings is not None and len(exact) * len(strings) <= EXACT:
            exact = {a + b for a in exact for b in strings}
            continue
        spend()
        if strings is not None and len(strings) <= EXACT:
            exact = strings  # a new exact stretch begins
        else:
            query = _all([query, sub])
    if whole:
        return exact, _of_strings(exact)
    return None, _all([query, _of_strings(exact)])


def trigram_query(rule: Rule) -> object:
    """The trigrams every match of ``rule`` must contain, case-folded."""
    return _walk(parser.parse(rule.pattern, rule.flags))[1]


def grams_of(query) -> set[str]:
    if query is True:
        return set()
    return {query} if isinstance(query, str) else set().union(*map(grams_of, query[1]))


def holds(query, grams: Column) -> Column:
    """Whether an array of trigrams satisfies a query."""
    if query is True:
        return F.lit(True)
    if isinstance(query, str):
        return F.array_contains(grams, query)
    parts = [holds(q, grams) for q in query[1]]
    out = parts[0]
    for p in parts[1:]:
        out = out & p if query[0] == "and" else out | p
    return out


# ---- index, candidates, verification ------------------------------------------


def _keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(
        col(doc_id).alias("doc_id"), F.xxhash64(col(text)).alias("text_hash"), F.coalesce(col(text), F.lit("")).alias("text")
    )


def inverted_index(keyed: DataFrame, grams: set[str]) -> DataFrame:
    """Postings ``(gram, doc_id, text_hash)`` of the asked-for trigrams."""
    asked = F.array(*[F.lit(g) for g in sorted(grams)]).cast("array<string>")
    there = let(F.lower("text"), lambda t: F.filter(asked, lambda g: F.contains(t, g)))
    return keyed.select(F.explode(there).alias("gram"), "doc_id", "text_hash")


def candidates(postings: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """``(doc_id, text_hash, rules)``: the rules whose query the document's
    trigrams satisfy; documents without any are left out."""
    grams = postings.groupBy("doc_id", "text_hash").agg(F.collect_set("gram").alias("grams"))
    queries = {r.kind: trigram_query(r) for r in rules}
    each = [F.when(holds(q, F.col("grams")), F.lit(k)) for k, q in queries.items() if q is not True]
    named = F.array_compact(F.array(*each)) if each else F.array().cast("array<string>")
    return grams.select("doc_id", "text_hash", named.alias("rules")).where(F.size("rules") > 0)


def spans_of(text: str, rules: list[Rule]) -> list[tuple[int, int, int]]:
    """(start, place of the rule, end) of every match kept, in order."""
    out = []
    for place, r in enumerate(rules):
        for m in r.compiled().finditer(text):
            if len(m.group(r.group)) >= r.shortest:
                out.append((m.start(), place, m.end()))
    return sorted(out)


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, spans)`` for every row: ``spans`` is an array of
    ``(kind, start, end)`` by start, then by the order of the rules."""
    keyed = _keyed(docs, doc_id, text)
    queries = {r.kind: trigram_query(r) for r in rules}
    grams = set().union(*map(grams_of, queries.values()))
    postings = stage(inverted_index(keyed, grams), "trigram-index")
    found = small(stage(candidates(postings, rules), "secret-candidates"))
    found = found.select(F.col("doc_id").alias("hit_id"), F.col("text_hash").alias("hit_hash"), "rules")
    same = F.col("doc_id").eqNullSafe(F.col("hit_id")) & (F.col("text_hash") == F.col("hit_hash"))
    always = {k for k, q in queries.items() if q is True}

    @F.pandas_udf("array<struct<kind: string, start: int, end: int>>")
    def verify(texts: pd.Series, named: pd.Series) -> pd.Series:
        out = []
        for t, n in zip(texts, named):
            run = always if n is None else always.union(n)
            mine = [r for r in rules if r.kind in run]
            out.append([{"kind": mine[p].kind, "start": s, "end": e} for s, p, e in spans_of(t, mine)])
        return pd.Series(out)

    return keyed.join(found, same, "left").select("doc_id", verify("text", "rules").alias("spans"))


def digest(spans: Column) -> Column:
    """``kind:start:end`` of the spans, comma-joined."""
    one = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")
