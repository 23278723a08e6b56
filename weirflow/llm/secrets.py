"""Secret scans by a trigram inverted index, in DataFrame operations only (operator 7).

Each rule's regex gives a Boolean query over trigrams (``trigrams.query``).  The index says of every trigram
that the queries name which rows hold it; it is kept beside the rows, as one bit of each posting list, so that
lists are intersected and united by bit operations where the texts are, and neither ids nor texts move.  A
rule's regex is run on the candidates of its query; a rule without a mandatory trigram is run on every text.

Positions come from the text itself: the parts between matches and the matches follow each other, so the
running sums of their lengths are the offsets.

Cases: a null text has no span; an empty table gives an empty result; equal rows give equal rows, whatever
their doc_id; a null doc_id is kept; other columns of the input are kept by ``scan``, but one of the
result's name gives way to it.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common, trigrams


@dataclass(frozen=True)
class Rule:
    """A kind of secret: what its matches are, and the least length of one of its groups."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0

    @property
    def query(self) -> trigrams.Query:
        return trigrams.query(self.pattern)


# The kinds of the contract, in its order.  Hex runs are taken at their least length at once,
# which gives the same runs, as each is as long as it can be.
RULES = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 16),
    Rule("hex", r"[0-9a-f]{32,}"),
)
MASK = "[REDACTED]"


#: Posting lists whose bits share a column.
BITS = 60


def postings(text: Column, grams: list[tuple[str, bool]]) -> list[Column]:
    """A row's entries in the posting lists of the grams, as bits of long columns."""
    low = F.lower(text)
    out = []
    for at in range(0, len(grams), BITS):
        bits = [F.when((low if fold else text).contains(g), F.lit(1 << k)).otherwise(F.lit(0)).cast("long") for k, (g, fold) in enumerate(grams[at : at + BITS])]
        out.append(reduce(Column.bitwiseOR, bits))
    return out


def candidate(query: trigrams.Query, grams: list[tuple[str, bool]], lists: list[Column]) -> Column:
    """Whether a row is in the lists that the query asks for."""
    place = {g: divmod(k, BITS) for k, g in enumerate(grams)}

    def masks(some) -> dict[int, int]:
        out: dict[int, int] = {}
        for g in some:
            word, bit = place[g]
            out[word] = out.get(word, 0) | 1 << bit
        return out

    def met(q: trigrams.Query) -> Column:
        if q is True:
            return F.lit(True)
        kind, parts = q if isinstance(q[1], tuple) else ("and", (q,))
        own = [p for p in parts if not isinstance(p[1], tuple)]
        if kind == "and":
            tests = [lists[w].bitwiseAND(F.lit(m)) == m for w, m in masks(own).items()]
        else:
            tests = [lists[w].bitwiseAND(F.lit(m)) != 0 for w, m in masks(own).items()]
        tests += [met(p) for p in parts if isinstance(p[1], tuple)]
        return reduce(Column.__and__ if kind == "and" else Column.__or__, tests)

    return met(query)


def _spans(rule: Rule, text: Column, runs: Column) -> Column:
    """Array of (start, end) of a rule's matches in a text; empty where ``runs`` is false."""
    pattern = F.lit(rule.pattern)
    whole = F.regexp_extract_all(text, pattern, F.lit(0))
    sized = F.regexp_extract_all(text, pattern, F.lit(rule.group))
    steps = F.arrays_zip(F.split(text, rule.pattern, -1).alias("part"), whole.alias("match"), sized.alias("value"))
    empty = F.array().cast("array<struct<start:int,end:int>>")
    begin = F.struct(F.lit(0).alias("at"), empty.alias("found"))

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.length(x["part"])
        end = start + F.length(x["match"])
        span = F.array(F.struct(start.alias("start"), end.alias("end")))
        return F.struct(F.coalesce(end, start).alias("at"), F.when(F.length(x["value"]) >= rule.least, F.concat(acc["found"], span)).otherwise(acc["found"]).alias("found"))

    # a text without a match isn't parted; a text that is parted has one part more than matches
    found = F.aggregate(steps, begin, step, lambda acc: acc["found"])
    return F.when(runs & text.rlike(rule.pattern), found).otherwise(empty)


def _of_kind(spans: Column, kind: int) -> Column:
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(kind).alias("kind"), s["end"].alias("end")))


def _count(kind: int) -> Column:
    return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES, into: str = "spans") -> DataFrame:
    """The input with ``into``: an array of (start, kind's place, end) in order, of each whole text."""
    queries = [r.query for r in rules]
    grams = sorted({g for q in queries for g in trigrams.grams(q)})
    kept = [c for c in docs.columns if c != into]
    names = common.fresh(kept, *[f"postings_{k}" for k in range(-(-len(grams) // BITS))])
    text = F.coalesce(F.col("text"), F.lit(""))
    indexed = docs.select(*common.quoted(kept), *[p.alias(n) for p, n in zip(postings(text, grams), names)])
    lists = [F.col(n) for n in names]
    kinds = [_of_kind(_spans(rule, text, candidate(query, grams, lists)), k) for k, (rule, query) in enumerate(zip(rules, queries))]
    return indexed.select(*common.quoted(kept), F.array_sort(F.concat(*kinds)).alias(into))


def listed(spans: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    names = F.array(*[F.lit(r.kind) for r in rules])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def masked(text: Column, spans: Column, mask: str = MASK) -> Column:
    """The text with every span, or union of spans that overlap, given as the mask."""
    begin = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        gap = F.concat(acc["out"], F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.lit(mask))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.when(s["start"] >= acc["at"], gap).otherwise(acc["out"]).alias("out"))

    done = F.aggregate(spans, begin, step, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))
    return F.when(F.size(spans) > 0, done).otherwise(text)


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(common.table(spark, sf_dir, "documents"))
    counts = [_count(k).alias(f"n_{r.kind}") for k, r in enumerate(RULES)]
    spans = listed(F.col("spans"))
    return found.select("doc_id", *counts, F.sha2(spans.cast("binary"), 256).alias("base_sha256"), spans.alias("spans"))


def _oracle_kind(kind: str, pattern: str, group: int, least: int) -> str:
    quoted = pattern.replace("'", "''")
    return f"""select doc_id, rn, {[r.kind for r in RULES].index(kind)} k, '{kind}' kind, start_ s, start_ + length(m) e from (
      select doc_id, rn, unnest(ms) m, unnest(vs) v, unnest(list_transform(range(1, len(ms) + 1), lambda j: list_sum(list_transform(ps[1:j], lambda p: length(p))) + coalesce(list_sum(list_transform(ms[1:j-1], lambda p: length(p))), 0))) start_
      from (select doc_id, rn, regexp_extract_all(text, '{quoted}', 0) ms, regexp_extract_all(text, '{quoted}', {group}) vs, string_split_regex(text, '{quoted}') ps from d)) where length(v) >= {least}"""


ORACLE = f"""
with d as (select doc_id, coalesce(text, '') as text, row_number() over () rn from documents),
s as ({" union all ".join(_oracle_kind(r.kind, r.pattern, r.group, r.least) for r in RULES)}),
j as (select rn, count(*) filter (k = 0) a, count(*) filter (k = 1) b, count(*) filter (k = 2) c, string_agg(kind || ':' || cast(s as bigint) || ':' || cast(e as bigint), ',' order by s, k) spans from s group by rn)
select d.doc_id, coalesce(a, 0) n_assign, coalesce(b, 0) n_access, coalesce(c, 0) n_hex, sha256(coalesce(spans, '')) base_sha256, coalesce(spans, '') spans
from d left join j using (rn)
"""
