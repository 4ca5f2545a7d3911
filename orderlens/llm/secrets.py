"""Secret scans through a trigram inverted index, in DataFrame operations only.

Every rule is a regular expression. A Boolean query of trigrams that any match must contain is derived from it. The
index holds, per block of documents and per trigram that some query asks for, the documents that contain it. Queries
intersect and unite these posting lists; only their candidates are verified with the expression itself. A rule without
mandatory trigrams scans every text.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from re import _parser as syntax

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK_DOCUMENTS = 4096
MOST_ALTERNATIVES = 64
SPANS = "array<struct<start:int,kind:int,stop:int>>"
BREAK = None


@dataclass(frozen=True)
class Rule:
    """Leftmost non-overlapping matches of ``pattern``; those whose ``group`` is shorter than ``least`` are dropped."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


#: Runs of 16 and more are asked for in the expression itself: a maximal run is matched whole or not at all.
RULES = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 18),
    Rule("hex", r"[0-9a-f]{16,}"),
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{4,}"),
    Rule("login", r"[a-z]+://[^\s:/@]+:[^\s:/@]+@[a-z0-9.-]+"),
)
BASE = ("assign", "access", "hex")


def literal_runs(nodes) -> list[list[str | None]]:
    """The alternatives of a parsed expression, each as characters and breaks; a break stands for anything."""
    ways: list[list[str | None]] = [[]]
    for kind, value in nodes:
        name = str(kind)
        if name == "LITERAL":
            more = [[chr(value).lower()]]
        elif name == "SUBPATTERN":
            more = literal_runs(value[3])
        elif name == "BRANCH":
            more = [way for branch in value[1] for way in literal_runs(branch)]
        elif name == "IN" and all(str(k) == "LITERAL" for k, _ in value) and len(value) <= 8:
            more = [[chr(v).lower()] for _, v in value]
        elif name in ("MAX_REPEAT", "MIN_REPEAT", "POSSESSIVE_REPEAT"):
            least, most, inner = value
            once = literal_runs(inner) if most == 1 or least else [[BREAK]]
            more = (once if least == most == 1 else [[], *once]) if most == 1 else [[*way, BREAK] for way in once]
            if least == 0 and most != 1:
                more = [[BREAK]]
        else:
            more = [[BREAK]]
        joined = [a + b for a in ways for b in more]
        ways = joined if len(joined) <= MOST_ALTERNATIVES else [[*way, BREAK] for way in ways]
    return ways


def trigram_query(pattern: str) -> list[frozenset[str]] | None:
    """Alternatives of lower-case trigrams: a match contains all of at least one. None: nothing is mandatory."""
    query = []
    for way in literal_runs(syntax.parse(pattern)):
        runs = "".join("\0" if char is BREAK else char for char in way).split("\0")
        trigrams = frozenset(run[i : i + 3] for run in runs for i in range(len(run) - 2))
        if not trigrams:
            return None
        query.append(trigrams)
    return [one for one in dict.fromkeys(query) if not any(other < one for other in query)]


def posting_lists(docs: DataFrame, trigrams: list[str], blocks: int) -> DataFrame:
    """The inverted index: per block, a map from each trigram's number to the ids of the block that contain it.

    A list holds a block's documents at most, and blocks do not grow with the input; there are more of them.
    """
    body = F.lower("body")
    held = F.array_compact(F.array(*(F.when(F.contains("low", F.lit(t)), F.lit(i)) for i, t in enumerate(trigrams))))
    block = F.pmod(F.xxhash64("id"), F.lit(blocks)).alias("block")
    terms = docs.where(F.col("id").isNotNull()).select("id", body.alias("low")).select("id", block, F.explode(held).alias("t"))
    lists = terms.groupBy("block", "t").agg(F.collect_set("id").alias("ids"))
    return lists.groupBy("block").agg(F.map_from_entries(F.collect_list(F.struct("t", "ids"))).alias("lists"))


def candidates(docs: DataFrame, rules: tuple[Rule, ...], block_documents: int) -> DataFrame:
    """(id, kinds): for each document in any rule's candidates, the numbers of these rules."""
    queries = {i: trigram_query(rule.pattern) for i, rule in enumerate(rules)}
    asked = {i: query for i, query in queries.items() if query is not None}
    trigrams = sorted({t for query in asked.values() for one in query for t in one})
    number = {t: i for i, t in enumerate(trigrams)}
    blocks = max(1, -(-docs.count() // block_documents))
    nobody = F.array().cast("array<bigint>")

    def posting(trigram: str) -> Column:
        return F.coalesce(F.element_at("lists", number[trigram]), nobody)

    def ids(query: list[frozenset[str]]) -> Column:
        return reduce(F.array_union, (reduce(F.array_intersect, map(posting, sorted(one))) for one in query))

    index = posting_lists(docs, trigrams, blocks)
    each = F.array(*(F.struct(F.lit(i).alias("kind"), ids(query).alias("ids")) for i, query in asked.items()))
    per_rule = index.select(F.explode(each).alias("r")).select("r.kind", F.explode("r.ids").alias("id"))
    return per_rule.groupBy("id").agg(F.collect_set("kind").alias("kinds"))


def spans_of(text: Column, rule: Rule, kind: int) -> Column:
    """The spans of a rule in a text: what lies between the matches gives their places, in code points."""
    pattern = F.lit(rule.pattern)
    lengths = [F.transform(F.split(text, rule.pattern, -1), F.length)]
    lengths += [F.transform(F.regexp_extract_all(text, pattern, F.lit(g)), F.length) for g in (0, rule.group)]
    steps = F.arrays_zip(*(column.alias(name) for column, name in zip(lengths, ("gap", "whole", "part"), strict=True)))
    first = F.struct(F.lit(0).alias("at"), F.array().cast(SPANS).alias("found"))

    def step(state: Column, x: Column) -> Column:
        start = state["at"] + x["gap"]
        stop = start + F.coalesce(x["whole"], F.lit(0))
        span = F.struct(start.alias("start"), F.lit(kind).alias("kind"), stop.alias("stop"))
        keeps = F.coalesce(x["part"] >= max(1, rule.least), F.lit(False))
        found = F.when(keeps, F.concat(state["found"], F.array(span))).otherwise(state["found"])
        return F.struct(stop.alias("at"), found.cast(SPANS).alias("found"))

    return F.aggregate(steps, first, step, lambda state: state["found"])


def scan_secrets(
    docs: DataFrame,
    rules: tuple[Rule, ...] = RULES,
    doc_id: str = "doc_id",
    text: str = "text",
    block_documents: int = BLOCK_DOCUMENTS,
) -> DataFrame:
    """All columns of ``docs``, and ``secret_spans``: (start, kind, stop) of every match of every rule in the whole text.

    ``kind`` is the rule's place in ``rules``; places are code points, the end exclusive; sorted by start, then kind.
    One row per input row, repeated rows included. Null and empty texts have no spans. ``doc_id`` must be a long; rows
    without one are verified against every rule. A column named ``secret_spans`` is replaced.
    """
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    named = docs.select(F.col(f"`{doc_id}`").alias("id"), body.alias("body"))
    kept = [name for name in docs.columns if name.lower() != "secret_spans"]
    key, kinds = "secret_id", "secret_kinds"
    while {key, kinds} & {name.lower() for name in kept}:
        key, kinds = f"{key}_", f"{kinds}_"
    found = candidates(named, rules, block_documents).select(F.col("id").alias(key), F.col("kinds").alias(kinds))
    matched = F.col(f"`{doc_id}`") == F.col(key)
    joined = docs.select(*(F.col(f"`{name}`") for name in kept)).join(found.hint("merge"), matched, "left")
    spans = []
    for i, rule in enumerate(rules):
        if trigram_query(rule.pattern) is None:
            here = body.rlike(rule.pattern)
        else:
            here = F.coalesce(F.array_contains(kinds, i), F.col(f"`{doc_id}`").isNull())
        spans.append(F.when(here, spans_of(body, rule, i)).otherwise(F.array().cast(SPANS)))
    return joined.select(*(F.col(f"`{name}`") for name in kept), F.array_sort(F.concat(*spans)).alias("secret_spans"))


def as_text(spans: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """Spans as ``kind:start:stop``, comma-joined."""
    names = F.array(*(F.lit(rule.kind) for rule in rules))
    one = F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["stop"].cast("string")))
    return F.array_join(one, ",")


def of_kinds(spans: Column, kinds: tuple[str, ...], rules: tuple[Rule, ...] = RULES) -> Column:
    """Only the spans of the named rules."""
    numbers = [i for i, rule in enumerate(rules) if rule.kind in kinds]
    return F.filter(spans, lambda s: s["kind"].isin(numbers))


def redacted(text: Column, spans: Column, marker: str = "[SECRET]") -> Column:
    """The text with a marker in place of each span; spans that overlap share one."""
    body = F.coalesce(text, F.lit(""))
    first = F.struct(F.lit(0).alias("at"), F.lit("").alias("done"))

    def step(state: Column, span: Column) -> Column:
        before = F.substr(body, state["at"] + 1, F.greatest(span["start"] - state["at"], F.lit(0)))
        fresh = F.when(span["start"] >= state["at"], F.concat(before, F.lit(marker))).otherwise(F.lit(""))
        at = F.greatest(state["at"], span["stop"]).alias("at")
        return F.struct(at, F.concat(state["done"], fresh).alias("done"))

    whole = F.aggregate(spans, first, step, lambda state: F.concat(state["done"], F.substr(body, state["at"] + 1)))
    return F.when(F.size(spans) > 0, whole).otherwise(text)
