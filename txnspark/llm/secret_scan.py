"""Secret scans with a trigram index, in DataFrame functions only.

From each rule's regex a Boolean query over trigrams is derived: alternatives, each a
set of lower-case trigrams that a match must contain.  The index holds postings
(trigram, document) for the trigrams that any query asks for.  Postings are
intersected by counting, a rule's candidates are verified by its regex, and rules
without mandatory trigrams are run on every text.  Offsets are code points.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnspark.scratch import materialize, scratch_path

#: Candidate documents (an id and a few names each) that may be broadcast.
BROADCAST_DOCS = 500_000
#: Alternatives of one regex up to which a trigram query is worth deriving.
ALTERNATIVES = 256
MASK = "[REDACTED]"


def either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


@dataclass(frozen=True)
class Rule:
    """A regex; matches whose group ``group`` has fewer than ``least`` characters are dropped."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0
    base: bool = False


_KEYS = "|".join(["password", "passwd", "secret", "token"])
_KEY = "(" + "|".join([*map(either_case, _KEYS.split("|")), either_case("api") + "_?" + either_case("key")]) + ")"
RULES = (
    # Runs of a class have one longest match, so the bounds of these two can stand in the regex.
    Rule("assign", _KEY + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6, base=True),
    Rule("access", "AKIA[A-Z0-9]{16,}", base=True),
    Rule("hex", "[0-9a-f]{24,}", base=True),
    Rule("pem", "-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("slack", "xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", "AIza[A-Za-z0-9_-]{35}"),
)


def _fragments(tokens) -> list[tuple[str, ...]]:
    """Alternatives of a parsed regex, each the literal runs that any match of it contains."""
    out: list[tuple[str, ...]] = [("",)]

    def then(options):
        nonlocal out
        out = [a[:-1] + (a[-1] + b[0],) + b[1:] for a, b in product(out, options)]
        if len(out) > ALTERNATIVES:
            out = [("",)]  # too many to tell: nothing is mandatory

    for op, arg in tokens:
        name = str(op)
        if name == "LITERAL":
            then([(chr(arg).lower(),)])
        elif name == "IN" and all(str(k) == "LITERAL" for k, _ in arg) and len({chr(c).lower() for _, c in arg}) == 1:
            then([(chr(arg[0][1]).lower(),)])
        elif name == "SUBPATTERN":
            then(_fragments(arg[-1]))
        elif name == "BRANCH":
            then([x for option in arg[1] for x in _fragments(option)])
        elif name in ("MAX_REPEAT", "MIN_REPEAT", "POSSESSIVE_REPEAT"):
            least, most, inner = arg
            once = _fragments(inner)
            if most == 1:
                then(once if least else [("",), *once])
            else:
                then([(*x, "") for x in once] if least else [("", "")])
                if least:
                    then([("", "")])
        elif name != "AT":
            then([("", "")])
    return out


def trigram_query(pattern: str) -> list[frozenset[str]] | None:
    """Alternatives of trigrams that a match contains; None if some match has no mandatory trigram."""
    query = {
        frozenset(run[k : k + 3] for run in runs for k in range(len(run) - 2))
        for runs in _fragments(re._parser.parse(pattern))
    }
    return sorted(query, key=sorted) if all(query) else None


def build_index(docs: DataFrame, id_col: str, text_col: str, trigrams: list[str], path: str) -> DataFrame:
    """Postings (trigram, id) of all rows with an id, stored at ``path``."""
    low = docs.filter(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), F.lower(text_col).alias("low"))
    held = F.array_compact(F.array(*[F.when(F.contains("low", F.lit(t)), F.lit(t)) for t in trigrams]))
    low.select("id", F.explode(held).alias("trigram")).write.parquet(path)
    return docs.sparkSession.read.schema(
        f"id {docs.schema[id_col].dataType.simpleString()}, trigram string"
    ).parquet(path)


def candidates(postings: DataFrame, queries: dict[str, list[frozenset[str]]]) -> DataFrame:
    """(id, kinds): the rules whose query a document's postings satisfy."""
    spark = postings.sparkSession
    terms = [(t, kind, k, len(c)) for kind, q in queries.items() for k, c in enumerate(q) for t in sorted(c)]
    asked = spark.createDataFrame(terms, "trigram string, kind string, clause int, need int")
    met = postings.distinct().join(F.broadcast(asked), "trigram").groupBy("id", "kind", "clause", "need").count()
    return met.filter("count = need").groupBy("id").agg(F.collect_set("kind").alias("kinds"))


def _spans(rule: Rule, rank: int) -> Column:
    """Spans (start, end, rank, kind) of a rule in column ``text``."""
    pattern = F.lit(rule.pattern)
    found = F.regexp_extract_all("text", pattern, F.lit(0))
    tested = F.regexp_extract_all("text", pattern, F.lit(rule.group))
    parts = F.arrays_zip(
        F.transform(F.slice(F.split("text", rule.pattern, -1), 1, F.size(found)), F.length).alias("gap"),
        F.transform(found, F.length).alias("size"),
        F.transform(tested, F.length).alias("tested"),
    )
    empty = F.array().cast("array<struct<start:int,end:int,rank:int,kind:string>>")

    def step(acc, x):
        start = acc["at"] + x["gap"]
        end = start + x["size"]
        span = F.struct(start.alias("start"), end.alias("end"), F.lit(rank).alias("rank"), F.lit(rule.kind).alias("kind"))
        more = F.when(x["tested"] >= rule.least, F.concat(acc["out"], F.array(span))).otherwise(acc["out"])
        return F.struct(end.alias("at"), more.alias("out"))

    walked = F.aggregate(parts, F.struct(F.lit(0).alias("at"), empty.alias("out")), step, lambda acc: acc["out"])
    return F.when(F.col("text").rlike(rule.pattern), walked).otherwise(empty)


def scan_secrets(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    rules: tuple[Rule, ...] = RULES,
    keep: list[str] | None = None,
) -> DataFrame:
    """Columns ``keep`` (all by default) with ``secrets``, the spans (start, end, rank, kind) in order.

    Null and empty texts have none.  Rows that share an id share its candidates and are
    verified one by one; rows without an id are verified against every rule.  Columns
    of ``docs`` named secrets are replaced.
    """
    keep = [c for c in (docs.columns if keep is None else keep) if c != "secrets"]
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    queries = {r.kind: trigram_query(r.pattern) for r in rules}
    asked = {kind: q for kind, q in queries.items() if q is not None}
    trigrams = sorted({t for q in asked.values() for c in q for t in c})
    full = docs.select(*[F.col(c).alias(f"_k{k}") for k, c in enumerate(keep)], F.col(id_col).alias("_id"), text.alias("text"))
    if trigrams:
        postings = build_index(docs.select(F.col(id_col).alias("_id"), text.alias("text")), "_id", "text", trigrams,
                               scratch_path(docs.sparkSession, "postings"))
        found, n = materialize(candidates(postings, asked).withColumnRenamed("id", "_cid"), "candidates")
        full = full.join(F.broadcast(found) if n <= BROADCAST_DOCS else found, F.col("_id") == F.col("_cid"), "left")
    else:
        full = full.withColumn("kinds", F.lit(None).cast("array<string>"))
    empty = F.array().cast("array<struct<start:int,end:int,rank:int,kind:string>>")
    each = []
    for rank, rule in enumerate(rules):
        spans = _spans(rule, rank)
        if queries[rule.kind] is not None:
            chosen = F.col("_id").isNull() | F.coalesce(F.array_contains("kinds", rule.kind), F.lit(False))
            spans = F.when(chosen, spans).otherwise(empty)
        each.append(spans)
    return full.select(
        *[F.col(f"_k{k}").alias(c) for k, c in enumerate(keep)], F.sort_array(F.concat(*each)).alias("secrets")
    )


def redact(text: Column, spans: Column, mask: str = MASK) -> Column:
    """``text`` with the code points of sorted ``spans`` replaced; overlapping spans become one mask."""

    def step(acc, x):
        gap = F.substring(text, acc["at"] + 1, x["start"] - acc["at"])
        fresh = x["start"] >= acc["at"]
        return F.struct(
            F.greatest(acc["at"], x["end"]).alias("at"),
            F.when(fresh, F.concat(acc["out"], gap, F.lit(mask))).otherwise(acc["out"]).alias("out"),
        )

    done = F.aggregate(
        spans,
        F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
        step,
        lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))),
    )
    return F.when(F.size(spans) > 0, done).otherwise(text)


def report(scanned: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Counts, digest of the base spans and all spans as text, from ``doc_id`` and ``secrets``."""

    def told(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def size(kind):
        return F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long")

    base = [r.kind for r in rules if r.base]
    counts = [size(k).alias(f"n_{k}") for k in base]
    own = F.filter("secrets", lambda s: s["kind"].isin(base))
    return scanned.select(
        "doc_id", *counts, F.sha2(told(own).cast("binary"), 256).alias("base_sha256"), told(F.col("secrets")).alias("spans")
    )


def _rule_sql(rank: int, rule: Rule) -> str:
    pattern = rule.pattern.replace("'", "''")
    return f"""list_filter(list_transform(range(1, len(regexp_extract_all(text, '{pattern}')) + 1), lambda i: {{
        'start': coalesce(list_sum(list_transform(string_split_regex(text, '{pattern}')[1:i], lambda x: length(x))), 0)::BIGINT
               + coalesce(list_sum(list_transform(regexp_extract_all(text, '{pattern}')[1:i - 1], lambda x: length(x))), 0)::BIGINT,
        'size': length(regexp_extract_all(text, '{pattern}')[i]),
        'rank': {rank}, 'kind': '{rule.kind}',
        'tested': length(regexp_extract_all(text, '{pattern}', {rule.group})[i])}}), lambda s: s.tested >= {rule.least})"""


_TOLD = "array_to_string(list_transform({0}, lambda s: s.kind || ':' || s.start || ':' || (s.start + s.size)), ',')"
_BASE = [r.kind for r in RULES if r.base]
ORACLE = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
m AS (SELECT doc_id, {", ".join(f"{_rule_sql(k, r)} AS {r.kind}" for k, r in enumerate(RULES))} FROM d),
a AS (SELECT *, list_sort({" || ".join(f"list_transform({r.kind}, lambda s: {{'start': s.start, 'rank': s.rank, 'size': s.size, 'kind': s.kind}})" for r in RULES)}) AS alls FROM m)
SELECT doc_id, {", ".join(f"len({k})::BIGINT AS n_{k}" for k in _BASE)},
       sha256({_TOLD.format("list_filter(alls, lambda s: s.rank < " + str(len(_BASE)) + ")")}) AS base_sha256,
       {_TOLD.format("alls")} AS spans
FROM a
"""
