"""Secret scans through a trigram index.

Each rule's regex is turned into a Boolean query over trigrams that every match must contain. Postings (trigram,
text) are built for the trigrams that the rules need, intersected clause by clause, and only the texts left are
searched with the regex. A rule without a mandatory trigram searches every text.

NULL and empty texts have no spans. Equal rows get equal results. Only the id and text columns are read, so other
columns may have any name.
"""

from __future__ import annotations

import re._constants as ops
import re._parser as parser
from collections.abc import Sequence
from dataclasses import dataclass
from itertools import product

from pyspark.sql import Column, DataFrame, functions as F

from chargelake.llm.common import merged_spans, replace_spans, row_key, spans_from
from chargelake.staging import fits_broadcast, staged

EXACT_STRINGS = 64

Query = list[frozenset[str]]


@dataclass(frozen=True)
class Rule:
    """``group`` must have at least ``least`` characters, or the match is dropped."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


def either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


# The three base rules, in the order in which spans of one start are listed. For a run of one class of
# characters, asking for its least length in the pattern drops the same matches as asking for it afterwards.
_KEYS = "|".join(either_case(word) for word in ("password", "passwd", "secret", "token", "api_?key"))
BASE_RULES = (
    Rule("assign", rf"""({_KEYS})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    Rule("access", r"AKIA[A-Z0-9]{12,}"),
    Rule("hex", r"[0-9a-f]{32,}"),
)
# A private key is taken from its first line to its last one, or, without that, over header and base64 lines. Line ends
# may be written as \n, as in JSON. No run is limited, and none is given back once it is read.
_BREAK = r"(?:\\[rn]|\s)++"
KEY_BLOCK = (
    r"-----BEGIN [A-Z ]*PRIVATE KEY-----(?:(?:[^-]++|-(?!----))*+-----END [A-Z ]*PRIVATE KEY-----"
    rf"|(?:{_BREAK}[A-Za-z-]+: [^\r\n\\]*+)*+(?:{_BREAK}[A-Za-z0-9+/=]{{16,}}+)++(?:{_BREAK}[A-Za-z0-9+/]{{1,15}}={{0,2}}(?![^\s\\\"']))?)?"
)
MORE_RULES = (
    Rule("hosting", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("private_key", KEY_BLOCK),
)
RULES = BASE_RULES + MORE_RULES


def trigrams(word: str) -> frozenset[str]:
    return frozenset(word[i : i + 3] for i in range(len(word) - 2))


def _shortest(query: Query) -> Query:
    """Clauses that another clause makes needless are left out. ``[frozenset()]`` is true."""
    return [c for c in dict.fromkeys(query) if not any(other < c for other in query)]


def _both(one: Query, other: Query) -> Query:
    return _shortest([a | b for a, b in product(one, other)])


def _exact(parsed) -> set[str] | None:
    """All strings that a part can match, folded to lower case; None if these are many."""
    strings = {""}
    for op, value in parsed:
        if op is ops.LITERAL:
            own = {chr(value).lower()}
        elif op is ops.IN:
            own = set()
            for kind, item in value:
                if kind is ops.LITERAL:
                    own.add(chr(item).lower())
                elif kind is ops.RANGE and item[1] - item[0] < EXACT_STRINGS:
                    own |= {chr(c).lower() for c in range(item[0], item[1] + 1)}
                else:
                    return None
        elif op is ops.SUBPATTERN:
            own = _exact(value[-1])
        elif op is ops.BRANCH:
            parts = [_exact(part) for part in value[1]]
            own = None if None in parts else set().union(*parts)
        elif op is ops.MAX_REPEAT and value[1] <= 1:
            own = _exact(value[2])
            own = own if own is None or value[0] else own | {""}
        else:
            return None
        if own is None or len(strings) * len(own) > EXACT_STRINGS:
            return None
        strings = {a + b for a in strings for b in own}
    return strings


def trigram_query(pattern: str) -> Query:
    """Clauses of trigrams, folded to lower case: every match contains all trigrams of some clause."""

    def true_if_short(strings: set[str]) -> Query:
        return _shortest([trigrams(s) for s in strings])

    def walk(parsed) -> Query:
        query, run = [frozenset()], {""}
        for node in parsed:
            own = _exact([node])
            if own is not None and len(run) * len(own) <= EXACT_STRINGS:
                run = {a + b for a in run for b in own}
                continue
            query, run = _both(query, true_if_short(run)), {""}
            op, value = node
            if own is not None:
                run = own
            elif op is ops.SUBPATTERN:
                query = _both(query, walk(value[-1]))
            elif op is ops.BRANCH:
                query = _both(query, _shortest([clause for part in value[1] for clause in walk(part)]))
            elif op is ops.MAX_REPEAT and value[0] >= 1:
                query = _both(query, walk(value[2]))
        return _both(query, true_if_short(run))

    return walk(parser.parse(pattern))


def postings(keyed: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """(trigram, key): which texts, folded to lower case, contain which of the wanted trigrams."""
    texts = keyed.select("key", F.lower("text").alias("text"))
    held = F.filter(F.array(*map(F.lit, wanted)), lambda trigram: F.contains(F.col("text"), trigram))
    return texts.select("key", F.explode_outer(held).alias("trigram")).filter("trigram IS NOT NULL")


def candidates(keyed: DataFrame, queries: dict[str, Query]) -> DataFrame:
    """(key, kinds): texts for which a rule's query holds, by intersecting postings per clause."""
    clauses = [
        F.struct(F.lit(t).alias("trigram"), F.lit(kind).alias("kind"), F.lit(i).alias("clause"), F.lit(len(c)).alias("size"))
        for kind, query in queries.items() for i, c in enumerate(query) for t in sorted(c)
    ]
    wanted = sorted({t for query in queries.values() for c in query for t in c})
    asked = keyed.sparkSession.range(1).select(F.inline(F.array(*clauses)))  # as large as the rules
    met = (
        postings(keyed, wanted).join(F.broadcast(asked), "trigram")
        .groupBy("key", "kind", "clause", "size").agg(F.count_distinct("trigram").alias("met"))
        .filter("met = size")
    )
    return met.groupBy("key").agg(F.collect_set("kind").alias("kinds"))


def with_candidates(keyed: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Add ``kinds``: the indexed rules whose query holds for the row's text.

    Candidates are broadcast to the texts while they are measured to be small; beyond that both meet in a shuffle.
    """
    queries = {rule.kind: trigram_query(rule.pattern) for rule in rules}
    indexed = {kind: query for kind, query in queries.items() if frozenset() not in query}
    if not indexed:
        return keyed.withColumn("kinds", F.array().cast("array<string>"))
    found = staged(candidates(keyed.select("key", "text"), indexed), "candidates")
    found = F.broadcast(found) if fits_broadcast(found) else found
    none = F.array().cast("array<string>")
    return keyed.join(found, "key", "left").withColumn("kinds", F.coalesce("kinds", none))


def with_spans(scanned: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Replace ``kinds`` by ``spans``: array<start, place, end, kind>, sorted; ``place`` is the rule's place in the list.

    A text is searched once per rule that may match it, and a second time only where the rule did.
    """
    carried = [name for name in scanned.columns if name != "kinds"]
    text, strings = F.col("text"), "array<string>"
    found, around, parts = [], [], []
    for place, rule in enumerate(rules):
        matches = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
        if frozenset() not in trigram_query(rule.pattern):
            matches = F.when(F.array_contains("kinds", rule.kind), matches).otherwise(F.array().cast(strings))
        found.append(matches.alias(f"found_{place}"))
        hit, own = F.size(f"found_{place}") > 0, F.col(f"found_{place}")
        values = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)) if rule.group else own
        around += [F.when(hit, F.split(text, rule.pattern, -1)).alias(f"gaps_{place}"), F.when(hit, values).alias(f"values_{place}")]
        spans = spans_from(F.col(f"gaps_{place}"), own, F.col(f"values_{place}"))
        parts.append(F.transform(
            F.filter(spans, lambda s: F.length(s["value"]) >= rule.least),
            lambda s: F.struct(
                s["start"].alias("start"), F.lit(place).alias("place"), s["end"].alias("end"), F.lit(rule.kind).alias("kind")),
        ))
    matched = scanned.select(*carried, *found)
    return matched.select(*matched.columns, *around).select(*carried, F.array_sort(F.concat(*parts)).alias("spans"))


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: Sequence[Rule] = RULES) -> DataFrame:
    """The id of each row with its secret spans, in code points, end exclusive."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    keyed = docs.select(F.col(id_col).alias("id"), text.alias("text"), row_key(F.col(id_col), text).alias("key"))
    return with_spans(with_candidates(keyed, rules), rules).select(F.col("id").alias(id_col), "spans")


def redact_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", mark: str = "[SECRET]", rules: Sequence[Rule] = RULES) -> DataFrame:
    """All rows and columns, with every secret in the text column replaced by ``mark``. A NULL text stays NULL."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    keyed = docs.select(F.struct("*").alias("row"), text.alias("text"), row_key(F.col(id_col), text).alias("key"))
    scanned = with_spans(with_candidates(keyed, rules), rules)
    clean = replace_spans(F.col("text"), merged_spans(F.col("spans")), F.lit(mark))
    cleaned = scanned.select("row", F.when(F.col(f"row.`{text_col}`").isNotNull(), clean).alias("clean"))
    return cleaned.select(*[
        F.col("clean").alias(name) if name == text_col else F.col(f"row.`{name}`") for name in docs.columns
    ])
