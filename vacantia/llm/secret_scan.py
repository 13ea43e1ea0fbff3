"""Secret scan over a trigram inverted index, in DataFrame functions only.

Each rule is a regex. ``trigram_query`` derives from it a Boolean query of trigrams (lower case) that any
match must contain; a rule without one (such as a run of hex digits) has none. The index holds, for the
trigrams that rules need, posting lists of documents cut into blocks of ``BLOCK`` ids, so no list grows
with the corpus. A lookup joins a block's lists by intersections and unions and gives the candidate
(document, rule) pairs; then candidates are verified with the regex itself, and rules without a query
scan every text. Spans come from the matches and the texts between them, in code points.

Cases: a null or empty text has no spans; an empty table gives none; repeated ids share their candidates
and are verified row by row; a row with a null id, which no posting list can name, is verified against
every rule; other columns are not read; a text is one row however long it is.
"""

from __future__ import annotations

import re._constants as C
import re._parser as parser
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from itertools import product

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BLOCK = 256
#: Matches of a text that are added up at a time.
CHUNK = 256


@dataclass(frozen=True)
class Rule:
    """Matches of ``regex`` whose ``group`` has at least ``least`` characters, under the name ``kind``.

    With ``inner`` the span is that of the group, with which the match must end."""

    kind: str
    regex: str
    group: int = 0
    least: int = 1
    inner: bool = False


#: Fixed patterns, without repeated groups, which the JVM's regex engine would recurse on. The three base kinds come first; a run of at least 16 hex digits is the same as a run
#: that is dropped when shorter, and likewise for the access keys.
RULES = [
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    Rule("access", r"AKIA[A-Z0-9]{14,}"),
    Rule("hex", r"[0-9a-f]{16,}"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("stripe", r"[sr]k_live_[A-Za-z0-9]{16,}"),
    # a token begins where a run of its letters does, so that each run is read from its start only
    Rule("jwt", r"(?:^|[^A-Za-z0-9_-])(eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+)", 1, inner=True),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
]
BASE = 3

#: A query is a trigram, or ("and" | "or", queries); None holds for every text.
Query = str | tuple[str, tuple] | None


def _join(how: str, parts: list[Query]) -> Query:
    if how == "or" and (not parts or any(p is None for p in parts)):
        return None
    parts = list(dict.fromkeys(p for p in parts if p is not None))
    if how == "or":  # a choice that demands all that another does, and more, adds nothing
        asks = {p: trigrams_of(p) for p in parts if isinstance(p, str) or p[0] == "and" and all(isinstance(x, str) for x in p[1])}
        parts = [p for p in parts if p not in asks or not any(asks[q] < asks[p] for q in asks)]
    return parts[0] if len(parts) == 1 else (how, tuple(parts)) if parts else None


def _of_strings(strings: set[str]) -> Query:
    """What a text with one of these strings must contain."""
    return _join("or", [_join("and", [s[i : i + 3] for i in range(len(s) - 2)]) for s in sorted(strings)])


def _walk(items, most: int = 64) -> tuple[set[str] | None, Query]:
    """The exact strings of a parsed regex if they are few, and the query of the whole."""
    run: set[str] = {""}
    exact, parts = True, []

    def flush() -> None:
        nonlocal run
        parts.append(_of_strings(run))
        run = {""}

    for op, arg in items:
        strings, query = None, None
        if op is C.LITERAL:
            strings = {chr(arg).lower()}
        elif op is C.IN and all(o is C.LITERAL for o, _ in arg) and len(arg) <= 8:
            strings = {chr(a).lower() for _, a in arg}
        elif op is C.SUBPATTERN:
            strings, query = _walk(arg[-1])
        elif op is C.BRANCH:
            found = [_walk(b) for b in arg[1]]
            if all(s is not None for s, _ in found):
                strings = set().union(*(s for s, _ in found))
            else:
                query = _join("or", [_join("and", [q, _of_strings(s) if s else None]) for s, q in found])
        elif op in (C.MAX_REPEAT, C.MIN_REPEAT):
            low, high, body = arg
            inner, below = _walk(body)
            if inner is not None and high == 1:
                strings = inner | {""} if low == 0 else inner
            elif low:
                query = _join("and", [below, _of_strings(inner) if inner else None])
        elif op is C.AT:
            strings = {""}
        if strings is not None and len(run) * len(strings) <= most:
            run = {a + b for a, b in product(run, strings)}
        else:
            exact = False
            flush()
            parts.append(query if strings is None else _of_strings(strings))
    if exact:
        return run, _of_strings(run)
    flush()
    return None, _join("and", parts)


def trigram_query(regex: str) -> Query:
    """The trigrams, in lower case, that a text with a match must contain; None if it needs none."""
    return _walk(parser.parse(regex))[1]


def trigrams_of(query: Query) -> set[str]:
    return set() if query is None else {query} if isinstance(query, str) else set().union(*map(trigrams_of, query[1]))


def trigram_index(docs: DataFrame, trigrams: list[str], id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """Posting lists (block, trigram, docs) of these trigrams; a list has the documents of one block of ids."""
    low = docs.select(F.col(id_col).cast("long").alias("doc"), F.lower(text_col).alias("low")).where("doc IS NOT NULL AND low <> ''")
    has = F.array_compact(F.array(*(F.when(F.contains("low", F.lit(t)), F.lit(t)) for t in trigrams)))
    entries = low.select("doc", F.floor(F.col("doc") / block).alias("block"), F.explode(has).alias("trigram"))
    return entries.groupBy("block", "trigram").agg(F.collect_set("doc").alias("docs"))


def candidates(index: DataFrame, queries: dict[str, Query]) -> DataFrame:
    """(doc, rules): the documents that satisfy each query, by intersecting and joining postings block by block."""
    blocks = index.groupBy("block").agg(F.map_from_entries(F.collect_list(F.struct("trigram", "docs"))).alias("lists"))
    none = F.array().cast("array<bigint>")

    def docs_of(q: Query) -> Column:
        if isinstance(q, str):
            return F.coalesce(F.try_element_at("lists", F.lit(q)), none)
        return reduce(F.array_intersect if q[0] == "and" else F.array_union, map(docs_of, q[1]))

    found = blocks.select(F.explode(F.array(*(F.struct(F.lit(k).alias("rule"), docs_of(q).alias("docs")) for k, q in queries.items()))).alias("f"))
    pairs = found.select("f.rule", F.explode("f.docs").alias("doc"))
    return pairs.groupBy("doc").agg(F.collect_set("rule").alias("rules"))


def spans_of(text: Column, rule: Rule, k: int) -> Column:
    """array<struct<start, k, end>> of the rule's matches that are long enough, leftmost first, in code points."""
    found = F.regexp_extract_all(text, F.lit(rule.regex), F.lit(0))
    own = F.regexp_extract_all(text, F.lit(rule.regex), F.lit(rule.group)) if rule.group else found
    empty = F.array().cast("array<struct<start:bigint,k:int,end:bigint>>")

    def step(acc: Column, m: Column) -> Column:
        start = acc["at"] + F.length(m["gap"])
        end = start + F.length(m["found"])
        begin = end - F.length(m["own"]) if rule.inner else start
        span = F.struct(begin.cast("long").alias("start"), F.lit(k).alias("k"), end.cast("long").alias("end"))
        return F.struct(end.cast("long").alias("at"), F.when(F.length(m["own"]) >= rule.least, F.concat(acc["out"], F.array(span))).otherwise(acc["out"]).alias("out"))

    length = lambda chunk: F.aggregate(chunk, F.lit(0).cast("long"), lambda n, m: n + F.length(m["gap"]) + F.length(m["found"]))

    def spans(chunks: Column) -> Column:
        begins = F.aggregate(chunks, F.array(F.lit(0).cast("long")), lambda at, chunk: F.concat(at, F.array(F.element_at(at, -1) + length(chunk))))
        return F.flatten(F.zip_with(chunks, F.slice(begins, F.lit(1), F.size(chunks)), lambda chunk, at: F.aggregate(chunk, F.struct(at.alias("at"), empty.alias("out")), step)["out"]))

    # in chunks, as an array that grows is copied with each element
    cut = lambda m: F.transform(F.sequence(F.lit(0), F.floor((F.size(m) - 1) / CHUNK).cast("int")), lambda c: F.slice(m, c * CHUNK + 1, F.lit(CHUNK)))
    zipped = lambda m: F.arrays_zip(F.slice(m["gaps"], F.lit(1), F.size(m["found"])).alias("gap"), m["found"].alias("found"), m["own"].alias("own"))
    parts = F.struct(F.split(text, rule.regex, -1).alias("gaps"), found.alias("found"), own.alias("own"))
    return F.when(text.rlike(rule.regex), _let(parts, lambda m: _let(zipped(m), lambda z: _let(cut(z), spans)))).otherwise(empty)


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with the value made once: inside a function of an array's elements it would be made for each of them."""
    return F.get(F.transform(F.array(value), use), 0)


def find_secrets(docs: DataFrame, rules: list[Rule] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and its spans, array<struct<start, k, end>> in order of start and rule; k is the rule's place in the list."""
    rules = rules or RULES
    queries = {r.kind: q for r in rules if (q := trigram_query(r.regex)) is not None}
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    known = F.lit(True)
    if queries:
        index = trigram_index(docs, sorted(set().union(*map(trigrams_of, queries.values()))), id_col, text_col)
        # texts stream past the candidates' hash table: no sort of texts, one shuffle
        # rows without an id, which join nothing, are spread by their texts
        spread = F.when(F.col("doc_id").isNull(), F.xxhash64("text")).otherwise(F.lit(0).cast("long"))
        pairs = candidates(index, queries).withColumnRenamed("doc", "doc_id").withColumn("spread", F.lit(0).cast("long"))
        rows = rows.withColumn("spread", spread).join(pairs.hint("shuffle_hash"), ["doc_id", "spread"], "left")
        known = F.col("doc_id").isNull()
    empty = F.array().cast("array<struct<start:bigint,k:int,end:bigint>>")
    found = [F.when(known | F.array_contains("rules", r.kind), spans_of(F.col("text"), r, k)).otherwise(empty) if r.kind in queries else spans_of(F.col("text"), r, k) for k, r in enumerate(rules)]
    return rows.select("doc_id", F.array_sort(F.concat(*found)).alias("spans"))


def secret_report(docs: DataFrame, **columns: str) -> DataFrame:
    """Counts and digest of the base kinds, and all spans as text."""
    names = F.array(*(F.lit(r.kind) for r in RULES))
    text = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["k"]), s["start"], s["end"])), ",")
    n = lambda k: F.size(F.filter("spans", lambda s: s["k"] == k)).cast("long")
    found = find_secrets(docs, **columns)
    return found.select(
        "doc_id",
        *(n(k).alias(f"n_{RULES[k].kind}") for k in range(BASE)),
        F.sha2(text(F.filter("spans", lambda s: s["k"] < BASE)), 256).alias("base_sha256"),
        text(F.col("spans")).alias("spans"),
    )


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_report(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def _oracle() -> str:
    """The same rows in SQL: matches and the texts between them give the spans."""
    parts = []
    inner = ", ".join(str(k) for k, r in enumerate(RULES) if r.inner)
    for k, r in enumerate(RULES):
        regex = r.regex.replace("'", "''")
        cut = f"string_split_regex(text, '{regex}')"
        found, own = (f"regexp_extract_all(text, '{regex}', {g})" for g in (0, r.group))
        parts.append(f"SELECT doc_id, {k} AS k, '{r.kind}' AS kind, {r.least} AS least, {cut} AS gaps, {found} AS found, {own} AS own FROM t WHERE regexp_matches(text, '{regex}')")
    before = "list_sum([0] || list_transform(gaps[1:i], lambda x: length(x))) + list_sum([0] || list_transform(found[1:i - 1], lambda x: length(x)))"
    return f"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
m AS ({" UNION ALL ".join(parts)}),
s AS (SELECT doc_id, k, kind, ({before} + CASE WHEN k IN ({inner}) THEN length(found[i]) - length(own[i]) ELSE 0 END)::BIGINT AS start,
  CASE WHEN k IN ({inner}) THEN length(own[i]) ELSE length(found[i]) END AS n FROM (SELECT *, unnest(range(1, len(found) + 1)) AS i FROM m) WHERE length(own[i]) >= least),
g AS (SELECT doc_id, count(*) FILTER (WHERE k = 0) AS n_assign, count(*) FILTER (WHERE k = 1) AS n_access, count(*) FILTER (WHERE k = 2) AS n_hex,
  string_agg(kind || ':' || start || ':' || (start + n), ',' ORDER BY start, k) FILTER (WHERE k < {BASE}) AS base, string_agg(kind || ':' || start || ':' || (start + n), ',' ORDER BY start, k) AS spans FROM s GROUP BY 1)
SELECT t.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM t LEFT JOIN g ON g.doc_id = t.doc_id"""


ORACLE_SQL = _oracle()
