"""Quality rules as a short-circuit cascade.

Each rule rejects a text by a cheap count over it. ``plan_cascade`` measures, on a bounded sample, what
each rule costs per document and which share it rejects, and orders the rules by rejections per second. The
sample is measured where it lies, in all tasks, and one row per rule comes back.
``quality_filter`` then evaluates them in that order, a batch at a time, each rule only on the documents
that no earlier rule rejected. The verdict (no rule rejects) doesn't depend on the order, so a different
sample changes the speed only.

Cases: a null or empty text has no words and is rejected as too short; an empty table gives an empty
result; repeated rows and ties are judged row by row; other columns pass through untouched, whatever their
names; one very long text is one piece of work.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vacantia.llm import _text as T

SYMBOLS = T.byte_table(*((ord(c), ord(c)) for c in "#*$%&|<>"))
LETTERS = T.byte_table((65, 90), (97, 122), (128, 255))
UPPER = T.byte_table((65, 90))
ASCII_LETTERS = T.byte_table((65, 90), (97, 122))
#: Documents that the order of the cascade is estimated on.
SAMPLE = 2000


class Texts:
    """Rows of text and the counts that rules use, each computed once when first asked for."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, self.offsets = data, offsets

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def take(self, rows: np.ndarray) -> Texts:
        sizes = np.diff(self.offsets)[rows]
        return Texts(self.data[T.ranges(self.offsets[rows], sizes)], np.concatenate([[0], np.cumsum(sizes)]))

    @cached_property
    def inside(self) -> np.ndarray:
        return T.NOT_SPACE[self.data]

    @cached_property
    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return T.spans(self.inside, self.offsets)

    @cached_property
    def n_words(self) -> np.ndarray:
        return np.diff(self.words[2])

    @cached_property
    def sums(self) -> np.ndarray:
        return T.prefix_sums(T.BYTE_VALUES[self.data])

    @cached_property
    def word_chars(self) -> np.ndarray:
        return T.per_row(self.inside & ((self.data & 0xC0) != 0x80), self.offsets)

    def count(self, table: np.ndarray) -> np.ndarray:
        return T.per_row(table[self.data], self.offsets)

    @cached_property
    def n_symbols(self) -> np.ndarray:
        return self.count(SYMBOLS)

    @cached_property
    def _lines(self) -> tuple[np.ndarray, np.ndarray]:
        """Of each row, the lines with a word, and those among them that are equal to an earlier one."""
        starts, ends, first = T.lines(self.data, self.offsets)
        seen = np.zeros(len(self.data) + 1, np.int64)
        np.cumsum(self.inside, out=seen[1:])
        row = np.repeat(np.arange(len(self)), np.diff(first))
        full = seen[ends] > seen[starts]
        row, h = row[full], T.span_hashes(self.sums, starts[full], ends[full])
        n = np.bincount(row, minlength=len(self))
        _, at = np.unique(T.mix(h + row.astype(T.U64) * T.U64(0xA24BAED4963EE407)), return_index=True)
        return n, n - np.bincount(row[at], minlength=len(self))

    @property
    def n_lines(self) -> np.ndarray:
        return self._lines[0]

    @property
    def n_dup_lines(self) -> np.ndarray:
        return self._lines[1]

    @cached_property
    def n_repeat_words(self) -> np.ndarray:
        starts, ends, first = self.words
        h, at, row = T.word_grams(T.span_hashes(self.sums, starts, ends), first, 3)
        key = T.mix(h + row.astype(T.U64) * T.U64(0xA24BAED4963EE407))
        order = np.argsort(key)
        same = key[order][1:] == key[order][:-1]
        twice = np.zeros(len(key), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        edge = np.zeros(len(starts) + 3, np.int64)
        np.add.at(edge, at[twice], 1)
        np.add.at(edge, at[twice] + 3, -1)
        return T.per_row(np.cumsum(edge)[: len(starts)] > 0, first)

    @cached_property
    def n_lettered(self) -> np.ndarray:
        """Words with a letter."""
        starts, ends, first = self.words
        seen = np.zeros(len(self.data) + 1, np.int64)
        np.cumsum(LETTERS[self.data], out=seen[1:])
        return T.per_row(seen[ends] > seen[starts], first)


Rule = Callable[[Texts], np.ndarray]
#: The two rules of the base verdict, and the others; each says which rows it rejects.
BASE_RULES: dict[str, Rule] = {
    "too_short": lambda t: t.n_words < 50,
    "repetitive": lambda t: 100 * t.n_repeat_words > 50 * t.n_words,
}
RULES: dict[str, Rule] = BASE_RULES | {
    "symbols": lambda t: 10 * t.n_symbols > t.n_words,
    "exclaiming": lambda t: 2 * t.count(T.byte_table((33, 33))) > t.n_words,
    "upper_case": lambda t: 100 * t.count(UPPER) > 30 * np.maximum(t.count(ASCII_LETTERS), 1),
    "repeated_lines": lambda t: 2 * t.n_dup_lines > t.n_lines,
    "few_letters": lambda t: 100 * t.n_lettered < 70 * t.n_words,
    "word_length": lambda t: (t.word_chars < 2 * t.n_words) | (t.word_chars > 12 * t.n_words),
}


def _texts(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[tuple[pa.RecordBatch, Texts]]:
    for batch in batches:
        for piece in T.pieces(batch, column):
            yield piece, Texts(*T.utf8(piece.column(column)))


def plan_cascade(docs: DataFrame, text_col: str = "text", rules: dict[str, Rule] | None = None, sample: int = SAMPLE) -> list[str]:
    """Names of the rules, most rejections per second first, as measured on about ``sample`` documents drawn at random."""
    rules = rules or RULES

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spent, rejected = dict.fromkeys(rules, 0.0), dict.fromkeys(rules, 0)
        for _, texts in _texts(batches, "text"):
            for name, rule in rules.items():
                alone, began = Texts(texts.data, texts.offsets), time.perf_counter()
                rejected[name] += int(rule(alone).sum())
                spent[name] += time.perf_counter() - began
        yield pa.RecordBatch.from_pydict({"rule": list(rules), "seconds": list(spent.values()), "rejected": list(rejected.values())})

    T.importable(docs.sparkSession)
    total = docs.count()  # of a Parquet table its files say it
    drawn = docs.select(docs[text_col].alias("text")).sample(min(1.0, sample / max(total, 1)), seed=11)
    sums = drawn.mapInArrow(measure, "rule string, seconds double, rejected long").groupBy("rule").agg(F.sum("seconds").alias("seconds"), F.sum("rejected").alias("rejected"))
    rate = dict.fromkeys(rules, 0.0) | {r.rule: r.rejected / max(r.seconds, 1e-9) for r in sums.collect()}
    return sorted(rules, key=lambda n: (-rate[n], list(rules).index(n)))


def cascade(texts: Texts, order: list[str], rules: dict[str, Rule], alive: np.ndarray | None = None) -> np.ndarray:
    """Which rows no rule rejects; a rule sees the rows that are left only."""
    kept = np.flatnonzero(alive) if alive is not None else np.arange(len(texts))
    now = texts if len(kept) == len(texts) else texts.take(kept)
    for name in order:
        if not len(kept):
            break
        stays = ~rules[name](now)
        if not stays.all():
            rows = np.flatnonzero(stays)
            kept, now = kept[rows], now.take(rows) if len(rows) else now
    out = np.zeros(len(texts), bool)
    out[kept] = True
    return out


def quality_filter(docs: DataFrame, text_col: str = "text", rules: dict[str, Rule] | None = None, order: list[str] | None = None) -> DataFrame:
    """The documents that no rule rejects, with their columns unchanged."""
    rules = rules or RULES
    order = order or plan_cascade(docs, text_col, rules)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, texts in _texts(batches, text_col):
            yield piece.filter(pa.array(cascade(texts, order, rules)))

    T.importable(docs.sparkSession)
    return docs.mapInArrow(run, docs.schema)


def quality_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", order: list[str] | None = None) -> DataFrame:
    """One row per document: the base counts, the base verdict, and the verdict of the whole cascade.

    The cascade runs on the documents that pass the base rules, whose counts are needed for every row.
    """
    extra = {k: r for k, r in RULES.items() if k not in BASE_RULES}
    order = [n for n in order or plan_cascade(docs, text_col, extra) if n in extra]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, t in _texts(batches, "text"):
            failed = np.logical_or.reduce([rule(t) for rule in BASE_RULES.values()])
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), *map(pa.array, (t.n_words, t.word_chars, t.n_symbols, t.n_dup_lines, t.n_repeat_words, failed, cascade(t, order, extra, ~failed)))],
                names=["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"],
            )

    T.importable(docs.sparkSession)
    return docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text")).mapInArrow(
        run, "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean"
    )


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_report(spark.read.parquet(f"{sf_dir}/documents.parquet"))


ORACLE_SQL = r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (
  SELECT doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS rows_
  FROM t),
g AS (SELECT doc_id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS gram
      FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM w WHERE len(words) >= 3)),
d AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, gram) AS n FROM g) WHERE n > 1),
r AS (SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words FROM d, (VALUES (0), (1), (2)) AS o(k) GROUP BY doc_id),
c AS (
  SELECT w.doc_id, len(words)::BIGINT AS n_words,
         length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         len(rows_)::BIGINT AS n_lines, (len(rows_) - len(list_distinct(rows_)))::BIGINT AS n_dup_lines,
         coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
         length(regexp_replace(text, '[^!]', '', 'g')) AS n_excl,
         length(regexp_replace(text, '[^A-Z]', '', 'g')) AS n_upper,
         length(regexp_replace(text, '[^A-Za-z]', '', 'g')) AS n_ascii,
         len(list_filter(words, lambda x: regexp_matches(x, '[A-Za-z]|[^\x00-\x7F]'))) AS n_lettered
  FROM w LEFT JOIN r ON r.doc_id = w.doc_id),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM c)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 10 * n_symbols > n_words OR 2 * n_excl > n_words OR 100 * n_upper > 30 * greatest(n_ascii, 1)
            OR 2 * n_dup_lines > n_lines OR 100 * n_lettered < 70 * n_words
            OR word_chars < 2 * n_words OR word_chars > 12 * n_words) AS kept
FROM b"""
