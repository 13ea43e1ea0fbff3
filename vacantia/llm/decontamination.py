"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

Texts become sequences of 64-bit word hashes. Patterns are windows of ``window`` words of the benchmark
items (an item of fewer words is one window). For each pattern length m there is a shift table over
blocks of B words (2, or 1 where m is 1): a block that ends k words before the nearest pattern end
allows a jump of k words, and a block in no pattern a jump of m - B + 1. A jump of 0 looks up the
suffix bucket (the block's hash) and compares the window word by word with each pattern in the bucket,
then once with its characters. All segments of a batch advance together, one numpy step per jump.

Patterns are sent to the executors in shards of at most ``shard_words`` words, a fixed bound; a larger
benchmark takes one pass of the documents per shard, and the passes are merged row by row: rows are numbered in
a table that is written once before the passes, so rows that share an id, or have none, stay apart.

Cases: a null or empty text has no words, is hit nowhere and is clean; an item without words has no
window; empty tables give clean documents or none; repeated documents are judged row by row and repeated
items each count under their own id (an id that occurs twice counts once); a null item_id never counts
as an item but its windows hit; other columns, whatever their names, are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vacantia.llm import _text as T

WINDOW = 10
#: Words of benchmark text in one broadcast shard, at most (or one longer item).
SHARD_WORDS = 2_000_000
#: Words in one lane of the search.
LANE = 512


def _sequences(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes, byte starts and ends of the words, and each row's first word."""
    starts, ends, first = T.spans(T.ALNUM_OR_HIGH[data], offsets)
    return T.span_hashes(T.prefix_sums(T.FOLDED_VALUES[data]), starts, ends), starts, ends, first


def _fold(data: np.ndarray) -> np.ndarray:
    return np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)


class Patterns:
    """Windows of one length, with their shift table, suffix buckets and owners."""

    def __init__(self, m: int, words: np.ndarray, texts: list[bytes], owners: list[np.ndarray]):
        self.m, self.block = m, min(2, m)
        self.words, self.texts, self.owners = words, texts, owners
        blocks = self.blocks(words.reshape(-1)).reshape(len(words), -1) if self.block == 1 else self._pairs(words)
        ends = m - self.block - np.arange(blocks.shape[1])  # words from the block's end to the pattern's end
        key, shift = blocks.reshape(-1), np.tile(ends, len(words))
        order = np.lexsort((shift, key))
        key, shift = key[order], shift[order]
        least = np.concatenate([[True], key[1:] != key[:-1]])
        self.keys, self.shifts = key[least], shift[least]
        suffix = blocks[:, -1]
        self.by_suffix = np.argsort(suffix, kind="stable")
        self.suffixes = suffix[self.by_suffix]
        #: A filter of one bit per hash: most blocks of clean text are in no pattern.
        self.bits = np.zeros(1 << 20, bool)
        self.bits[(self.keys >> T.U64(44)).astype(np.int64)] = True

    @staticmethod
    def _pairs(words: np.ndarray) -> np.ndarray:
        return T.mix(words[:, :-1] * T.U64(0xD1342543DE82EF95) + words[:, 1:])

    def blocks(self, words: np.ndarray) -> np.ndarray:
        """The hash of the block that ends at each word (from the second one where blocks have two)."""
        if self.block == 1:
            return T.mix(words)
        return T.mix(words[:-1] * T.U64(0xD1342543DE82EF95) + words[1:])

    def shift_of(self, key: np.ndarray) -> np.ndarray:
        out = np.full(len(key), self.m - self.block + 1)
        maybe = np.flatnonzero(self.bits[(key >> T.U64(44)).astype(np.int64)])
        if len(maybe):
            at = np.minimum(np.searchsorted(self.keys, key[maybe]), len(self.keys) - 1)
            found = self.keys[at] == key[maybe]
            out[maybe[found]] = self.shifts[at[found]]
        return out

    def search(self, words: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Occurrences inside rows: the word where each begins, and the pattern."""
        m = self.m
        if len(words) < m:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        count = np.maximum(np.diff(first) - m + 1, 0)  # windows of each row
        lanes = -(-count // LANE)
        row = np.repeat(np.arange(len(count)), lanes)
        low = first[:-1][row] + LANE * T.ranges(np.zeros(len(count), np.int64), lanes)
        # positions are those of a window's last word
        at, stop = low + m - 1, np.minimum(low + LANE, first[:-1][row] + count[row]) + m - 1
        found_at, found = [], []
        while len(at):
            if self.block == 1:
                key = T.mix(words[at])
            else:
                key = T.mix(words[at - 1] * T.U64(0xD1342543DE82EF95) + words[at])
            jump = self.shift_of(key)
            here = np.flatnonzero(jump == 0)
            if len(here):
                low_, high = (np.searchsorted(self.suffixes, key[here], side) for side in ("left", "right"))
                pos, pattern = np.repeat(at[here], high - low_), self.by_suffix[T.ranges(low_, high - low_)]
                same = (words[pos[:, None] + np.arange(1 - m, 1)] == self.words[pattern]).all(1)
                found_at.append(pos[same] - m + 1)
                found.append(pattern[same])
            at = at + np.maximum(jump, 1)
            on = at < stop
            at, stop = at[on], stop[on]
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(found_at), np.concatenate(found)


def compile_patterns(items: list[tuple[int, str | None]], window: int) -> list[Patterns]:
    """The windows of these items, equal ones merged, by length."""
    data, offsets = T.utf8(pa.array([t for _, t in items], pa.string()))
    h, starts, ends, first = _sequences(data, offsets)
    folded = _fold(data).tobytes()
    by_length: dict[int, dict[bytes, tuple[np.ndarray, set]]] = {}
    for k, (item, _) in enumerate(items):
        n = int(first[k + 1] - first[k])
        m = min(window, n)
        for at in range(int(first[k]), int(first[k + 1]) - m + 1) if m else ():
            text = b" ".join(folded[starts[j] : ends[j]] for j in range(at, at + m))
            by_length.setdefault(m, {}).setdefault(text, (h[at : at + m], set()))[1].add(item)
    return [
        Patterns(m, np.stack([w for w, _ in found.values()]), list(found), [np.array(sorted(x for x in o if x is not None), np.int64) for _, o in found.values()])
        for m, found in sorted(by_length.items())
    ]


def _shards(benchmark: DataFrame, id_col: str, text_col: str, shard_words: int) -> tuple[Iterator[list[tuple[int, str | None]]], int]:
    """Items in shards of a bounded size, and how many; one shard at a time is on the driver."""
    items = benchmark.select(F.col(id_col).cast("long").alias("item"), F.col(text_col).alias("text"))
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n = int(chars // (2 * shard_words)) + 1
    parts = (items.where(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == k) if n > 1 else items for k in range(n))
    return ([(r.item, r.text) for r in part.toLocalIterator()] for part in parts), n


def find_contamination(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW, shard_words: int = SHARD_WORDS
) -> DataFrame:
    """One row per document: key, words, the hit words as [start, end) spans, and the items with occurrences."""
    spark = docs.sparkSession
    T.importable(spark)
    schema = "row long, doc_id long, n_words long, spans array<struct<start: int, end: int>>, items array<long>"

    def one(shard: list[tuple[int, str | None]]) -> DataFrame:
        sent = spark.sparkContext.broadcast(compile_patterns(shard, window))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for piece in T.pieces(batch):
                    found = scan(piece, sent.value)
                    row = piece.column("row") if "row" in piece.schema.names else pa.nulls(piece.num_rows, pa.int64())
                    yield pa.RecordBatch.from_arrays([row, *found.columns], names=["row", *found.schema.names])

        return rows.mapInArrow(run, schema)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    shards, n = _shards(benchmark, item_col, item_text_col, shard_words)
    if n == 1:
        return one(next(shards)).drop("row")
    rows = T.written(rows.withColumn("row", F.monotonically_increasing_id()), "numbered")
    merged = reduce(DataFrame.unionByName, [one(shard) for shard in shards])
    items = F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items")
    return merged.groupBy("row").agg(F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"), F.flatten(F.collect_list("spans")).alias("spans"), items).drop("row")


def scan(piece: pa.RecordBatch, patterns: list[Patterns]) -> pa.RecordBatch:
    data, offsets = T.utf8(piece.column("text"))
    words, starts, ends, first = _sequences(data, offsets)
    rows = len(offsets) - 1
    row_of = np.repeat(np.arange(rows), np.diff(first))
    hit = np.zeros(len(words) + 1, np.int64)
    owned: list[tuple[np.ndarray, np.ndarray]] = []
    for p in patterns:
        at, which = p.search(words, first)
        if not len(at):
            continue
        # the direct comparison, once per candidate: same characters, not only the same hashes
        same = np.array([_fold(data[starts[a] : ends[a + p.m - 1]]).tobytes() for a in at], object)
        good = np.array([b" ".join(_words_of(s)) == p.texts[w] for s, w in zip(same, which)], bool)
        at, which = at[good], which[good]
        np.add.at(hit, at, 1)
        np.add.at(hit, at + p.m, -1)
        sizes = np.array([len(o) for o in p.owners], np.int64)
        if len(at):
            owned.append((np.repeat(row_of[at], sizes[which]), np.concatenate([p.owners[w] for w in which])))
    covered = np.cumsum(hit)[: len(words)] > 0
    begin, end, first_span = T.spans(covered, first)
    shift = np.repeat(first[:-1], np.diff(first_span))
    spans = pa.StructArray.from_arrays([pa.array(begin - shift, pa.int32()), pa.array(end - shift, pa.int32())], names=["start", "end"])
    row, item = (np.concatenate(x) for x in zip(*owned)) if owned else (np.zeros(0, np.int64), np.zeros(0, np.int64))
    pairs = np.unique(np.stack([row, item]), axis=1) if len(row) else np.zeros((2, 0), np.int64)
    items = pa.ListArray.from_arrays(pa.array(np.searchsorted(pairs[0], np.arange(rows + 1)), pa.int32()), pa.array(pairs[1], pa.int64()))
    return pa.RecordBatch.from_arrays(
        [piece.column("doc_id"), pa.array(np.diff(first)), pa.ListArray.from_arrays(pa.array(first_span, pa.int32()), spans), items], names=["doc_id", "n_words", "spans", "items"]
    )


def _words_of(folded: bytes) -> list[bytes]:
    data = np.frombuffer(folded, np.uint8)
    starts, ends, _ = T.spans(T.ALNUM_OR_HIGH[data], np.array([0, len(data)]))
    return [folded[s:e] for s, e in zip(starts, ends)]


def contamination_report(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """Per document the hit words and items; a document is contaminated if a word is hit."""
    found = find_contamination(docs, benchmark, **options)
    # spans of several passes may overlap: merge them in order
    merged = F.aggregate(
        F.array_sort("spans"),
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("to")),
        lambda a, s: F.struct((a["n"] + F.greatest(s["end"] - F.greatest(s["start"], a["to"]), F.lit(0))).alias("n"), F.greatest(a["to"], s["end"]).alias("to")),
    )["n"]
    ids = F.array_join(F.array_sort(F.transform("items", lambda i: i.cast("string"))), ",")
    return found.select(
        "doc_id",
        "n_words",
        merged.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(ids, 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination_report(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", window: int = WINDOW, shard_words: int = SHARD_WORDS) -> DataFrame:
    """The documents in which no benchmark window occurs, with their columns unchanged."""
    spark = docs.sparkSession
    T.importable(spark)

    def clean(frame: DataFrame, shard: list[tuple[int, str | None]]) -> DataFrame:
        sent = spark.sparkContext.broadcast(compile_patterns(shard, window))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for piece in T.pieces(batch, text_col):
                    view = pa.RecordBatch.from_arrays([pa.nulls(piece.num_rows, pa.int64()), piece.column(text_col)], names=["doc_id", "text"])
                    hits = scan(view, sent.value).column("spans")
                    yield piece.filter(pa.array(np.diff(hits.offsets.to_numpy()) == 0))

        return frame.mapInArrow(run, docs.schema)

    shards, n = _shards(benchmark, "item_id", "text", shard_words)
    for k, shard in enumerate(shards):
        # written between passes, so that a task holds one shard
        docs = T.written(clean(docs, shard), "clean") if k < n - 1 else clean(docs, shard)
    return docs


def brute_force(docs: list[tuple[int, str | None]], items: list[tuple[int, str]], window: int = WINDOW) -> list[tuple]:
    """The same rows by plain search, for tests."""
    import re

    lower = lambda s: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s or "")
    words = lambda s: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(s))
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for item, t in items:
            v = words(t)
            m = min(window, len(v))
            for i in range(len(v) - m + 1 if m else 0):
                for j in range(len(w) - m + 1):
                    if w[j : j + m] == v[i : i + m]:
                        hit |= set(range(j, j + m))
                        found.add(item)
        out.append((doc, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest(), bool(hit)))
    return out


ORACLE_SQL = r"""
WITH dw AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
iw AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
p AS (SELECT DISTINCT item_id, m, array_to_string(w[i:i + m - 1], ' ') AS t
      FROM (SELECT item_id, w, least(10, len(w)) AS m, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM iw WHERE len(w) > 0)),
g AS (SELECT doc_id, m, i, array_to_string(w[i:i + m - 1], ' ') AS t
      FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM dw, (SELECT DISTINCT m FROM p) WHERE len(w) >= m)),
o AS (SELECT DISTINCT g.doc_id, g.m, g.i, p.item_id FROM g JOIN p ON p.m = g.m AND p.t = g.t),
h AS (SELECT doc_id, count(DISTINCT pos) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + m)) AS pos FROM o) GROUP BY doc_id),
k AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS s FROM o) GROUP BY doc_id)
SELECT dw.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN h ON h.doc_id = dw.doc_id LEFT JOIN k ON k.doc_id = dw.doc_id"""
