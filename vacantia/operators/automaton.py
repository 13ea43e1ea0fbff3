"""Many patterns in one pass over each text: an automaton of all of them, run over all texts of a batch at once.

Texts and patterns are lower-cased, and everything but letters and digits becomes one space, so a pattern matches whole words. The
patterns' bytes make a trie; with its failure links worked in, each state has one next state for every byte, and the rank of
the first pattern that ends in it. A batch of texts is cut into lanes that overlap by the longest pattern, and all
lanes take a step together.

Tables are sent to the tasks in shards of at most ``STATES`` states (or one longer pattern), a fixed size; a larger dictionary takes
one pass for each shard, in the same scan of the texts.

Cases: a null text matches nothing; a pattern that is null or has no letter and no digit matches nothing; of several patterns in a text the
one with the smallest ord counts, then the smallest pattern; repeated patterns are one, with the smallest value; no patterns match nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructField, StructType

from vacantia.storage import importable

STATES = 1 << 18
#: Bytes of a lane besides its overlap.
LANE = 512


def normal(text: Column) -> Column:
    """Words in lower case, one space before and after each."""
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " ")), F.lit(" "))


class Automaton:
    """Patterns by their places: next state for each state and class of bytes, and the smallest place that a state ends."""

    def __init__(self, patterns: list[bytes]):
        self.longest = max(map(len, patterns), default=0)
        self.none = len(patterns)
        used = sorted({b for p in patterns for b in p})
        self.classes = np.zeros(256, np.uint8 if len(used) < 256 else np.uint16)
        self.classes[used] = np.arange(1, len(used) + 1)
        children: list[dict[int, int]] = [{}]
        first = [self.none]
        for place, p in enumerate(patterns):
            at = 0
            for c in self.classes[np.frombuffer(p, np.uint8)].tolist():
                if c not in children[at]:
                    children[at][c] = len(children)
                    children.append({})
                    first.append(self.none)
                at = children[at][c]
            first[at] = min(first[at], place)
        self.next = np.zeros((len(children), len(used) + 1), np.int32)
        self.first = np.array(first, np.int32)
        level = list(children[0].items())
        self.next[0, [c for c, _ in level]] = [s for _, s in level]
        queue = [(s, 0) for _, s in level]
        for state, fail in queue:  # level by level: the row of the failure state is ready
            self.first[state] = min(self.first[state], self.first[fail])
            self.next[state] = self.next[fail]
            for c, child in children[state].items():
                queue.append((child, int(self.next[fail, c])))
                self.next[state, c] = child

    def search(self, texts: pa.Array) -> np.ndarray:
        """The smallest place of a pattern in each text."""
        texts = texts.cast(pa.large_string()).fill_null("")
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = self.classes[np.frombuffer(texts.buffers()[2], np.uint8)] if texts.buffers()[2] is not None else np.zeros(0, np.uint8)
        size = np.diff(offsets)
        lanes = np.maximum(1, -(-size // LANE))
        text = np.repeat(np.arange(len(size)), lanes)
        begin = offsets[:-1][text] + (np.arange(len(text)) - np.repeat(np.cumsum(lanes) - lanes, lanes)) * LANE
        length = np.minimum(offsets[1:][text] - begin, LANE + self.longest)
        order = np.argsort(-length, kind="stable")  # the lanes that go on stand in front
        begin, length, text = begin[order], length[order], text[order]
        state, best = np.zeros(len(text), np.int32), np.full(len(text), self.none, np.int32)
        for k in range(int(length[0]) if len(length) else 0):
            n = int(np.searchsorted(-length, -k, "left"))
            state[:n] = self.next[state[:n], data[begin[:n] + k]]
            best[:n] = np.minimum(best[:n], self.first[state[:n]])
        out = np.full(len(size), self.none, np.int32)
        np.minimum.at(out, text, best)
        return out


def _shards(patterns: DataFrame, states: int) -> Iterator[list[tuple]]:
    """Patterns in shards of a bounded size, one at a time on the driver."""
    known = patterns.where("pattern IS NOT NULL").withColumn("__n", normal(F.col("pattern"))).where("trim(__n) <> ''")
    known = known.groupBy("__n").agg(F.min(F.struct("ord", "pattern", "value")).alias("m"))
    total = known.agg(F.sum(F.octet_length("__n"))).first()[0] or 0
    n = total // states + 1
    for k in range(n):
        part = known.where(F.pmod(F.xxhash64("__n"), F.lit(n)) == k) if n > 1 else known
        rows = [(r["m"]["ord"], r["m"]["pattern"], r["m"]["value"], r["__n"]) for r in part.toLocalIterator()]
        yield sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))


def match_patterns(df: DataFrame, text: str, patterns: DataFrame, states: int = STATES) -> DataFrame:
    """df with ``matched``, the value of the first pattern (by ord) in its text; patterns: pattern, ord, value."""
    spark = df.sparkSession
    importable(spark)
    kinds = {f.name: f.dataType for f in patterns.schema.fields}
    entry = StructType([StructField(c, kinds[c]) for c in ("ord", "pattern", "value")])
    rows, best = df.withColumn("__text", normal(F.col(text))), []
    for shard in _shards(patterns, states):
        if not shard:
            continue
        entries = pa.array([dict(zip(("ord", "pattern", "value"), r)) for r in shard], to_arrow_type(entry))
        sent = spark.sparkContext.broadcast((Automaton([r[3].encode() for r in shard]), entries))  # at most so many states
        name, before = f"__first{len(best)}", rows.columns

        def run(batches: Iterator[pa.RecordBatch], sent=sent, name=name, before=before) -> Iterator[pa.RecordBatch]:
            automaton, entries = sent.value
            for batch in batches:
                place = automaton.search(batch.column("__text"))
                yield pa.RecordBatch.from_arrays([*batch.columns, entries.take(pa.array(place, mask=place == automaton.none))], names=[*before, name])

        rows = rows.mapInArrow(run, StructType([*rows.schema.fields, StructField(name, entry)]))
        best.append(F.col(name))
    first = F.lit(None).cast(kinds["value"]) if not best else (best[0] if len(best) == 1 else F.least(*best))["value"]
    return rows.select(*df.columns, first.alias("matched"))
