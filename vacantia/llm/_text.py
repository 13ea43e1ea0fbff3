"""Vectorised text primitives used inside Arrow tasks.

A task sees a batch of texts as one UTF-8 byte array and the offsets of its rows. Words, lines and
their 64-bit hashes come from whole-array numpy operations; nothing here loops over rows or words.
Batches are cut into pieces of about ``PIECE`` bytes so that memory stays flat whatever the batch size
(one longer text makes one longer piece).
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

PIECE = 1 << 20
U64 = np.uint64

_random = np.random.default_rng(20240501)
#: A random odd multiplier and one random value per byte: the hash of a span of up to BLOCK bytes is a polynomial over them.
_BASE = U64(0x9E3779B97F4A7C15)
BYTE_VALUES = _random.integers(1, 2**63, 256, dtype=np.uint64) * U64(2) + U64(1)
#: The same with A-Z read as a-z.
FOLDED_VALUES = BYTE_VALUES.copy()
FOLDED_VALUES[65:91] = BYTE_VALUES[97:123]

#: Bytes of a span under one polynomial. Modulo 2^64 any polynomial takes some pairs of 1024 bytes of two letters (Thue-Morse words) as one.
BLOCK = 32

_powers = np.ones(1, U64)
_inverses = np.ones(1, U64)


def byte_table(*ranges: tuple[int, int]) -> np.ndarray:
    """A boolean for each byte value, true inside any of the inclusive ranges."""
    table = np.zeros(256, bool)
    for low, high in ranges:
        table[low : high + 1] = True
    return table


#: Bytes of words of ``[^\x20\x09-\x0D]+``.
NOT_SPACE = ~byte_table((0x20, 0x20), (0x09, 0x0D))
#: Bytes of words of ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` once A-Z are a-z.
ALNUM_OR_HIGH = byte_table((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))
ASCII_OR_HIGH_LETTERS = byte_table((0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))


def pieces(batch: pa.RecordBatch, column: str = "text", limit: int = PIECE) -> Iterator[pa.RecordBatch]:
    """Consecutive slices of the batch with about ``limit`` bytes of ``column`` each."""
    if not batch.num_rows:
        return
    sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
    at = 0
    while at < batch.num_rows:
        before = sizes[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(sizes, before + limit, "right")))
        yield batch.slice(at, to - at)
        at = to


def utf8(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all rows back to back, and the n + 1 offsets; nulls are empty."""
    array = pc.fill_null(array.cast(pa.large_string()), "")
    offsets = np.frombuffer(array.buffers()[1], np.int64)[array.offset : array.offset + len(array) + 1]
    if array.buffers()[2] is None or not len(array):
        return np.zeros(0, np.uint8), np.zeros(len(array) + 1, np.int64)
    data = np.frombuffer(array.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def spans(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of true within rows: their starts, ends, and the index of each row's first run (n + 1)."""
    n = len(inside)
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    begins, ends = inside.copy(), inside.copy()
    if n:
        begins[1:] &= ~inside[:-1] | edge[1:n]
        ends[:-1] &= ~inside[1:] | edge[1:n]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(ends) + 1, np.searchsorted(starts, offsets)


def lines(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lines split at \\n, empty ones too (an empty text has one): starts, ends, index of each row's first line."""
    breaks = np.flatnonzero(data == 10)
    rows = len(offsets) - 1
    first = np.arange(rows + 1) + np.searchsorted(breaks, offsets)
    starts, ends = np.empty(rows + len(breaks), np.int64), np.empty(rows + len(breaks), np.int64)
    is_first = np.zeros(rows + len(breaks), bool)
    is_first[first[:-1]] = True
    starts[is_first], starts[~is_first] = offsets[:-1], breaks + 1
    is_last = np.zeros(rows + len(breaks), bool)
    is_last[first[1:] - 1] = True
    ends[is_last], ends[~is_last] = offsets[1:], breaks
    return starts, ends, first


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def _grow(n: int) -> None:
    global _powers, _inverses
    if len(_powers) < n:
        inverse = U64(pow(int(_BASE), -1, 2**64))
        _powers = np.concatenate([np.ones(1, U64), np.cumprod(np.full(n - 1, _BASE))])
        _inverses = np.concatenate([np.ones(1, U64), np.cumprod(np.full(n - 1, inverse))])


def prefix_sums(values: np.ndarray) -> np.ndarray:
    """Running polynomial sums of one 64-bit value per position, for span_hashes."""
    _grow(len(values) + 1)
    sums = np.zeros(len(values) + 1, U64)
    np.cumsum(values * _powers[: len(values)], out=sums[1:])
    return sums


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of spans that depend on their contents only; those of longer ones add up mixed hashes of their blocks and the blocks' places."""
    out = mix((sums[ends] - sums[starts]) * _inverses[starts])
    long = np.flatnonzero(ends - starts > BLOCK)
    if len(long):
        n = (ends[long] - starts[long] + BLOCK - 1) // BLOCK
        place = ranges(np.zeros(len(n), np.int64), n)
        begin = np.repeat(starts[long], n) + BLOCK * place
        end = np.minimum(begin + BLOCK, np.repeat(ends[long], n))
        block = mix((sums[end] - sums[begin]) * _inverses[begin])
        out[long] = mix(np.add.reduceat(mix(block ^ mix(place.astype(U64) + U64(1))), np.cumsum(n) - n))
    return out


def word_grams(words: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all n consecutive words inside each row: hashes, position of the first word, row."""
    total, rows = len(words), len(first) - 1
    row = np.repeat(np.arange(rows), np.diff(first))
    at = np.flatnonzero(np.arange(total) + n <= first[1:][row]) if total else np.zeros(0, np.int64)
    out = np.zeros(len(at), U64)
    for k in range(n):
        out = out * U64(0xD1342543DE82EF95) + words[at + k]
    return mix(out), at, row[at]


def per_row(mask: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of the mask inside each row."""
    sums = np.zeros(len(mask) + 1, np.int64)
    np.cumsum(mask, out=sums[1:])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The indices starts[i] .. starts[i] + counts[i] - 1, one range after the other."""
    total = int(counts.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(counts)
    return np.arange(total) - np.repeat(ends - counts - starts, counts)


def shared_dir(spark: SparkSession) -> str:
    """A new folder name under the folder that all executors share (spark.checkpoint.dir)."""
    import tempfile
    import uuid

    base = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = f"file://{tempfile.gettempdir()}/spark-shared"
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"


def written(df: DataFrame, name: str = "table") -> DataFrame:
    """The frame as a Parquet table in the shared folder: cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def importable(spark: SparkSession) -> None:
    """Lets local Python workers import this package wherever the driver was started, and give large arrays back when they go."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    known = env.get("PYTHONPATH", "")
    if root not in known.split(":"):
        env["PYTHONPATH"] = f"{root}:{known}".rstrip(":")
    # workers are kept for later tasks: what the allocators hold on to adds up beside the executor's heap
    env.setdefault("MALLOC_MMAP_THRESHOLD_", str(4 << 20))
    env.setdefault("MALLOC_TRIM_THRESHOLD_", str(8 << 20))
    env.setdefault("ARROW_DEFAULT_MEMORY_POOL", "system")
