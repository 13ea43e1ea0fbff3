"""Token ids in binary files of Simple-8b words.

A 64-bit word holds a 4-bit selector and as many ids as fit 60 bits at one width: 60 of 1 bit, 30 of 2,
20 of 3, 15 of 4, 12 of 5, 10 of 6, 8 of 7, 7 of 8, 6 of 10, 5 of 12, 4 of 15, 3 of 20, 2 of 30 or 1 of 60.
An id of more than 60 bits is an escape: a word with selector 15 and then the id itself. Each word takes
as many of the next ids as it can. Ids are coded in blocks of ``BLOCK`` ids; a block starts at a word of
its own, and the file's footer has the word offset of each, so blocks decode apart from each other and
whole batches of them decode in a few numpy steps.

File (little endian): magic ``S8TK0001``; the words; block offsets (u64 each, in words, one more than
blocks); document table (i64 doc id, u64 first id in this file, u64 ids); footer (u64 ids, u64 blocks,
u64 documents, u64 words, magic). One file per Spark partition, in ascending order of documents; each
task writes under a name of its own attempt, and only files in the manifest (a Parquet table that Spark
commits) count, so a lost or repeated task leaves nothing but an unused file.

Cases: a null or empty text has the end id only; empty tables give no rows; documents with the same id
follow each other, ordered by a hash of their text; a null doc_id comes first (stored as the lowest
64-bit integer); other columns are not read.
"""

from __future__ import annotations

import os
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vacantia.llm import _files
from vacantia.llm import _pretokens as W
from vacantia.llm import _text as T

MAGIC = b"S8TK0001"
BLOCK = 1024
END_ID = 0
NO_ID = -(2**63)
#: How many ids of how many bits a word of each selector holds.
COUNTS = np.array([60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1, 0, 1])
BITS = np.array([1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60, 0, 64])
ESCAPE = 15


def encode_blocks(ids: np.ndarray, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray]:
    """The words of ids (unsigned 64-bit), and the offset of each block's first word (one more than blocks)."""
    n = len(ids)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(1, np.int64)
    ids = ids.astype(np.uint64)
    width = np.ones(n, np.uint8)
    for b in range(1, 61):
        over = ids >= np.uint64(1) << np.uint64(b)
        if not over.any():
            break
        width[over] = b + 1
    blocks = -(-n // block)
    end = np.minimum((np.arange(blocks) + 1) * block, n)
    # the widest of the next k ids, from every position, for the k of each selector; past a block's end nothing counts
    stop = np.repeat(end, np.diff(np.append(np.arange(blocks) * block, n)))
    left = stop - np.arange(n)
    pick = np.full(n, ESCAPE, np.uint8)
    widest, have = width.copy(), 1
    for s in range(13, -1, -1):
        k = int(COUNTS[s])
        while have < k:  # grow the window, at most doubling it
            add = min(have, k - have)
            grown = widest.copy()
            np.maximum(grown[: n - add], widest[add:], out=grown[: n - add])
            widest, have = grown, have + add
        ok = (widest <= BITS[s]) & (left >= k)
        pick[ok] = s
        if not ok.any() and s < 8:
            break
    # follow the words of all blocks at once
    at, rows, found = np.arange(blocks) * block, np.arange(blocks), []
    while len(at):
        found.append((rows, at))
        at = at + COUNTS[pick[at]]
        on = at < end[rows]
        at, rows = at[on], rows[on]
    where = np.sort(np.concatenate([a for _, a in found]))
    sel = pick[where]
    size = 1 + (sel == ESCAPE)
    place = np.cumsum(size) - size
    words = np.zeros(int(size.sum()), np.uint64)
    words[place] = sel.astype(np.uint64) << np.uint64(60)
    for s in np.unique(sel):
        rows = np.flatnonzero(sel == s)
        if s == ESCAPE:
            words[place[rows] + 1] = ids[where[rows]]
            continue
        for k in range(int(COUNTS[s])):
            words[place[rows]] |= ids[where[rows] + k] << np.uint64(k * int(BITS[s]))
    first = np.searchsorted(where, np.arange(blocks) * block)
    return words, np.append(place[first], len(words))


def decode_words(words: np.ndarray) -> np.ndarray:
    """The ids of whole blocks of words."""
    sel = (words >> np.uint64(60)).astype(np.int64)
    plain = np.ones(len(words), bool)
    # the word after an escape is a value; a value may look like an escape itself
    marks = np.flatnonzero(sel == ESCAPE)
    last = -1
    for m in marks.tolist():
        if m > last:
            plain[m + 1], last = False, m + 1
    code = np.flatnonzero(plain)
    sel = sel[code]
    count = COUNTS[sel]
    out = np.zeros(int(count.sum()), np.uint64)
    place = np.cumsum(count) - count
    for s in np.unique(sel):
        rows = np.flatnonzero(sel == s)
        if s == ESCAPE:
            out[place[rows]] = words[code[rows] + 1]
            continue
        mask = (np.uint64(1) << np.uint64(BITS[s])) - np.uint64(1)
        for k in range(int(COUNTS[s])):
            out[place[rows] + k] = (words[code[rows]] >> np.uint64(k * int(BITS[s]))) & mask
    return out


_encoders: dict[str, tuple[object, W.WordIds, dict[str, int]]] = {}


def _encoder(path: str) -> tuple[W.WordIds, dict[str, int]]:
    """The tokenizers library behind the worker's word cache: each distinct pre-token is encoded once."""
    if path not in _encoders:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        added = {t.content: k for k, t in tokenizer.get_added_tokens_decoder().items()}

        def encode(words: list[bytes]) -> list[np.ndarray]:
            found = tokenizer.encode_batch_fast([w.decode() for w in words], add_special_tokens=False)
            return [np.array(e.ids, np.uint32) for e in found]

        _encoders[path] = W.WordIds(encode, 3_000_000), added
    return _encoders[path]


class Writer:
    """One file: blocks go out as they fill, the tables at the end."""

    def __init__(self, folder: str):
        self.path = f"{folder}/ids-{uuid.uuid4().hex}.s8"
        self.out = _files.create(self.path)
        self.out.write(MAGIC)
        self.rest: list[np.ndarray] = []
        self.n_rest = self.n = self.words = 0
        self.offsets: list[np.ndarray] = []
        self.docs: list[np.ndarray] = []

    def add(self, doc_ids: np.ndarray, ids: np.ndarray, offsets: np.ndarray) -> None:
        self.docs.append(np.stack([doc_ids, self.n + offsets[:-1], np.diff(offsets)], axis=1).astype("<i8"))
        self.rest.append(ids)
        self.n += len(ids)
        self.n_rest += len(ids)
        if self.n_rest >= 256 * BLOCK:
            self._flush(self.n_rest // BLOCK * BLOCK)

    def _flush(self, n: int) -> None:
        ids = np.concatenate(self.rest) if self.rest else np.zeros(0, np.uint32)
        words, offsets = encode_blocks(ids[:n])
        self.out.write(words.astype("<u8").tobytes())
        self.offsets.append(self.words + offsets[:-1])
        self.words += len(words)
        self.rest, self.n_rest = [ids[n:]], len(ids) - n

    def close(self) -> tuple[str, int, int]:
        self._flush(self.n_rest)
        blocks = np.concatenate([*self.offsets, [self.words]]).astype("<u8")
        docs = np.concatenate(self.docs) if self.docs else np.zeros((0, 3), "<i8")
        self.out.write(blocks.tobytes())
        self.out.write(docs.tobytes())
        self.out.write(np.array([self.n, len(blocks) - 1, len(docs), self.words], "<u8").tobytes() + MAGIC)
        self.out.close()
        return self.path, self.n, len(docs)


class Reader:
    """A file's document table, and the ids of any range of documents."""

    def __init__(self, path: str):
        self.file = _files.open_input(path)
        size = self.file.size()
        foot = self.file.read_at(40, size - 40)
        if foot[32:] != MAGIC:
            raise ValueError(f"{path} is not a file of token ids")
        self.n, blocks, docs, words = np.frombuffer(foot[:32], "<u8").astype(np.int64).tolist()
        at = len(MAGIC) + 8 * words
        self.blocks = np.frombuffer(self.file.read_at(8 * (blocks + 1), at), "<u8").astype(np.int64)
        self.docs = np.frombuffer(self.file.read_at(24 * docs, at + 8 * (blocks + 1)), "<i8").reshape(-1, 3)

    def ids(self, low: int, high: int) -> np.ndarray:
        """Ids low .. high - 1 of the file, from the blocks that hold them."""
        if high <= low:
            return np.zeros(0, np.uint64)
        a, b = low // BLOCK, -(-high // BLOCK)
        begin, end = self.blocks[a], self.blocks[b]
        words = np.frombuffer(self.file.read_at(8 * int(end - begin), len(MAGIC) + 8 * int(begin)), "<u8")
        return decode_words(words)[low - a * BLOCK : high - a * BLOCK]


def write_token_files(docs: DataFrame, tokenizer: str, folder: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID) -> DataFrame:
    """Encodes, writes, and returns the manifest: path, position in the order, ids and documents of each file."""
    spark = docs.sparkSession
    T.importable(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        words, added = _encoder(tokenizer)
        writer = None
        for batch in batches:
            for piece in T.pieces(batch):
                ids, offsets = W.encode(piece.column("text"), words, added)
                rows = piece.num_rows
                ended = np.full(len(ids) + rows, end_id, np.uint64)
                keep = np.ones(len(ended), bool)
                keep[offsets[1:] + np.arange(rows)] = False
                ended[keep] = ids
                writer = writer or Writer(folder)
                writer.add(piece.column("doc_id").fill_null(NO_ID).to_numpy(), ended, offsets + np.arange(rows + 1))
        if writer:
            path, n, n_docs = writer.close()
            yield pa.RecordBatch.from_pydict({"part": [TaskContext.get().partitionId()], "path": [path], "n_ids": [n], "n_docs": [n_docs]})

    _files.make_dir(folder)
    ordered = (
        docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
        .repartitionByRange("doc_id")
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
    )
    return ordered.mapInArrow(run, "part long, path string, n_ids long, n_docs long")


def read_token_files(manifest: DataFrame) -> DataFrame:
    """One row per document, from the files alone: its id, first position in the whole order, and ids' checksum."""
    T.importable(manifest.sparkSession)
    order = Window.orderBy("part")  # one row per file
    files = manifest.withColumn("base", F.coalesce(F.sum("n_ids").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                file = Reader(row["path"])
                docs, step = file.docs, 0
                while step < len(docs):
                    # documents of about a million ids at a time
                    to = max(step + 1, int(np.searchsorted(docs[:, 1] + docs[:, 2], docs[step, 1] + (1 << 20), "right")))
                    low = int(docs[step, 1])
                    ids = file.ids(low, int(docs[to - 1, 1] + docs[to - 1, 2])).astype("<u4").view(np.uint8)
                    crc = [zlib.crc32(ids[4 * (a - low) : 4 * (a - low + n)]) for a, n in docs[step:to, 1:].tolist()]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(docs[step:to, 0], mask=docs[step:to, 0] == NO_ID), pa.array(docs[step:to, 1] + row["base"]), pa.array(docs[step:to, 2]), pa.array(crc, pa.int64())],
                        names=["doc_id", "start", "n_tokens", "ids_crc32"],
                    )
                    step = to

    spread = files.repartition(max(files.sparkSession.sparkContext.defaultParallelism, 1), "path")
    return spread.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    manifest = T.written(write_token_files(docs, public_tokenizers.path("byte_bpe_50k.json"), T.shared_dir(spark)), "manifest")
    return read_token_files(manifest)
