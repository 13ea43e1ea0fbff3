"""BPE encoding by per-prefix dynamic programming, and decoding.

Every prefix of a word has exactly one token that ends its BPE encoding. A suffix automaton over the
vocabulary (a trie with failure links) gives, at each byte, the tokens that end there, longest first. A
token fits if it is compatible with the unique last token of the prefix before it: undoing the merges of
the two tokens alternately must never meet a merge across their border that would have come first. The
fitting token is stored per prefix, and back-pointers from the last byte give the exact ids. The work is
linear in the text, whatever its shape.

Inside a task all new words of a batch advance together, one byte position per numpy step; words of
over ``LONG`` bytes run through the same tables one at a time. Words are cut where the tokenizer's
pre-tokenizer cuts (``_pretokens``), and each worker keeps the ids of the words it has met, up to
``CACHE_WORDS``.

Cases: a null or empty text has no ids; strings of added tokens inside a text become their ids, as in
the library; empty tables, repeated rows and other columns need no care, as rows are independent.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from vacantia.llm import _pretokens as W
from vacantia.llm import _text as T

LONG = 256
CACHE_WORDS = 3_000_000


def byte_letters() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, extra = [""] * 256, 0
    for b in keep:
        out[b] = chr(b)
    for b in range(256):
        if not out[b]:
            out[b], extra = chr(256 + extra), extra + 1
    return out


class Model:
    """A byte-level BPE vocabulary as arrays: automaton, pair table, split table."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        value = {c: b for b, c in enumerate(byte_letters())}
        vocab: dict[str, int] = spec["model"]["vocab"]
        self.added: dict[str, int] = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        size = max([*vocab.values(), *self.added.values()]) + 1
        self.bytes: list[bytes] = [b""] * size
        for t, k in vocab.items():
            self.bytes[k] = bytes(value[c] for c in t)
        for t, k in self.added.items():
            self.bytes[k] = t.encode()
        self.length = np.array([len(b) for b in self.bytes], np.int32)
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ", 1)) for m in spec["model"]["merges"]]
        # rank 0 for single bytes, r + 1 for the token of merge r
        self.rank = np.zeros(size, np.int64)
        self.left, self.right = np.full(size, -1, np.int32), np.full(size, -1, np.int32)
        keys = np.zeros(len(pairs), np.int64)
        out = np.zeros(len(pairs), np.int64)
        for r, (a, b) in enumerate(pairs):
            x, y, z = vocab[a], vocab[b], vocab[a + b]
            keys[r], out[r] = (x << 32) | y, r
            if self.left[z] < 0:
                self.left[z], self.right[z], self.rank[z] = x, y, r + 1
        order = np.argsort(keys, kind="stable")
        self.pair_keys, self.pair_ranks = keys[order], out[order] + 1
        self.pair_map = {int(k): int(v) for k, v in zip(self.pair_keys, self.pair_ranks)}
        # pairs also in an open table, for lookups without a search
        self.slots = 1 << 18
        self.table_key, self.table_rank = np.full(self.slots, -1, np.int64), np.zeros(self.slots, np.int64)
        left = np.arange(len(keys))
        at = self._slot(self.pair_keys)
        while len(left):
            free = self.table_key[at] < 0
            cand, where = left[free], at[free]
            self.table_key[where] = self.pair_keys[cand]
            won = self.table_key[at] == self.pair_keys[left]
            self.table_rank[at[won]] = self.pair_ranks[left[won]]
            left, at = left[~won], (at[~won] + 1) % self.slots
        self._automaton({self.bytes[k]: k for k in vocab.values()})

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (T.mix(keys.astype(np.uint64)) >> T.U64(46)).astype(np.int64)

    def pair_rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The rank of merging a and b, a very large one where they never merge."""
        key = (a.astype(np.int64) << 32) | b
        at = self._slot(key)
        out = np.full(len(key), 2**60)
        open_ = np.arange(len(key))
        while len(open_):
            here = self.table_key[at]
            hit = here == key[open_]
            out[open_[hit]] = self.table_rank[at[hit]]
            on = ~hit & (here >= 0)
            open_, at = open_[on], (at[on] + 1) % self.slots
        return out

    def _automaton(self, tokens: dict[bytes, int]) -> None:
        """Trie with failure links; edges live in one sorted array of (state, byte)."""
        nodes: dict[tuple[int, int], int] = {}
        depth, token = [0], [-1]
        for text, k in tokens.items():
            at = 0
            for b in text:
                to = nodes.get((at, b))
                if to is None:
                    to = nodes[at, b] = len(depth)
                    depth.append(depth[at] + 1)
                    token.append(-1)
                at = to
            token[at] = k
        fail = [0] * len(depth)
        edges: list[list[tuple[int, int]]] = [[] for _ in depth]
        for (a, b), to in nodes.items():
            edges[a].append((b, to))
        order = [to for _, to in edges[0]]
        for at in order:  # breadth first
            for b, to in edges[at]:
                f = fail[at]
                while f and (f, b) not in nodes:
                    f = fail[f]
                fail[to] = nodes.get((f, b), 0)
                order.append(to)
        longest = list(token)  # of each state, the longest token that is a suffix of it
        shorter = [-1] * (max(tokens.values()) + 1)  # of each token, the next shorter one
        for at in order:
            below = longest[fail[at]]
            if token[at] >= 0:
                shorter[token[at]] = below
            else:
                longest[at] = below
        self.nodes, self.fail_list, self.longest_list, self.shorter_list = nodes, fail, longest, shorter
        self.fail, self.longest, self.shorter = (np.array(x, np.int32) for x in (fail, longest, shorter))
        key = np.array([(a << 8) | b for a, b in nodes], np.int64)
        to = np.array(list(nodes.values()), np.int64)
        order_ = np.argsort(key)
        self.edge_key, self.edge_to = key[order_], to[order_]
        self.root = np.zeros(256, np.int64)
        for b, t in edges[0]:
            self.root[b] = t

    def step(self, state: np.ndarray, byte: np.ndarray) -> np.ndarray:
        """The automaton's next states."""
        out = self.root[byte]
        open_ = np.flatnonzero(state)
        now = state[open_]
        while len(open_):
            key = (now << 8) | byte[open_]
            at = np.minimum(np.searchsorted(self.edge_key, key), len(self.edge_key) - 1)
            hit = self.edge_key[at] == key
            out[open_[hit]] = self.edge_to[at[hit]]
            now = self.fail[now[~hit]].astype(np.int64)
            open_ = open_[~hit]
            open_, now = open_[now > 0], now[now > 0]
        return out

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether token b can follow token a: BPE over their joined bytes gives a, b again."""
        ok = np.ones(len(a), bool)
        open_ = np.arange(len(a))
        x, y = a.astype(np.int64), b.astype(np.int64)
        limit = np.full(len(a), 2**60)
        while len(open_):
            # a merge across the border that comes before the limit forbids the pair
            bad = self.pair_rank(x, y) < limit
            ok[open_[bad]] = False
            keep = ~bad
            open_, x, y, limit = open_[keep], x[keep], y[keep], limit[keep]
            # undo the later of the two merges; on the left that exposes its right part, on the right its left part
            rx, ry = self.rank[x], self.rank[y]
            undo_x = rx > ry
            undo_y = ~undo_x & (ry > 0)
            limit = np.where(undo_x, rx, np.where(undo_y, ry + 1, limit))
            x, y = np.where(undo_x, self.right[x], x), np.where(undo_y, self.left[y], y)
            more = undo_x | undo_y
            open_, x, y, limit = open_[more], x[more], y[more], limit[more]
        return ok

    @lru_cache(maxsize=1 << 20)  # noqa: B019
    def fits(self, a: int, b: int) -> bool:
        """compatible() of one pair."""
        limit = 2**60
        while True:
            if self.pair_map.get((a << 32) | b, 2**60) < limit:
                return False
            ra, rb = int(self.rank[a]), int(self.rank[b])
            if ra > rb:
                limit, a = ra, int(self.right[a])
            elif rb > 0:
                limit, b = rb + 1, int(self.left[b])
            else:
                return True

    def encode_long(self, text: bytes) -> list[int]:
        nodes, fail, longest, shorter = self.nodes, self.fail_list, self.longest_list, self.shorter_list
        size = [len(b) for b in self.bytes] if not hasattr(self, "_size") else self._size
        self._size = size
        state, last = 0, [0] * len(text)
        for i, byte in enumerate(text):
            while state and (state, byte) not in nodes:
                state = fail[state]
            state = nodes.get((state, byte), 0)
            t = longest[state]
            while True:
                before = i - size[t]
                if before < 0 or self.fits(last[before], t):
                    break
                t = shorter[t]
            last[i] = t
        out, i = [], len(text) - 1
        while i >= 0:
            out.append(last[i])
            i -= size[last[i]]
        return out[::-1]

    def encode_words(self, words: list[bytes]) -> list[np.ndarray]:
        """The ids of each word."""
        out: list[np.ndarray] = [np.zeros(0, np.uint32)] * len(words)
        sizes = np.array([len(w) for w in words], np.int64)
        for k in np.flatnonzero(sizes > LONG):
            out[k] = np.array(self.encode_long(words[k]), np.uint32)
        short = np.flatnonzero((sizes > 0) & (sizes <= LONG))
        short = short[np.argsort(-sizes[short], kind="stable")]
        if not len(short):
            return out
        n = sizes[short]
        data = np.frombuffer(b"".join(words[k] for k in short), np.uint8)
        base = np.cumsum(n) - n
        last = np.zeros(len(data), np.int32)  # of each prefix, its unique last token
        state = np.zeros(len(short), np.int64)
        active = len(short)
        for i in range(int(n[0])):
            active = int(np.searchsorted(-n[:active], -i, "left"))
            at = base[:active] + i
            state = self.step(state[:active], data[at].astype(np.int64))
            t = self.longest[state].astype(np.int64)
            open_ = np.arange(active)
            while len(open_):
                cand = t[open_]
                before = i - self.length[cand]
                ok = before < 0
                inner = np.flatnonzero(~ok)
                if len(inner):
                    ok[inner] = self.compatible(last[base[open_[inner]] + before[inner]], cand[inner])
                open_ = open_[~ok]
                t[open_] = self.shorter[t[open_]]
            last[at] = t
        # back-pointers, all words together: token k from the end
        where, rows, found, position = base + n - 1, np.arange(len(short)), [], n - 1
        while len(rows):
            t = last[where]
            found.append((rows, t))
            position = position - self.length[t]
            where = where - self.length[t]
            on = position >= 0
            rows, where, position = rows[on], where[on], position[on]
        row = np.concatenate([r for r, _ in found])
        step = np.concatenate([np.full(len(r), -k) for k, (r, _) in enumerate(found)])
        ids = np.concatenate([t for _, t in found]).astype(np.uint32)
        order = np.lexsort((step, row))
        ends = np.cumsum(np.bincount(row, minlength=len(short)))
        for k, part in zip(short, np.split(ids[order], ends[:-1])):
            out[k] = part
        return out


_models: dict[str, tuple[Model, W.WordIds]] = {}


def loaded(path: str) -> tuple[Model, W.WordIds]:
    """The model and the worker's word cache, built once per worker."""
    if path not in _models:
        model = Model(path)
        _models[path] = model, W.WordIds(model.encode_words, CACHE_WORDS)
    return _models[path]


def encode_texts(texts: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray]:
    """All ids back to back and the offsets of the rows."""
    model, words = loaded(path)
    return W.encode(texts, words, model.added)


def decode_ids(ids: np.ndarray, model: Model) -> bytes:
    table = model.bytes
    return b"".join([table[k] for k in ids.tolist()])


def encode_documents(docs: DataFrame, tokenizer: str, text_col: str = "text", as_col: str = "ids") -> DataFrame:
    """The frame with the exact ids of each text in a new column."""
    T.importable(docs.sparkSession)
    schema = StructType([*docs.schema.fields, StructField(as_col, ArrayType(IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in T.pieces(batch, text_col):
                ids, offsets = encode_texts(piece.column(text_col), tokenizer)
                lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids.view(np.int32)))
                yield pa.RecordBatch.from_arrays([*piece.columns, lists], names=[*piece.schema.names, as_col])

    return docs.mapInArrow(run, schema)


def decode_documents(encoded: DataFrame, tokenizer: str, ids_col: str = "ids", as_col: str = "decoded") -> DataFrame:
    """The frame with the text of each row's ids in a new column."""
    T.importable(encoded.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, _ = loaded(tokenizer)
        for batch in batches:
            texts = pa.array([decode_ids(np.array(x or [], np.int64), model).decode("utf-8", "replace") for x in batch.column(ids_col).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, texts], names=[*batch.schema.names, as_col])

    return encoded.mapInArrow(run, StructType([*encoded.schema.fields, StructField(as_col, StringType())]))


def round_trip(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document the number and digest of its ids, and the digest of the text decoded from them."""
    T.importable(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, _ = loaded(tokenizer)
        for batch in batches:
            for piece in T.pieces(batch):
                ids, offsets = encode_texts(piece.column("text"), tokenizer)
                sha, back = [], []
                for low, high in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
                    own = ids[low:high]
                    sha.append(hashlib.sha256(own.astype("<u4").tobytes()).hexdigest())
                    text = decode_ids(own, model).decode("utf-8", "replace")
                    back.append(hashlib.sha256(text.encode()).hexdigest())
                yield pa.RecordBatch.from_arrays([piece.column("doc_id"), pa.array(np.diff(offsets)), pa.array(sha), pa.array(back)], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return round_trip(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("byte_bpe_50k.json"))
