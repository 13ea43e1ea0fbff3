"""Line deduplication by an exact set-similarity join.

A line's set is its distinct words (A-Z as a-z, split at white space). A line goes if an earlier line of the
corpus, in the order (doc_id, line number), has a Jaccard similarity of at least NUM / DEN with it, be
that line itself kept or not. Lines without words always stay.

1. Word counts over all documents, in 2^``RARITY_BITS`` hash buckets on a logarithmic scale: one byte a
   bucket, so the table that every task gets has a fixed size. Words are ordered by (rarity, hash), a total
   order whatever the buckets hold, which is all that exactness asks of it.
2. Lines with equal sets are one class, kept as its first line; the others go. Copies that a task meets among
   its latest lines are told at once, so a line that is everywhere sends one entry for many.
3. Each class is entered under the words of its prefix, n - ceil(t n) + 1 of them. Entries are packed by
   hash range inside each task and meet in one task per range, sorted by word and size: the length filter
   is a window of that order, the positional filter bounds the words still to come, and the bits in which
   two lines' parities differ bound the symmetric difference from below. For each later line the ``BEST``
   likeliest earlier ones go on (more where none is likely), held as a running list of at most ``PAIRS`` a
   task. A range of more than ``ENTRIES`` entries is dealt as tiles, each pair of its blocks one group.
4. Candidates are verified on the whole sets, taken from the texts again: lines that are in no candidate
   pair are told by a bitmap of fixed size, or by a join where the pairs are too many for it. Lines that are
   still open and had more candidates in some range are searched once more for all of theirs, in those ranges, among
   the entries of the words that they met there (a bitmap of fixed size tells most others): one pass, however
   many lines are open.

Cases: null and empty texts have one empty line, which stays; repeated words count once; ties in the order
(rows with one doc_id) never remove each other, and such rows share the decisions of their id; rows without an id
come last (ids are below 2^62), ordered by a hash of their text; an empty table gives an empty result; other
columns pass through ``dedup_lines`` untouched.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vacantia.llm import _text as T

NUM, DEN = 3, 4
RARITY_BITS = 21
BEST = 4
#: Pairs that a task holds, and entries of a range beyond which it is cut into blocks of half as many.
PAIRS = 1 << 20
ENTRIES = 1 << 20
_BINS = 4096
#: Bits of the bitmap of lines to verify, and how many lines it serves.
FILTER_BITS = 24
FILTER_LINES = 1 << 22

#: Lines of more words have 192 parities, others 64 (and zeros, which compress away).
LONG = 80
PARITIES = ("p0", "p1", "p2")
#: A line's set: digest, parities, place and size. Its prefix words follow apart, as 6 bytes each.
CLASS = np.dtype([("a", "<u8"), ("b", "<u4"), ("p0", "<u8"), ("p1", "<u8"), ("p2", "<u8"), ("doc", "<i8"), ("line", "<u4"), ("n", "<u4")])
#: The place of a line.
PLACE = np.dtype([("doc", "<i8"), ("line", "<u4")])
#: A prefix word of a class.
ENTRY = np.dtype([("token", "<u4"), ("p0", "<u8"), ("p1", "<u8"), ("p2", "<u8"), ("doc", "<i8"), ("line", "<u4"), ("n", "<u4"), ("pos", "<u4")])


def pack(rows: np.ndarray) -> bytes:
    """Records in order of documents as byte planes of each column, of which those of zeros compress away."""
    out = []
    for c in rows.dtype.names if len(rows) else ():
        x = rows[c]
        if c == "doc":
            x = np.diff(x, prepend=np.int64(0))
        out.append(np.ascontiguousarray(x).view(np.uint8).reshape(len(x), -1).T.tobytes())
    return b"".join(out)


def unpack(blobs: list[bytes], kind: np.dtype) -> np.ndarray:
    blobs = [b for b in blobs if b]
    sizes = [len(b) // kind.itemsize for b in blobs]
    rows, at = np.zeros(sum(sizes), kind), 0
    for blob, n in zip(blobs, sizes):
        skip = 0
        for c in kind.names:
            wide = kind[c].itemsize
            x = np.ascontiguousarray(np.frombuffer(blob, np.uint8, n * wide, skip).reshape(wide, n).T).view(kind[c])[:, 0]
            rows[c][at : at + n] = np.cumsum(x) if c == "doc" else x
            skip += n * wide
        at += n
    return rows


def prefix_length(n: np.ndarray) -> np.ndarray:
    """Words of which two similar sets share at least one, if each takes its rarest so many."""
    return n - (NUM * n + DEN - 1) // DEN + 1


def _tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes, the line of each, and each row's first line."""
    starts, ends, _ = T.spans(T.NOT_SPACE[data], offsets)
    line_starts, _, first = T.lines(data, offsets)
    # a word never crosses a line, as a line break is white space
    line = np.searchsorted(line_starts, starts, "right") - 1
    return T.span_hashes(T.prefix_sums(T.FOLDED_VALUES[data]), starts, ends), line, first


def _keys(h: np.ndarray, line: np.ndarray, rarity: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct words of each line in the global order: as keys by rarity, the line of each, and the whole hashes."""
    key = h if rarity is None else h >> T.U64(8) | rarity[(h >> T.U64(64 - RARITY_BITS)).astype(np.int64)].astype(T.U64) << T.U64(56)
    order = np.argsort(key)
    if len(line) and line[-1] < 65536:  # a radix sort
        order = order[np.argsort(line[order].astype(np.uint16), kind="stable")]
    else:
        order = order[np.argsort(line[order], kind="stable")]
    key, line, h = key[order], line[order], h[order]
    new = np.ones(len(key), bool)
    new[1:] = (h[1:] != h[:-1]) | (line[1:] != line[:-1])
    return key[new], line[new], h[new]


def _parities(key: np.ndarray, line: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Parities of each line's words: where two lines' differ, at least so many words are in one of them only."""
    count = np.bincount(line * 192 + (T.mix(key ^ T.U64(3)) % T.U64(192)).astype(np.int64), minlength=len(n) * 192)
    words = np.packbits(count.astype(np.uint8) & 1, bitorder="little").view(np.uint64).reshape(len(n), 3)
    short = n <= LONG
    words[short, 0] ^= words[short, 1] ^ words[short, 2]
    words[short, 1:] = 0
    return words


def _apart(p: list[np.ndarray], long: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Parities that differ; a long line's are folded beside a short one's."""
    x = [w[i] ^ w[j] for w in p]
    both = long[i] == long[j]
    return np.where(both, sum(np.bitwise_count(w).astype(np.int64) for w in x), np.bitwise_count(x[0] ^ x[1] ^ x[2]).astype(np.int64))


def word_rarity(docs: DataFrame) -> np.ndarray:
    """One byte per bucket of word hashes, larger for more frequent words; counts cover all documents."""
    blocks = (1 << RARITY_BITS) // _BINS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << RARITY_BITS, np.int64)
        for batch in batches:
            for piece in T.pieces(batch):
                h, _, _ = _tokens(*T.utf8(piece.column("text")))
                at, n = np.unique(h >> T.U64(64 - RARITY_BITS), return_counts=True)
                total[at.astype(np.int64)] += n
        if total.any():
            small = np.minimum(total, 2**32 - 1).astype("<u4").reshape(blocks, _BINS)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(blocks)), pa.array([x.tobytes() for x in small], pa.binary())], names=["block", "n"])

    def add(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x.as_py(), "<u4").astype(np.int64) for x in table.column("n"))
        level = np.minimum(np.round(8 * np.log2(1 + total)), 255).astype(np.uint8)
        return pa.table({"block": table.column("block").slice(0, 1), "n": pa.array([level.tobytes()], pa.binary())})

    rows = docs.select("text").mapInArrow(count, "block long, n binary").groupBy("block").applyInArrow(add, "block long, n binary").collect()
    out = np.zeros((blocks, _BINS), np.uint8)
    for r in rows:
        out[r.block] = np.frombuffer(r.n, np.uint8)
    return out.reshape(-1)


def _equal(fixed: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """An order of the lines by set and place; which are the first of their set in it, and which come later than that one.

    A repeated row's line has the place of the first one: it isn't later."""
    order = np.lexsort((fixed["line"], fixed["doc"], fixed["b"], fixed["a"]))
    own = fixed[order]
    head = np.ones(len(own), bool)
    head[1:] = (own["a"][1:] != own["a"][:-1]) | (own["b"][1:] != own["b"][:-1])
    lead = own[np.maximum.accumulate(np.where(head, np.arange(len(own)), 0))]
    return order, head, (own["doc"] != lead["doc"]) | (own["line"] != lead["line"])


def _places(lines: np.ndarray) -> bytes:
    """The places of these lines, packed."""
    out = np.zeros(len(lines), PLACE)
    out["doc"], out["line"] = lines["doc"], lines["line"]
    return pack(out[np.argsort(out["doc"], kind="stable")])


def _class_rows(docs: DataFrame, rarity, ranges: int) -> DataFrame:
    """(bucket, fixed, prefix): the lines with words, packed by the hash of their sets; bucket -1: places of lines that go."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, n = [], 0

        def flush() -> pa.RecordBatch:
            fixed, flat = (np.concatenate(x) for x in zip(*kept))
            size = prefix_length(fixed["n"].astype(np.int64))
            begin = np.cumsum(size) - size
            order, head, later = _equal(fixed)
            gone = _places(fixed[order[later]])
            order = order[head]
            bucket = ((fixed["a"][order] >> T.U64(32)) * T.U64(ranges) >> T.U64(32)).astype(np.int64)
            order = order[np.lexsort((fixed["doc"][order], bucket))]
            fixed, size = fixed[order], size[order]
            bucket = ((fixed["a"] >> T.U64(32)) * T.U64(ranges) >> T.U64(32)).astype(np.int64)
            flat = flat[T.ranges(begin[order], size)]
            ends = np.append(0, np.cumsum(size))
            cut = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
            stop = np.append(cut[1:], len(bucket))
            words = [np.ascontiguousarray(flat[ends[a] : ends[b]]).view(np.uint8).reshape(-1, 8)[:, 1:7].tobytes() for a, b in zip(cut, stop)]
            blobs = [pack(fixed[a:b]) for a, b in zip(cut, stop)]
            return pa.RecordBatch.from_arrays([pa.array([*bucket[cut].tolist(), -1]), pa.array([*blobs, gone], pa.binary()), pa.array([*words, b""], pa.binary())], names=["bucket", "fixed", "prefix"])

        for batch in batches:
            for piece in T.pieces(batch):
                h, line, first = _tokens(*T.utf8(piece.column("text")))
                key, line, h = _keys(h, line, rarity.value)
                lines = int(first[-1])
                n_of = np.bincount(line, minlength=lines)
                begin = np.cumsum(n_of) - n_of
                sums = np.zeros((2, len(key) + 1), T.U64)
                np.cumsum(T.mix(h), out=sums[0, 1:])
                np.cumsum(T.mix(h ^ T.U64(99)), out=sums[1, 1:])
                parity = _parities(key, line, n_of)
                at = np.flatnonzero(n_of)
                fixed = np.zeros(len(at), CLASS)
                row = np.searchsorted(first, at, "right") - 1
                a, b = (s[begin[at] + n_of[at]] - s[begin[at]] for s in sums)
                fixed["a"], fixed["b"] = T.mix(a ^ n_of[at].astype(T.U64)), T.mix(b) >> T.U64(32)
                fixed["doc"], fixed["line"] = piece.column("doc_id").to_numpy()[row], at - first[row]
                fixed["n"] = n_of[at]
                for k, c in enumerate(PARITIES):
                    fixed[c] = parity[at, k]
                kept.append((fixed, key[T.ranges(begin[at], prefix_length(n_of[at]))]))
                n += len(at)
                if n > 60_000:
                    yield flush()
                    kept, n = [], 0
        if n:
            yield flush()

    return docs.mapInArrow(run, "bucket long, fixed binary, prefix binary")


def _range_of(word: np.ndarray, ranges: int) -> np.ndarray:
    return ((word >> T.U64(32)) * T.U64(ranges) >> T.U64(32)).astype(np.int64)


def _words_of(prefix: bytes, ranges: int) -> tuple[np.ndarray, np.ndarray]:
    """Range and token of packed prefix words."""
    wide = np.zeros((len(prefix) // 6, 8), np.uint8)
    wide[:, :6] = np.frombuffer(prefix, np.uint8).reshape(-1, 6)
    mixed = T.mix(wide.view(np.uint64)[:, 0])
    return _range_of(mixed, ranges), (mixed & T.U64(2**24 - 1)).astype(np.int64)


def _marked(bitmap: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether the bitmap has the pairs (a, b), and maybe some others."""
    at = (line_hash(a, b) >> T.U64(64 - FILTER_BITS)).astype(np.int64)
    return (bitmap[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)


def _narrow(classes: DataFrame, ranges: int, only) -> DataFrame:
    """The class rows of lines with a prefix word in ``only`` (a broadcast bitmap of ranges and tokens)."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for bucket, fixed, prefix in zip(*(batch.column(c).to_pylist() for c in ("bucket", "fixed", "prefix"))):
                hit = _marked(only.value, *_words_of(prefix, ranges))
                if hit.any():
                    rows = unpack([fixed], CLASS)
                    size = prefix_length(rows["n"].astype(np.int64))
                    row = np.repeat(np.arange(len(rows)), size)
                    mine = np.zeros(len(rows), bool)
                    mine[row[hit]] = True
                    words = np.frombuffer(prefix, np.uint8).reshape(-1, 6)[mine[row]].tobytes()
                    yield pa.RecordBatch.from_arrays([pa.array([bucket], pa.int64()), pa.array([pack(rows[mine])], pa.binary()), pa.array([words], pa.binary())], names=["bucket", "fixed", "prefix"])

    return classes.mapInArrow(keep, "bucket long, fixed binary, prefix binary")


def _crowded(classes: DataFrame, ranges: int) -> dict[int, int]:
    """Blocks of each word range that has more than ENTRIES entries; equal sets that a task sees together count once."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(ranges, np.int64)
        for batch in batches:
            fixed = unpack(batch.column("fixed").to_pylist(), CLASS)
            words = np.frombuffer(b"".join(batch.column("prefix").to_pylist()), np.uint8).reshape(-1, 6)
            size = prefix_length(fixed["n"].astype(np.int64))
            _, one = np.unique(fixed["a"], return_index=True)
            wide = np.zeros((int(size[one].sum()), 8), np.uint8)
            wide[:, :6] = words[T.ranges((np.cumsum(size) - size)[one], size[one])]
            total += np.bincount(_range_of(T.mix(wide.view(np.uint64)[:, 0]), ranges), minlength=ranges)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["range", "n"])

    sums = classes.select("fixed", "prefix").mapInArrow(count, "range long, n long").groupBy("range").agg(F.sum("n").alias("n"))
    return {r.range: -(-2 * r.n // ENTRIES) for r in sums.where(F.col("n") > ENTRIES).collect()}


def _entries(classes: DataFrame, ranges: int, crowded: dict[int, int] | None = None, only=None) -> DataFrame:
    """(range, gone, blob, block, blocks): packed prefix entries by word range, or packed places of lines that equal an earlier one.

    ``only`` (a broadcast bitmap of ranges and tokens) keeps the entries that it has."""
    blocks_of = crowded or {}

    def run(table: pa.Table) -> pa.Table:
        fixed = unpack(table.column("fixed").to_pylist(), CLASS)
        at, token = _words_of(b"".join(table.column("prefix").to_pylist()), ranges)
        size = prefix_length(fixed["n"].astype(np.int64))
        begin = np.cumsum(size) - size
        order, head, later = _equal(fixed)
        gone = fixed[order[later]]
        rep = np.sort(order[head])
        rep = rep[np.argsort(fixed["doc"][rep], kind="stable")]
        n = size[rep]
        mine = T.ranges(begin[rep], n)
        at, token, pick, pos = at[mine], token[mine], np.repeat(rep, n), T.ranges(np.zeros(len(n), np.int64), n)
        if only is not None:
            hit = _marked(only.value, at, token)
            at, token, pick, pos = at[hit], token[hit], pick[hit], pos[hit]
        e = np.zeros(len(at), ENTRY)
        e["token"], e["pos"] = token, pos
        for c in ("n", "line", "doc", *PARITIES):
            e[c] = fixed[c][pick]
        bucket = at
        by = np.argsort(bucket, kind="stable")
        e, bucket = e[by], bucket[by]
        cut = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(bucket) else np.zeros(0, np.int64)
        own = int(table.column("bucket")[0].as_py())  # of the sets' hash, so any word's entries lie in all of them
        rows = []
        for a, b in zip(cut, np.append(cut[1:], len(bucket))):
            blocks = blocks_of.get(int(bucket[a]), 1)
            rows.append((int(bucket[a]), False, pack(e[a:b]), own % blocks, blocks))
        if len(gone):
            rows.append((own, True, _places(gone), 0, 1))
        a, b, c, d, f = zip(*rows) if rows else ((),) * 5
        return pa.table({"range": pa.array(a, pa.int64()), "gone": pa.array(b, pa.bool_()), "blob": pa.array(c, pa.binary()), "block": pa.array(d, pa.int32()), "blocks": pa.array(f, pa.int32())})

    return classes.groupBy("bucket").applyInArrow(run, "range long, gone boolean, blob binary, block int, blocks int")


def _best(i: np.ndarray, j: np.ndarray, apart: np.ndarray, most_pairs: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The likeliest pairs of each later line i, in order, and how many a line may have.

    A line's bound falls only as likelier pairs come, so the best of the best and more pairs are the best of all."""
    order = np.lexsort((apart, i))
    i, j, apart = i[order], j[order], apart[order]
    start = np.flatnonzero(np.append(True, i[1:] != i[:-1]))
    size = np.diff(np.append(start, len(i)))
    # few for a line whose likeliest partner is well inside the bound, more for a doubtful one
    most = np.where(apart[start] <= 250, BEST, np.where(apart[start] <= 600, 8 * BEST, 128 * BEST))
    most = np.repeat(np.minimum(most, most_pairs), size)
    keep = np.arange(len(i)) - np.repeat(start, size) < most
    return i[keep], j[keep], apart[keep], most[keep]


def _found(entries: DataFrame, open_lines: DataFrame | None = None) -> DataFrame:
    """(doc, line, other_doc, other_line, token, range, low, high): likely earlier lines of each line; no other for an equal one.

    The BEST likeliest of each group of entries; a line that had more there has rows with its tokens, and no other.
    With ``open_lines`` (range, low, high, doc, line) all earlier lines of those lines in that group."""
    again = open_lines is not None
    kinds = {"doc": pa.int64(), "line": pa.int32(), "other_doc": pa.int64(), "other_line": pa.int32(), "token": pa.int32()}

    def rows(group: dict, *columns: np.ndarray | None) -> pa.RecordBatch:
        n = len(columns[0])
        arrays = [pa.nulls(n, k) if c is None else pa.array(c.astype(k.to_pandas_dtype())) for c, k in zip(columns, kinds.values())]
        places = [pa.array(np.full(n, group["range"])), *(pa.array(np.full(n, group[c], np.int32)) for c in ("low", "high"))]
        return pa.RecordBatch.from_arrays(arrays + places, names=[*kinds, *group])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blobs, equal, asked, group = ([], []), [], [], {}  # blobs of the one block and the other, if there are two
        for batch in batches:
            group = {c: batch.column(c)[0].as_py() for c in ("range", "low", "high")}
            own = batch.filter(pc.is_null(batch.column("blob")))
            asked.append(line_hash(own.column("doc").to_numpy(zero_copy_only=False), own.column("line").to_numpy(zero_copy_only=False)) if own.num_rows else np.zeros(0, np.uint64))
            for blob, gone, side in zip(*(batch.column(c).to_pylist() for c in ("blob", "gone", "side"))):
                if blob is not None:
                    (equal if gone else blobs[side]).append(blob)
        if equal and not again:
            equal = unpack(equal, PLACE)
            yield rows(group, equal["doc"], equal["line"], None, None, None)
        asked = np.concatenate(asked)
        e = unpack(blobs[0] + blobs[1], ENTRY)
        if not len(e) or again and not len(asked):
            return
        first = sum(len(b) for b in blobs[0]) // ENTRY.itemsize
        order = np.lexsort((e["n"], e["token"]))
        e, side = e[order], order >= first
        doc, line = e["doc"], e["line"].astype(np.int64)
        token, n, pos = e["token"].astype(np.int64), e["n"].astype(np.int64), e["pos"].astype(np.int64)
        parity, long = [np.ascontiguousarray(e[c]) for c in PARITIES], n > LONG
        total = len(e)
        # each line's place among the lines, the same for all its entries
        order = np.lexsort((line, doc))
        new = np.append(False, (doc[order][1:] != doc[order][:-1]) | (line[order][1:] != line[order][:-1]))
        place = np.empty(total, np.int32)
        place[order] = np.cumsum(new)
        own = order[np.append(True, new[1:])]
        doc, line = doc[own], line[own]
        # the window of each entry: same word, at least NUM / DEN of its size, before it in the order
        key = token << 32 | n
        low = np.searchsorted(key, token << 32 | (NUM * n + DEN - 1) // DEN)
        # only entries that can be the smaller set of a pair are partners
        inner = pos <= n - -(-2 * NUM * n // (NUM + DEN))
        wanted = np.isin(line_hash(doc, line), asked) if again else None

        def likely() -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
            for mine, other in ((False, True), (True, False)) if blobs[1] else ((False, False),):
                ok = inner & (side == other)
                partners = np.flatnonzero(ok)
                before = np.concatenate([[0], np.cumsum(ok)])
                low_p = before[low]
                count = np.where(side == mine, before[np.arange(total)] - low_p, 0)
                at, ends = 0, np.cumsum(count)
                while at < total:
                    to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + 500_000, "right")))
                    i = np.repeat(np.arange(at, to), count[at:to])
                    j = partners[T.ranges(low_p[at:to], count[at:to])]
                    at = to
                    if wanted is not None:
                        ok = wanted[place[i]] | wanted[place[j]]
                        i, j = i[ok], j[ok]
                    # this word and those after it, of which both have at most so many
                    both = n[i] + n[j]
                    need = -(-NUM * both // (NUM + DEN))
                    ok = np.minimum(n[i] - pos[i], n[j] - pos[j]) >= need
                    i, j, both, need = i[ok], j[ok], both[ok], need[ok]
                    apart, most = _apart(parity, long, i, j), both - 2 * need
                    ok = apart <= most
                    # how much of the bound is used, in thousandths; small bounds tell little
                    i, j, apart = place[i[ok]], place[j[ok]], np.where(most[ok] < 6, 999, apart[ok] * 1000 // np.maximum(most[ok], 1)).astype(np.int32)
                    i, j = np.maximum(i, j), np.minimum(i, j)
                    ok = i != j
                    if wanted is not None:
                        ok &= wanted[i]
                    if ok.any():
                        yield i[ok], j[ok], apart[ok]

        if wanted is not None:
            for i, j, _ in likely():
                yield rows(group, doc[i], line[i], doc[j], line[j], None)
            return
        most_pairs = max(BEST, PAIRS // len(doc))
        met = np.zeros(len(doc), np.int64)
        kept, n_kept, bound = [], 0, PAIRS
        for found in likely():
            met += np.bincount(found[0], minlength=len(doc))
            kept.append(found)
            n_kept += len(found[0])
            if n_kept > bound:
                kept = [_best(*(np.concatenate(x) for x in zip(*kept)), most_pairs)[:3]]
                n_kept = len(kept[0][0])
                bound = n_kept + PAIRS
        if kept:
            i, j, _, most = _best(*(np.concatenate(x) for x in zip(*kept)), most_pairs)
            yield rows(group, doc[i], line[i], doc[j], line[j], None)
            more = np.zeros(len(doc), bool)
            more[i] = met[i] > most
            own = np.flatnonzero(more[place])
            if len(own):
                yield rows(group, doc[place[own]], line[place[own]], None, None, token[own])

    # each pair of blocks of a range is one group
    tiles = entries.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    tiles = tiles.select("range", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), (F.col("block") > F.col("other")).cast("int").alias("side"), "gone", "blob")
    tiles = tiles.withColumns({"doc": F.lit(None).cast("long"), "line": F.lit(None).cast("int")})
    if open_lines is not None:
        none = {"side": F.lit(0), "gone": F.lit(False), "blob": F.lit(None).cast("binary")}
        tiles = tiles.unionByName(open_lines.select("range", "low", "high", "doc", "line").distinct().withColumns(none))
    return tiles.groupBy("range", "low", "high").applyInArrow(run, "doc long, line int, other_doc long, other_line int, token int, range long, low int, high int")


def line_hash(doc: np.ndarray, line: np.ndarray) -> np.ndarray:
    return T.mix(doc.astype(np.uint64) * T.U64(0x9E3779B97F4A7C15) + line.astype(np.uint64))


def _bitmap(lines: DataFrame) -> np.ndarray:
    """A bitmap of the hashes of (doc, line): 2^FILTER_BITS bits, whatever the input."""
    blocks = (1 << FILTER_BITS) // (8 * _BINS)

    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((1 << FILTER_BITS) // 8, np.uint8)
        for batch in batches:
            at = (line_hash(batch.column("doc").to_numpy(), batch.column("line").to_numpy()) >> T.U64(64 - FILTER_BITS)).astype(np.int64)
            np.bitwise_or.at(total, at >> 3, (1 << (at & 7)).astype(np.uint8))
        parts = total.reshape(blocks, _BINS)
        some = np.flatnonzero(parts.any(1))
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array([parts[k].tobytes() for k in some], pa.binary())], names=["block", "bits"])

    def merge(table: pa.Table) -> pa.Table:
        one = np.bitwise_or.reduce([np.frombuffer(x, np.uint8) for x in table.column("bits").to_pylist()])
        return pa.table({"block": table.column("block").slice(0, 1), "bits": pa.array([one.tobytes()], pa.binary())})

    out = np.zeros((blocks, _BINS), np.uint8)
    for r in lines.select("doc", "line").mapInArrow(bits, "block long, bits binary").groupBy("block").applyInArrow(merge, "block long, bits binary").collect():
        out[r.block] = np.frombuffer(r.bits, np.uint8)
    return out.reshape(-1)


def _line_sets(docs: DataFrame, ends: DataFrame) -> DataFrame:
    """(doc, line, h): the sets of these lines, and maybe of some others."""
    spark = docs.sparkSession
    few = ends.count() <= FILTER_LINES  # of a written table: its files say it
    sent = spark.sparkContext.broadcast(_bitmap(ends)) if few else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in T.pieces(batch):
                docs_ = piece.column("doc_id").to_numpy()
                data, offsets = T.utf8(piece.column("text"))
                starts, stops, first = T.lines(data, offsets)
                if sent is not None:
                    row = np.repeat(np.arange(len(docs_)), np.diff(first))
                    asked = np.flatnonzero(_marked(sent.value, docs_[row], np.arange(len(starts)) - first[row]))
                else:
                    wanted = piece.column("wanted")
                    asked = np.sort(wanted.flatten().to_numpy() + np.repeat(first[:-1], wanted.value_lengths().to_numpy()))
                # only the lines that are asked for are tokenised
                size = stops[asked] - starts[asked]
                part = data[T.ranges(starts[asked], size)]
                begin, end, word = T.spans(T.NOT_SPACE[part], np.append(0, np.cumsum(size)))
                h = T.span_hashes(T.prefix_sums(T.FOLDED_VALUES[part]), begin, end)
                key, line, _ = _keys(h, np.repeat(np.arange(len(asked)), np.diff(word)), None)  # any order will do here
                row = np.searchsorted(first, asked, "right") - 1
                low, high = (np.searchsorted(line, np.arange(len(asked)), side) for side in ("left", "right"))
                full = high > low
                asked, row, low, high = asked[full], row[full], low[full], high[full]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(docs_[row]), pa.array((asked - first[row]).astype(np.int32)), pa.array([key[a:b].tobytes() for a, b in zip(low, high)], pa.binary())], names=["doc", "line", "h"]
                )

    if not few:
        need = ends.groupBy(F.col("doc").alias("doc_id")).agg(F.collect_list("line").alias("wanted"))
        docs = docs.join(need.hint("shuffle_hash"), "doc_id")
    return docs.mapInArrow(run, "doc long, line int, h binary")


def _verified(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """The distinct (doc, line) of pairs whose whole sets are similar."""
    pairs = T.written(pairs.select("doc", "line", "other_doc", "other_line").distinct(), "pairs")
    ends = T.written(pairs.select("doc", "line").union(pairs.select("other_doc", "other_line")).distinct(), "ends")
    found = T.written(_line_sets(docs, ends).groupBy("doc", "line").agg(F.min("h").alias("h")), "line_sets")
    other = found.select(F.col("doc").alias("other_doc"), F.col("line").alias("other_line"), F.col("h").alias("other"))

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done = None  # the latest line that goes: its further candidates need no look
        for batch in batches:
            keep = []
            for k, (place, x, y) in enumerate(zip(zip(batch.column("doc").to_pylist(), batch.column("line").to_pylist()), batch.column("h"), batch.column("other"))):
                if place == done:
                    continue
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                inter = np.intersect1d(x, y, assume_unique=True).size
                if DEN * inter >= NUM * (len(x) + len(y) - inter):
                    done = place
                    keep.append(k)
            yield batch.select(["doc", "line"]).take(pa.array(keep, pa.int64()))

    # the last join leaves a line's candidates beside each other
    both = pairs.join(other, ["other_doc", "other_line"]).join(found, ["doc", "line"])
    return both.select("doc", "line", "h", "other").mapInArrow(check, "doc long, line int").distinct()


def _place_of(id_col: str, text_col: str) -> Column:
    """The document's place in the order: its id; rows without one come last, by a hash of their text."""
    return F.coalesce(F.col(id_col).cast("long"), F.lit(2**62) + F.shiftrightunsigned(F.xxhash64(text_col), 2))


def repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc, line): the lines that go, numbered from 0."""
    spark = docs.sparkSession
    T.importable(spark)
    texts = docs.select(_place_of(id_col, text_col).alias("doc_id"), F.col(text_col).alias("text"))
    rarity = spark.sparkContext.broadcast(word_rarity(texts))
    # ranges grow with the input: about 16 MB of it each
    chars = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges = int(max(32, min(1 << 20, chars // (8 << 20))))

    rows = T.written(_class_rows(texts, rarity, ranges), "classes")
    classes = rows.where("bucket >= 0")
    crowded = _crowded(classes, ranges)
    found = T.written(_found(_entries(classes, ranges, crowded)), "found")
    gone = T.written(_verified(texts, found.where("other_doc IS NOT NULL")), "gone")
    still = T.written(found.where("token IS NOT NULL").join(gone, ["doc", "line"], "left_anti"), "open")
    if still.count():
        only = spark.sparkContext.broadcast(_bitmap(still.select(F.col("range").alias("doc"), F.col("token").alias("line"))))
        again = _found(_entries(_narrow(classes, ranges, only), ranges, crowded, only), still)
        gone = gone.union(T.written(_verified(texts, again), "gone"))

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = unpack(batch.column("fixed").to_pylist(), PLACE)
            yield pa.RecordBatch.from_arrays([pa.array(own["doc"]), pa.array(own["line"].astype(np.int32))], names=["doc", "line"])

    copies = rows.where("bucket < 0").select("fixed").mapInArrow(places, "doc long, line int")
    return found.where("other_doc IS NULL AND token IS NULL").select("doc", "line").union(copies).union(gone).distinct()


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", drop_empty: bool = True) -> DataFrame:
    """The documents without repeated lines; with ``drop_empty``, one of which no word is left goes."""
    gone = repeated_lines(docs, id_col, text_col).groupBy("doc").agg(F.collect_set("line").alias("gone"))
    rows = docs.withColumn("__doc", _place_of(id_col, text_col)).join(gone.withColumnRenamed("doc", "__doc").hint("shuffle_hash"), "__doc", "left")
    lines = F.split(F.col(text_col), "\n", -1)
    # membership by a map: arrays would be searched once per line
    kept = F.array_join(F.filter(lines, lambda x, i: ~F.map_contains_key(F.map_from_arrays("gone", "gone"), i)), "\n")
    out = rows.withColumn(text_col, F.when(F.col("gone").isNull(), F.col(text_col)).otherwise(kept))
    if drop_empty:
        out = out.where(F.col("gone").isNull() | F.col(text_col).rlike(r"[^\x20\x09-\x0D]"))
    return out.select(*docs.columns)


def line_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document its lines, how many go, and which (numbers from 0, comma-joined)."""
    gone = repeated_lines(docs, id_col, text_col).groupBy("doc").agg(F.array_sort(F.collect_set("line")).alias("gone"))
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = (F.octet_length(text) - F.octet_length(F.replace(text, F.lit("\n"), F.lit(""))) + 1).cast("long")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), _place_of(id_col, text_col).alias("doc"), lines.alias("n_lines"))
    return rows.join(gone, "doc", "left").select(
        "doc_id",
        "n_lines",
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce(F.array_join("gone", ","), F.lit("")).alias("removed_lines"),
    )


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_report(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def brute_force(docs: list[tuple[int, str | None]]) -> list[tuple[int, int, int, str]]:
    """The same rows by comparing all lines, for tests."""
    import re

    lower = lambda s: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)
    seen: list[tuple[tuple[int, int], frozenset]] = []
    out = {}
    for doc, text in sorted(docs):
        lines, gone = (text or "").split("\n"), []
        for k, line in enumerate(lines):
            s = frozenset(re.findall(r"[^\x20\x09-\x0D]+", lower(line)))
            if not s:
                continue
            n = len(s)
            if any(at < (doc, k) and 3 * n <= 4 * len(t) and 3 * len(t) <= 4 * n and 4 * len(s & t) >= 3 * len(s | t) for at, t in seen):
                gone.append(k)
            seen.append(((doc, k), s))
        out[doc] = (doc, len(lines), len(gone), ",".join(map(str, gone)))
    return [out[d] for d, _ in docs]


#: The same rows by a plain prefix filter on exact word counts.
ORACLE_SQL = r"""
WITH t AS (SELECT doc_id, string_split(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), chr(10)) AS x FROM documents),
l AS (SELECT doc_id, unnest(x) AS t, unnest(range(len(x))) AS line FROM t),
k AS (SELECT doc_id, line, doc_id * 1000000 + line AS place, list_sort(list_distinct(regexp_extract_all(t, '[^\x20\x09-\x0D]+'))) AS w FROM l),
c AS (SELECT w, len(w) AS n, min(place) AS f FROM k WHERE len(w) > 0 GROUP BY 1),
u AS (SELECT f, n, unnest(w) AS word FROM c),
o AS (SELECT f, n, word, row_number() OVER (PARTITION BY f ORDER BY df, word) AS r FROM u JOIN (SELECT word, count(*) AS df FROM u GROUP BY 1) USING (word)),
x AS (SELECT f, n, word FROM o WHERE r <= n - (3 * n + 3) // 4 + 1),
p AS (SELECT DISTINCT a.f AS later, b.f AS earlier FROM x a JOIN x b ON a.word = b.word AND a.f > b.f AND 4 * least(a.n, b.n) >= 3 * greatest(a.n, b.n)),
v AS (SELECT later, a.n + b.n AS total, len(list_intersect(a.w, b.w)) AS common FROM p JOIN c a ON a.f = later JOIN c b ON b.f = earlier),
g AS (SELECT DISTINCT later FROM v WHERE 4 * common >= 3 * (total - common)),
e AS (SELECT k.doc_id, k.line FROM k JOIN c ON c.w = k.w WHERE k.place <> c.f OR c.f IN (SELECT later FROM g)),
a AS (SELECT doc_id, count(*) AS n_removed, string_agg(line::VARCHAR, ',' ORDER BY line) AS removed_lines FROM e GROUP BY 1)
SELECT t.doc_id, len(x)::BIGINT AS n_lines, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(removed_lines, '') AS removed_lines FROM t LEFT JOIN a ON a.doc_id = t.doc_id"""
