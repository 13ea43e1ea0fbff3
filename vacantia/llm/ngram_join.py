"""Jaccard self-join of documents on word shingles by PartEnum signatures, and the groups that the links make.

A document's set is its distinct shingles of ``n`` words (64-bit hashes). Sizes fall into bands whose ends
have the ratio of the threshold, so linked sets lie in one band or in neighbouring ones; a set takes part in
its own band and the next. In a band, two linked sets differ in at most k features. The feature domain is
cut by hash into more than k/2 first-level parts, so at least one of them holds at most one difference, and
each of these into ``SECOND`` second-level parts, of which all but one are then equal: every subset of
SECOND - 1 of them is one signature. Subsets without a feature say nothing and are left out. That is exact
as long as fewer first-level parts have such a subset than must agree; a set for which this isn't so also
enters the features of its prefix (the n - ceil(t n) + 1 smallest hashes, of which two linked sets share
one), so no signature is shared without a common feature. Any exact choice of parts needs more than k
signatures, and k grows with the set: there are at most ``1.7 n + 12`` of them for a set of n.

Stages, each a written table where it is used again:
1. documents -> size, two digests and bit sketch of the set; equal sets (same size, 128 bits) make one class.
2. signatures of all sets under their class's digest, packed by hash range inside each task (a class once),
   shuffled as blocks of bytes, and sorted in the receiving task; signatures that several classes share give
   groups of classes. Signatures that are frequent inside a task go as rows of their own, with one entry left
   in the range, so that no task holds the whole of a group that is hot everywhere.
3. Groups: pairs whose sketches allow a link (an exact upper bound of the intersection) make clusters, each
   class in one, and no link leaves a cluster.
4. Clusters get their whole sets, taken from the texts again; the components of the verified links are the
   result.

Stages 3 and 4 compare a group in blocks (``_linked``): its first block with itself and with each other block,
which is linear in its members and joins groups of copies into one component; only blocks of members that
this leaves in different components meet each other afterwards, and what they give are links between
components. A block pair returns a spanning forest, never its pairs, around the same members in every
group, so links grow with members and not with the square of a group's size.

Cases: a null or empty text, or one without words, has an empty set, links with nothing and is its own
component; fewer than n words make one shingle of the whole sequence; ties and repeated rows are rows of
one class; rows are judged by their texts, so rows that share an id or have none may lie in different
components; a null id counts as larger than any other, and a component without any id has a null
component_id; empty tables give empty results; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vacantia.llm import _text as T

SHINGLE = 5
#: The threshold as a fraction: 100 * |A and B| >= 75 * |A or B|.
NUM, DEN = 3, 4
#: Members and features of a block, on average.
TILE = 1024
TILE_FEATURES = 1 << 20
LAST = 2**63 - 1
#: Second-level parts of a first-level part.
SECOND = 3
#: A signature that so many of a task's latest classes share is sent apart from its range.
HOT = 32
#: Entries of a bucket that are met at a time, and classes in one row of a signature.
MET = 4_000_000
ROW = 1 << 16


def shingles(texts: pa.Array, n: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each row, sorted, back to back, and the offsets of the rows."""
    data, offsets = T.utf8(texts)
    starts, ends, first = T.spans(T.NOT_SPACE[data], offsets)
    words = T.span_hashes(T.prefix_sums(T.FOLDED_VALUES[data]), starts, ends)
    h, _, row = T.word_grams(words, first, n)
    count = np.diff(first)
    for m in range(1, n):  # texts of m < n words
        rows = np.flatnonzero(count == m)
        if len(rows):
            x = np.full(len(rows), T.U64(m))
            for k in range(m):
                x = x * T.U64(0xD1342543DE82EF95) + words[first[rows] + k]
            h, row = np.concatenate([h, T.mix(x)]), np.concatenate([row, rows])
    order = np.lexsort((h, row))
    h, row = h[order], row[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
    h, row = h[new], row[new]
    return h, np.searchsorted(row, np.arange(len(offsets)))


def _sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Wrapping sums per row."""
    total = np.zeros(len(values) + 1, T.U64)
    np.cumsum(values, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def _sketches(h: np.ndarray, offsets: np.ndarray) -> list[bytes]:
    """A bitmap of each row's members: a power of two of bits, at least two a member."""
    size = np.diff(offsets)
    bits = np.maximum(64, 1 << np.ceil(np.log2(np.maximum(2 * size, 1))).astype(np.int64))
    begin = np.cumsum(bits) - bits
    row = np.repeat(np.arange(len(size)), size)
    at = np.zeros(int(bits.sum()), bool)
    at[begin[row] + (T.mix(h ^ T.U64(77)) & (bits[row] - 1).astype(T.U64)).astype(np.int64)] = True
    packed = np.packbits(at, bitorder="little")
    return [packed[a // 8 : (a + b) // 8].tobytes() for a, b in zip(begin.tolist(), bits.tolist())]


def _fold(sketch: bytes, width: int) -> np.ndarray:
    """A sketch folded to so many bytes; a bit of a folded sketch still has a member."""
    return np.bitwise_or.reduce(np.frombuffer(sketch, np.uint64).reshape(-1, width // 8), axis=0)


def band_of(size: np.ndarray) -> np.ndarray:
    """The band of each size: band b starts at the smallest size that (NUM/DEN) reaches from the end of band b - 1."""
    return np.searchsorted(_STARTS, size, "right") - 1


_STARTS = [1]
while _STARTS[-1] < 2**40:
    _STARTS.append(max(_STARTS[-1] + 1, -(-_STARTS[-1] * DEN // NUM)))
_STARTS = np.array(_STARTS)


def parts_of(band: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For a band: its largest size, and more first-level parts than half of what two linked sets may differ in."""
    largest = _STARTS[band + 1] - 1
    k = (DEN - NUM) * 2 * largest // (DEN + NUM)
    return largest, k // 2 + 1 + k // 20


def prefix_length(n: np.ndarray) -> np.ndarray:
    """Features of which two linked sets share at least one, if each takes its smallest hashes."""
    return n - (NUM * n + DEN - 1) // DEN + 1


def signatures(h: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Signature hashes of all rows, and the row of each.

    A set differs from a linked one in at most k = (1 - t) / (1 + t) * (|A| + |B|) features, and |B| is at most
    |A| / t and the band's largest size, so at most k / 2 first-level parts hold two differences. Of the others,
    those without an empty subset are ``sure``: each gives a common signature. Two sets that each leave out less
    than half of their own ``sure`` still share one; the smallest parts, which say least, are left out."""
    out, rows_out = [], []
    size = np.diff(offsets)
    for up in (0, 1):
        rows = np.flatnonzero(size > 0)
        band = band_of(size[rows]) + up
        if up:  # only a set that some size of the next band may link with
            fits = size[rows] * DEN // NUM >= _STARTS[band]
            rows, band = rows[fits], band[fits]
        if not len(rows):
            continue
        largest, parts = parts_of(band)
        own = size[rows]
        k = (DEN - NUM) * (own + np.minimum(own * DEN // NUM, largest)) // (DEN + NUM)
        base = np.cumsum(parts) - parts
        row_at = np.repeat(np.arange(len(rows)), own)
        values = h[T.ranges(offsets[rows], own)]
        seed = T.mix(values ^ T.U64(0x1234567))
        part = base[row_at] + ((seed >> T.U64(32)) * parts[row_at].astype(T.U64) >> T.U64(32)).astype(np.int64)
        cell = part * SECOND + (seed % T.U64(SECOND)).astype(np.int64)
        total = int(parts.sum())
        content = np.zeros(total * SECOND, T.U64)
        mixed = T.mix(values)
        np.add.at(content, cell, mixed)
        count = np.bincount(cell, minlength=total * SECOND).reshape(total, SECOND)
        content = content.reshape(total, SECOND)
        whole, filled = content.sum(1), count.sum(1)
        full = filled[:, None] > count  # subsets with a feature, by the second-level part that they leave out
        owner = np.repeat(np.arange(len(rows)), parts)
        sure = np.bincount(owner, full.all(1), len(rows)).astype(np.int64) - k // 2
        # parts of a row by their number of features, the first of which are left out if they are sure
        at = np.flatnonzero(full.all(1))
        at = at[np.lexsort((filled[at], owner[at]))]
        had = np.bincount(owner[at], minlength=len(rows))
        rank = T.ranges(np.zeros(len(rows), np.int64), had)
        takes = full.copy()
        takes[at[rank < np.maximum(sure - 1, 0)[owner[at]] // 2]] = False
        at, without = np.nonzero(takes)
        tag = T.mix(band[owner[at]].astype(T.U64) << T.U64(40) | ((at - base[owner[at]]) * SECOND + without).astype(T.U64))
        out.append(T.mix((whole[at] - content[at, without]) ^ tag))
        rows_out.append(rows[owner[at]])
        odd = np.flatnonzero(sure <= 0)
        if len(odd):
            mine = T.ranges((np.cumsum(own) - own)[odd], own[odd])  # hashes of a row are sorted
            first = T.ranges(np.zeros(len(odd), np.int64), own[odd]) < np.repeat(prefix_length(own[odd]), own[odd])
            of = np.repeat(odd, own[odd])[first]
            out.append(T.mix(mixed[mine[first]] ^ T.mix(~band[of].astype(T.U64))))
            rows_out.append(rows[of])
    if not out:
        return np.zeros(0, T.U64), np.zeros(0, np.int64)
    return np.concatenate(out), np.concatenate(rows_out)


def _link(inter: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return DEN * inter >= NUM * (a + b - inter)


def _sets(docs: DataFrame) -> DataFrame:
    """(doc_id, t, n, a, b, sketch) of each document; a and b are digests of the set, t is a hash of the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in T.pieces(batch):
                h, offsets = shingles(piece.column("text"))
                a, b = _digests(h, offsets)
                yield pa.RecordBatch.from_arrays(
                    [piece.column("doc_id"), piece.column("t"), *map(pa.array, (np.diff(offsets), a.view(np.int64), b.view(np.int64))), pa.array(_sketches(h, offsets), pa.binary())],
                    names=["doc_id", "t", "n", "a", "b", "sketch"],
                )

    return docs.mapInArrow(run, "doc_id long, t long, n long, a long, b long, sketch binary")


def _digests(h: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return T.mix(_sums(T.mix(h), offsets) ^ np.diff(offsets).astype(T.U64)), _sums(T.mix(h ^ T.U64(99)), offsets)


def _packer(ranges: int):
    """Packs the classes of each signature by bucket; a task that runs again gives the same rows."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        part, flushes = task.partitionId() if task else 0, 0
        kept: list[tuple[np.ndarray, np.ndarray]] = []
        n = 0
        met: set[bytes] = set()  # classes that this task has sent, of the latest many

        def flush() -> pa.RecordBatch:
            s, d = (np.concatenate(x) for x in zip(*kept))
            order = np.argsort(s, kind="stable")
            s, d = s[order], d[order]
            start = np.flatnonzero(np.append(True, s[1:] != s[:-1]))
            count = np.diff(np.append(start, len(s)))
            bucket = ((s >> T.U64(32)) * T.U64(ranges) >> T.U64(32)).astype(np.int64)
            gid = bucket.astype(T.U64) << T.U64(32) | s & T.U64(2**32 - 1)
            often = np.repeat(count >= HOT, count)
            stays = ~often
            stays[start] = True
            # entries of hot signatures go to a bucket of this flush alone, the same whenever the task runs
            own = -1 - int(T.mix(np.array([part << 32 | flushes], np.uint64))[0] >> T.U64(2))
            hot = [(own, gid[often].tobytes(), d[often].tobytes())] if often.any() else []
            bucket, low, d = bucket[stays], s[stays].astype(np.uint32), d[stays]
            cut = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
            ends = np.append(cut[1:], len(bucket))
            rows = [(int(bucket[a]), low[a:b].tobytes(), d[a:b].tobytes()) for a, b in zip(cut, ends)] + hot
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.binary(), pa.binary()))], names=["bucket", "s", "d"])

        for batch in batches:
            for piece in T.pieces(batch):
                h, offsets = shingles(piece.column("text"))
                a, b = _digests(h, offsets)
                # a class once, whatever its copies
                one = []
                for k, name in enumerate(np.stack([a, b], axis=1)):
                    if (name := name.tobytes()) not in met:
                        met.add(name)
                        one.append(k)
                if len(met) > 200_000:
                    met.clear()
                one = np.array(one, np.int64)
                size = np.diff(offsets)[one]
                s, row = signatures(h[T.ranges(offsets[one], size)], np.append(0, np.cumsum(size)))
                kept.append((s, a[one][row]))
                n += len(s)
                if n > 1_000_000:
                    yield flush()
                    kept, n, flushes = [], 0, flushes + 1
        if n:
            yield flush()

    return pack


def _meeting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The classes of each signature from packed rows in order of their buckets, ``MET`` entries at a time.

    A bucket with more entries gives rows for each portion, and a signature with more than ``ROW`` classes several rows:
    those are marked as hot, single classes too, as others of their signature may be in another row."""

    def out(bucket: int, kept: list[tuple[bytes, bytes]], portion: bool) -> pa.RecordBatch:
        own = bucket < 0
        s = np.frombuffer(b"".join(x for x, _ in kept), np.uint64 if own else np.uint32)
        d = np.frombuffer(b"".join(x for _, x in kept), np.uint64)
        order = np.lexsort((d, s))
        s, d = s[order], d[order]
        new = np.ones(len(s), bool)
        new[1:] = (s[1:] != s[:-1]) | (d[1:] != d[:-1])
        s, d = s[new], d[new]
        cut = np.flatnonzero(np.append(True, s[1:] != s[:-1]))
        size = np.diff(np.append(cut, len(s)))
        if not portion and not own:
            many = np.flatnonzero(size > 1)
            cut, size = cut[many], size[many]
        rows = -(-size // ROW)
        of = np.repeat(np.arange(len(cut)), rows)
        step = (np.arange(len(of)) - np.repeat(np.cumsum(rows) - rows, rows)) * ROW
        hot = np.full(len(of), portion or own) | (rows > 1)[of]
        cut, size = cut[of] + step, np.minimum(size[of] - step, ROW)
        gid = s[cut] if own else np.uint64(bucket << 32) | s[cut].astype(np.uint64)
        flat, ends = d[T.ranges(cut, size)], np.append(0, np.cumsum(size))
        d1, d2 = _sums(T.mix(flat), ends), _sums(T.mix(flat ^ T.U64(99)), ends)
        members = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat.view(np.int64)))
        columns = {"gid": gid.view(np.int64), "hot": hot, "members": members, "n": size, "d1": d1.view(np.int64), "d2": d2.view(np.int64)}
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns.values()], names=list(columns))

    now, kept, n, portion = None, [], 0, False
    for batch in batches:
        for bucket, s, d in zip(*(batch.column(c).to_pylist() for c in ("bucket", "s", "d"))):
            if bucket != now:
                if kept:
                    yield out(now, kept, portion)
                now, kept, n, portion = bucket, [], 0, False
            elif n + len(d) // 8 > MET:
                yield out(now, kept, True)
                kept, n, portion = [], 0, True
            kept.append((s, d))
            n += len(d) // 8
    if kept:
        yield out(now, kept, portion)


def _shared(docs: DataFrame, ranges: int) -> DataFrame:
    """(gid, hot, members, n, d1, d2): sorted digests of the classes of each shared signature; a hot one has several rows."""
    packed = docs.select("text").mapInArrow(_packer(ranges), "bucket long, s binary, d binary")
    ordered = packed.repartition("bucket").sortWithinPartitions("bucket")
    return ordered.mapInArrow(_meeting, "gid long, hot boolean, members array<long>, n long, d1 long, d2 long")


def _groups(shared: DataFrame) -> DataFrame:
    """(gid, size, a): the members of each group; groups with the same members are one, unless they are in several rows."""
    hot = shared.where("hot").select("gid").distinct()
    single = shared.where("NOT hot").join(hot, "gid", "left_anti").dropDuplicates(["n", "d1", "d2"]).select("gid", F.col("n").alias("size"), F.explode("members").alias("a"))
    several = shared.join(hot, "gid", "left_semi").select("gid", F.explode("members").alias("a")).distinct()
    sizes = several.groupBy("gid").agg(F.count("*").alias("size"))
    return single.union(several.join(sizes, "gid").select("gid", "size", "a"))


def _most(x: np.ndarray, y: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """An upper bound of the intersections of sets of n and m members with the sketches x and y."""
    return np.minimum(n - np.bitwise_count(x & ~y).sum(1).astype(np.int64), m - np.bitwise_count(~x & y).sum(1).astype(np.int64))


class _Common:
    """Sizes of the intersections of pairs of sets."""

    def __init__(self, sets: list[np.ndarray]):
        self.size = np.array([len(x) for x in sets], np.int64)
        self.begin = np.cumsum(self.size) - self.size
        values, self.code = np.unique(np.concatenate(sets), return_inverse=True)
        self.span = len(values)
        self.key = np.repeat(np.arange(len(sets)), self.size) * self.span + self.code

    def of(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        out, ends, at = np.zeros(len(i), np.int64), np.cumsum(self.size[j]), 0
        while at < len(i):
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + 1_000_000, "right")))
            size = self.size[j[at:to]]
            asked = np.repeat(i[at:to], size) * self.span + self.code[T.ranges(self.begin[j[at:to]], size)]
            found = self.key[np.minimum(np.searchsorted(self.key, asked), len(self.key) - 1)] == asked
            out[at:to] = T.per_row(found, np.append(0, np.cumsum(size)))
            at = to
        return out


def _forest(labels: np.ndarray, i: np.ndarray, j: np.ndarray) -> list[tuple[int, int]]:
    """Pairs of labels of the pairs (i, j) that join what wasn't joined."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.get(x, x)) != x:
            parent[x] = x = parent.get(up, up)
        return x

    out = []
    for x, y in zip(labels[i].tolist(), labels[j].tolist()):
        p, q = root(x), root(y)
        if p != q:
            parent[max(p, q)] = min(p, q)
            out.append((x, y))
    return out


def _compare(tiles: DataFrame, exact: bool, buckets: int) -> DataFrame:
    """(a, b): pairs of labels that join the members of each tile (tile, side, doc, label, u, n, data), many tiles at a time.

    A tile compares side 0 with side 1, or with itself if there is no side 1. ``data`` is the set if ``exact``,
    else the sketch, and then pairs that may link are joined."""

    def run(table: pa.Table) -> pa.Table:
        tile, side, u = (table.column(c).to_numpy() for c in ("tile", "side", "u"))
        order = np.lexsort((u.view(np.uint64), side, tile))
        tile, side = tile[order], side[order]
        label, size = table.column("label").to_numpy()[order], table.column("n").to_numpy()[order]
        data = table.column("data").to_pylist()
        data = [data[k] for k in order.tolist()]
        common = None
        if exact:
            sets = [np.frombuffer(x, np.uint64) for x in data]
            common = _Common(sets)
            data = _sketches(np.concatenate(sets), np.append(0, np.cumsum(size)))
        cut = np.flatnonzero(np.append(True, tile[1:] != tile[:-1]))
        count = np.diff(np.append(cut, len(tile)))
        width = np.minimum.reduceat(np.array([len(x) for x in data]), cut)
        second = np.add.reduceat(side, cut)
        first = np.where(second > 0, cut + count - second, cut + count)  # of the second side, the end if there is none

        def links(bits: np.ndarray | _Placed, base: int, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            ok = label[i] != label[j]
            i, j = i[ok], j[ok]
            ok = _link(_most(bits[i - base], bits[j - base], size[i], size[j]), size[i], size[j])
            i, j = i[ok], j[ok]
            if exact and len(i):
                ok = _link(common.of(i, j), size[i], size[j])
                i, j = i[ok], j[ok]
            return i, j

        pairs: list[tuple[int, int]] = []
        # small tiles, all pairs at a time
        for w in np.unique(width[count <= 16]):
            those = np.flatnonzero((width == w) & (count <= 16))
            rows = T.ranges(cut[those], count[those])
            bits = np.stack([_fold(data[r], w) for r in rows.tolist()])
            place = np.zeros(len(tile), np.int64)
            place[rows] = np.arange(len(rows))
            end, second_at = (np.repeat(x, count[those]) for x in ((cut + count)[those], first[those]))
            low = np.where(second_at < end, second_at, rows + 1)
            partners = np.where(side[rows] == 1, 0, end - low)
            i, j = np.repeat(rows, partners), T.ranges(low, partners)
            step = max(1, 4_000_000 // (w // 8))
            for at in range(0, len(i), step):
                x, y = i[at : at + step], j[at : at + step]
                x, y = links(_Placed(bits, place), 0, x, y)
                pairs += _forest(label, x, y)
        # large ones member by member, as one member often joins all
        for k in np.flatnonzero(count > 16).tolist():
            rows = np.arange(cut[k], cut[k] + count[k])
            bits = np.stack([_fold(data[r], width[k]) for r in rows.tolist()])
            _, comp = np.unique(label[rows], return_inverse=True)
            middle = int(first[k] - cut[k])
            for i in range(middle if middle < len(rows) else len(rows) - 1):
                others = np.arange(middle if middle < len(rows) else i + 1, len(rows))
                others = others[comp[others] != comp[i]]
                if not len(others):
                    continue
                _, found = links(bits, int(cut[k]), np.full(len(others), rows[i]), rows[others])
                for j in (found - cut[k]).tolist():
                    if comp[i] != comp[j]:
                        pairs.append((int(label[rows[i]]), int(label[rows[j]])))
                        comp[comp == comp[j]] = comp[i]
                if (comp == comp[0]).all():
                    break
        x = np.array(pairs, np.int64).reshape(-1, 2)
        x = np.unique(np.stack([x.min(1), x.max(1)], axis=1), axis=0) if len(x) else x
        return pa.table({"a": np.ascontiguousarray(x[:, 0]), "b": np.ascontiguousarray(x[:, 1])})

    rows = tiles.select(F.pmod("tile", F.lit(buckets)).alias("bucket"), "tile", "side", "doc", "label", "u", "n", "data")
    return rows.groupBy("bucket").applyInArrow(run, "a long, b long").distinct()


class _Placed:
    """Rows of an array by their places elsewhere."""

    def __init__(self, rows: np.ndarray, place: np.ndarray):
        self.rows, self.place = rows, place

    def __getitem__(self, at: np.ndarray) -> np.ndarray:
        return self.rows[self.place[at]]


def _linked(members: DataFrame, exact: bool) -> DataFrame:
    """(doc, label): components of what the comparison joins inside groups (gid, doc, n, data); documents joined with none are left out."""
    sizes = members.groupBy("gid").agg(F.greatest(F.count("*") / TILE, F.sum("n") / TILE_FEATURES).alias("weight"), F.count("*").alias("size"), F.sum("n").alias("features"))
    sizes = T.written(sizes, "sizes")
    load = sizes.agg(F.sum("size"), F.sum("features"), F.max("weight")).first()
    if load[0] is None:
        return members.sparkSession.createDataFrame([], "doc long, label long")
    # about ten thousand members or a million features at a time
    buckets = int(max(load[0] // 10_000, load[1] // TILE_FEATURES if exact else 0) + 64)
    u = F.xxhash64(F.lit(5), "doc")
    in_31 = lambda n: F.shiftright(F.shiftrightunsigned("u", 33) * n, 31)
    rows = members.join(sizes.where("size > 1").select("gid", F.ceil("weight").alias("blocks")), "gid").withColumn("u", u).withColumn("block", in_31(F.col("blocks")))
    # the first block meets every other one
    tiles = rows.withColumn("at", F.explode(F.when(F.col("block") == 0, F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).otherwise(F.array("block"))))
    tiles = tiles.withColumn("tile", F.xxhash64("gid", "at")).withColumn("side", (F.col("block") > 0).cast("int")).withColumn("label", F.col("doc"))
    labels = components(T.written(_compare(tiles, exact, buckets), "links")).select(F.col("doc_id").alias("doc"), "label")
    if load[2] <= 1:
        return labels
    # members of large groups that are in different components by now
    big = rows.where("blocks > 1").drop("block", "blocks").join(labels, "doc", "left").withColumn("label", F.coalesce("label", "doc"))
    big = T.written(big, "large")
    counts = big.groupBy("gid", "label").agg(F.greatest(F.count("*") / TILE, F.sum("n") / TILE_FEATURES).alias("weight"))
    own = counts.where("weight > 0.5").select("gid", "label", F.ceil("weight").alias("nb"))
    own = own.withColumn("base", F.sum("nb").over(Window.partitionBy("gid").orderBy("label")) - F.col("nb"))
    rest = counts.groupBy("gid").agg(
        F.count("*").alias("n_labels"),
        F.coalesce(F.sum(F.when(F.col("weight") > 0.5, F.ceil("weight"))), F.lit(0)).alias("rest_base"),
        F.ceil(F.coalesce(F.sum(F.when(F.col("weight") <= 0.5, F.col("weight"))), F.lit(0.0))).alias("rest_nb"),
    )
    placed = big.join(rest.where("n_labels > 1"), "gid").join(own, ["gid", "label"], "left")
    alone = F.col("nb").isNotNull()
    block = F.when(alone, F.col("base") + in_31(F.col("nb"))).otherwise(F.col("rest_base") + F.pmod(F.xxhash64("label"), F.col("rest_nb")))
    others = F.filter(F.sequence(F.lit(0).cast("long"), F.col("rest_base") + F.col("rest_nb") - 1), lambda p: ~alone | (p < F.col("base")) | (p >= F.col("base") + F.col("nb")))
    tiles = placed.withColumn("block", block).withColumn("at", F.explode(others))
    tiles = tiles.withColumn("tile", F.xxhash64("gid", F.least("block", "at"), F.greatest("block", "at"))).withColumn("side", (F.col("block") > F.col("at")).cast("int"))
    further = components(T.written(_compare(tiles, exact, buckets), "links")).select(F.col("doc_id").alias("label"), F.col("label").alias("root"))
    moved = labels.join(further, "label", "left").select("doc", F.coalesce("root", "label").alias("label"))
    new = further.join(labels.select(F.col("doc").alias("label")), "label", "left_anti").select(F.col("label").alias("doc"), F.col("root").alias("label"))
    return T.written(moved.union(new), "labels")


def _whole_sets(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """(doc, h): the shingles of the wanted classes (doc, doc_id, t), from the texts of these rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in T.pieces(batch):
                h, offsets = shingles(piece.column("text"))
                yield pa.RecordBatch.from_arrays([piece.column("doc"), pa.array([h[a:b].tobytes() for a, b in zip(offsets[:-1], offsets[1:])], pa.binary())], names=["doc", "h"])

    rows = texts.join(wanted.hint("shuffle_hash"), ["doc_id", "t"]).select("doc", "text")
    return rows.mapInArrow(run, "doc long, h binary").groupBy("doc").agg(F.min("h").alias("h"))


def components(links: DataFrame) -> DataFrame:
    """(doc_id, label) of every id in the links (a, b); the label is the smallest id reachable.

    Rounds of contraction: each id points to its smallest neighbour if that is smaller, pointers are followed to
    their ends, and the links between the ends are the next round's. An end is smaller than all its neighbours, so
    at most half of the ids are ends and the rounds are few whatever the shape, without a limit. Each step is a
    written table, so a lost executor repeats a step at most."""
    edge = lambda x, y: (F.least(x, y).alias("a"), F.greatest(x, y).alias("b"))
    edges = T.written(links.select(*edge("a", "b")).where("a < b").distinct(), "edges")
    labels = None
    while labels is None or edges.limit(1).count():
        up = edges.groupBy(F.col("b").alias("doc_id")).agg(F.min("a").alias("label"))
        ups = T.written(up.union(edges.select("a", "a").distinct()).groupBy("doc_id").agg(F.min("label").alias("label")), "up")
        moved = 1
        while moved:
            far = ups.select(F.col("doc_id").alias("label"), F.col("label").alias("far"))
            new = T.written(ups.join(far, "label").select("doc_id", F.col("far").alias("label"), (F.col("far") < F.col("label")).alias("moved")), "up")
            moved = new.where("moved").limit(1).count()
            ups = new.select("doc_id", "label")
        to = ups.select(F.col("doc_id").alias("label"), F.col("label").alias("far"))
        labels = ups if labels is None else T.written(labels.join(to, "label", "left").select("doc_id", F.coalesce("far", "label").alias("label")), "labels")
        ends = edges.join(ups.select(F.col("doc_id").alias("a"), F.col("label").alias("x")), "a").join(ups.select(F.col("doc_id").alias("b"), F.col("label").alias("y")), "b")
        edges = T.written(ends.where("x <> y").select(*edge("x", "y")).distinct(), "edges")
    return labels


def _judged(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, t, n, label) of each row: a hash of its text, the size of its set and its component; LAST for a null id."""
    T.importable(docs.sparkSession)
    text = F.col(text_col)
    texts = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(LAST)).alias("doc_id"), F.xxhash64(text).alias("t"), text.alias("text"))
    sets = T.written(_sets(texts), "sets")
    key = ["n", "a", "b"]
    # a class's number is its row that stands for it; the same in every read, as the table is written
    classes = sets.where("n > 0").groupBy(*key).agg(F.min(F.struct("doc_id", "t", "sketch")).alias("row"))
    classes = T.written(classes.select(F.monotonically_increasing_id().alias("doc"), *key, "row.*"), "classes")
    total = classes.agg(F.sum("n")).first()[0] or 0
    ranges = int(max(64, min(1 << 20, total // 400_000)))
    groups = _groups(T.written(_shared(texts, ranges), "shared"))
    # classes of one 64-bit digest are all members
    members = groups.join(classes.select("a", "doc", "n", F.col("sketch").alias("data")), "a").drop("a", "size")
    clusters = T.written(_linked(T.written(members, "members"), False), "clusters")
    whole = _whole_sets(texts, classes.join(clusters, "doc").select("doc", "doc_id", "t"))
    rows = clusters.select(F.col("label").alias("gid"), "doc").join(whole, "doc").select("gid", "doc", F.expr("octet_length(h) div 8").alias("n"), F.col("h").alias("data"))
    labels = _linked(T.written(rows, "whole"), True)
    own = classes.select("doc", *key).join(labels, "doc", "left").select(*key, F.coalesce("label", "doc").alias("label"))
    return sets.drop("sketch").join(own, key, "left").select("doc_id", "t", "n", "label")


def link_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (the smallest id reachable by links)."""
    judged = T.written(_judged(docs, id_col, text_col), "judged")
    heads = T.written(judged.where("label IS NOT NULL").groupBy("label").agg(F.min("doc_id").alias("head")), "heads")
    null = lambda c: F.nullif(c, F.lit(LAST))
    out = judged.join(heads, "label", "left")
    return out.select(null(F.col("doc_id")).alias("doc_id"), F.col("n").alias("n_shingles"), null(F.coalesce("head", "doc_id")).alias("component_id"))


def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Of each group of linked documents the one with the smallest id, and all that are linked with nothing; columns unchanged.

    A null id is larger than any other. Of repeated rows (same id and text, with words) one stays; of rows of one group that
    share the smallest id, or have none, with different texts, the one with the smallest text hash. Rows without
    words all stay."""
    row = [F.coalesce(F.col(id_col).cast("long"), F.lit(LAST)).alias("__id"), F.xxhash64(text_col).alias("__t")]
    found = T.written(_judged(docs, id_col, text_col).where("n > 0"), "judged")
    first = F.min(F.struct("doc_id", "t"))
    heads = T.written(found.groupBy("label").agg(first.alias("head")), "heads")  # so that the join below may split a large component
    drop = found.join(heads, "label").where((F.col("doc_id") != F.col("head.doc_id")) | (F.col("t") != F.col("head.t"))).select(F.col("doc_id").alias("__id"), F.col("t").alias("__t"))
    twice = found.groupBy(F.col("doc_id").alias("__id"), F.col("t").alias("__t")).agg(F.count("*").alias("n")).where("n > 1").drop("n")
    rows = docs.select("*", *row)
    key = ["__id", "__t"]
    once = rows.join(drop.union(twice).distinct().hint("shuffle_hash"), key, "left_anti")
    doubled = rows.join(twice.join(drop.distinct(), key, "left_anti"), key, "left_semi").dropDuplicates(key)
    return once.select(*docs.columns).union(doubled.select(*docs.columns))


def brute_force(docs: list[tuple[int | None, str | None]], n: int = SHINGLE) -> list[tuple[int | None, int, int | None]]:
    """The same rows by comparing all pairs of rows, for tests."""
    import re

    lower = lambda s: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s or "")
    sets = []
    for _, text in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
        sets.append({tuple(w[i : i + n]) for i in range(len(w) - n + 1)} or ({tuple(w)} if w else set()))
    label = list(range(len(docs)))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for i, x in enumerate(sets):
        for j in range(i):
            y = sets[j]
            if x and y and 4 * min(len(x), len(y)) >= 3 * max(len(x), len(y)) and 100 * len(x & y) >= 75 * len(x | y):
                label[find(i)] = find(j)
    ids: dict[int, list[int]] = {}
    for k, (doc, _) in enumerate(docs):
        ids.setdefault(find(k), []).append(LAST if doc is None else doc)
    least = {k: None if min(v) == LAST else min(v) for k, v in ids.items()}
    return [(doc, len(sets[k]), least[find(k)]) for k, (doc, _) in enumerate(docs)]


ORACLE_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(doc_id, other) AS (SELECT a, b FROM e UNION SELECT r.doc_id, e.b FROM r JOIN e ON e.a = r.other)
SELECT w.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, least(w.doc_id, coalesce(min(other), w.doc_id)) AS component_id
FROM w LEFT JOIN n ON n.doc_id = w.doc_id LEFT JOIN r ON r.doc_id = w.doc_id GROUP BY w.doc_id, n.n"""
