"""The prefix trie of conversations, its subtree totals made by time-forward processing.

Turns are hashed (128 bits of role and text) and sorted by conversation and turn into ranges; a running polynomial of the
hashes modulo 2^64, in two lanes, names every prefix of a conversation. A range is summed by its task, and what runs on from the
range before is added by one carry for each range (the only thing collected, at most two rows a range), so a conversation
may be longer than a task. Rebuilt conversations are prefixes of the base and shifted rests of the own turns, whose names follow from
the running sums without a new pass.

A node is a distinct (depth, name). Totals of subtrees go from children to parents: nodes are sorted by Spark in reverse
level order (deepest first), each sends its totals to its parent through a priority queue in the same order, and a node takes
its messages out when its turn comes; queues spill sorted runs into the shared folder. Shards are whole subtrees of at most ``LIMIT`` turns, cut
below the deepest larger node of each conversation; their roots' totals are added up for each parent, and the larger nodes
follow in the same way across shard roots, in bands of ``LEVELS`` levels from the deepest up, a band's nodes dealt by
their ancestor at its top. There are at most (turns / LIMIT) larger nodes on a level. The digest of a node's ends is a stream over
ids sorted by Spark and packed by range.

Cases: rows without a conv_id belong to no conversation and are left out; a null role or text is empty; a null turn
comes first; equal turns go by the md5 of the role's length in bytes, ``:``, role and text, so repeated rows are turns of
their own in any order; texts are hashed whole; an empty table gives no nodes, and conversations that are turnless when
rebuilt end at the root; other columns, whatever their names, are not looked at. ``c % 5`` has the sign of c.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vacantia.llm import _files
from vacantia.llm import _text as T

#: Conversations share the turns of the first of so many, and at most so many turns.
EVERY, MOST = 5, 8
#: Turns below the root of a shard, at most.
LIMIT = 1 << 16
#: Levels of one band of larger nodes.
LEVELS = 1 << 12
#: Messages that a queue holds before it spills a run.
HELD = 1 << 20
#: Messages of a run that are read at a time.
READ = 1 << 14
#: Ids in one packed piece of a node's ends.
PACK = 1000

NODE = ["depth", "k1", "k2"]


def _parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _longs(batch: pa.RecordBatch, *names: str) -> list[np.ndarray]:
    return [batch.column(n).to_numpy(zero_copy_only=False).astype(np.int64) for n in names]


def _batch(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c.view(np.int64) if isinstance(c, np.ndarray) and c.dtype == np.uint64 else c) for c in columns.values()], names=list(columns))


def _power(k: int) -> np.uint64:
    return T.U64(pow(int(T._BASE), k, 2**64))


# --- names of prefixes


def _scan(turns: DataFrame) -> DataFrame:
    """(conv_id, part, j, t1, t2, p1, p2, bytes): turns in order, ranges numbered, with running sums up to and before the turn inside its range."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        last, done, carry = None, 0, (T.U64(0), T.U64(0))
        for batch in batches:
            if not batch.num_rows:
                continue
            (conv,) = _longs(batch, "conv_id")
            lanes = np.frombuffer(b"".join(batch.column("m").to_pylist()), np.uint64).reshape(-1, 2)
            new = np.append(True, conv[1:] != conv[:-1])
            start = np.maximum.accumulate(np.where(new, np.arange(len(conv)), 0))
            j = np.arange(len(conv)) - start
            runs_on = (start == 0) & (last is not None and conv[0] == last)
            up, before = [], []
            for k in range(2):
                sums = T.prefix_sums(lanes[:, k])
                for out, at in ((up, sums[1:]), (before, sums[:-1])):
                    own = (at - sums[start]) * T._inverses[start]
                    out.append(np.where(runs_on, carry[k] + own * _power(done), own))
            j = np.where(runs_on, j + done, j)
            last, done, carry = conv[-1], int(j[-1]) + 1, (up[0][-1], up[1][-1])
            yield _batch(conv_id=conv, part=np.full(len(conv), part), j=j, t1=up[0], t2=up[1], p1=before[0], p2=before[1], bytes=_longs(batch, "bytes")[0])

    order = ["conv_id", F.asc_nulls_first("turn"), "m", "row"]
    ranged = turns.repartitionByRange(_parts(turns.sparkSession), *order).sortWithinPartitions(*order)
    return ranged.mapInArrow(run, "conv_id long, part long, j long, t1 long, t2 long, p1 long, p2 long, bytes long")


def _named(scan: DataFrame, spans: DataFrame) -> DataFrame:
    """The scan with p, the turn's place from 1, and sums from the conversation's first turn on."""
    several = spans.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("part", "n", "t1", "t2"))).alias("spans")).where(F.size("spans") > 1)
    carries: dict[tuple[int, int], tuple[int, np.uint64, np.uint64]] = {}
    for row in several.collect():  # a range has at most two conversations that go beyond it
        done, sums = 0, [T.U64(0), T.U64(0)]
        for s in row.spans:
            carries[row.conv_id, s.part] = (done, *sums)
            with np.errstate(over="ignore"):
                sums = [c + _power(done) * T.U64(t % 2**64) for c, t in zip(sums, (s.t1, s.t2))]
            done += s.n
    long = np.array(sorted({c for c, _ in carries}), np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            conv, part, j, size = _longs(batch, "conv_id", "part", "j", "bytes")
            sums = [x.view(np.uint64).copy() for x in _longs(batch, "t1", "p1", "t2", "p2")]
            at = np.flatnonzero(np.isin(conv, long))
            cut = np.flatnonzero(np.append(True, (conv[at][1:] != conv[at][:-1]) | (part[at][1:] != part[at][:-1]))) if len(at) else at
            for a, b in zip(cut, np.append(cut[1:], len(at))):
                rows = at[a:b]
                done, *carry = carries[int(conv[rows[0]]), int(part[rows[0]])]
                j[rows] += done
                for k, s in enumerate(sums):
                    s[rows] = carry[k // 2] + _power(done) * s[rows]
            yield _batch(conv_id=conv, part=part, p=j + 1, t1=sums[0], p1=sums[1], t2=sums[2], p2=sums[3], bytes=size)

    return scan.mapInArrow(run, "conv_id long, part long, p long, t1 long, p1 long, t2 long, p2 long, bytes long")


def _moved(sums: np.ndarray, own: np.ndarray, base: np.ndarray, h: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Running sums of a rest that follows m turns of the base in place of its own first h."""
    T._grow(MOST + 2)
    return base.view(np.uint64) + T._inverses[h - m] * (sums.view(np.uint64) - own.view(np.uint64))


def _plans(heads: DataFrame) -> DataFrame:
    """How each conversation is rebuilt: h, m (turns that the base gives), size, the sums before its own rest (o) and of what stands for it (b), its end (e), and the base's turns."""
    base = heads.select(F.col("conv_id").alias("base"), F.col("n").alias("n_base"), F.col("head").alias("base_head"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % (MOST + 1)).cast("long")
    rows = heads.withColumn("h", h).withColumn("base", F.col("conv_id") - F.col("conv_id") % EVERY).join(base, "base", "left")
    rows = rows.withColumn("m", F.least("h", F.coalesce("n_base", F.lit(0))))
    at = lambda head, k, name: F.coalesce(F.get(F.col(head), (F.col(k) - 1).cast("int"))[name], F.lit(0)).alias(f"{'b' if k == 'm' else 'o'}{name[1]}")
    given = F.when(F.col("m") > 0, F.slice("base_head", F.lit(1), F.col("m").cast("int"))).alias("given")
    size = (F.col("m") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("size")
    rows = rows.select("conv_id", "n", "h", "m", size, "l1", "l2", given, *(at("base_head", "m", t) for t in ("t1", "t2")), *(at("head", "h", t) for t in ("t1", "t2")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, h, m, *x = _longs(batch, "n", "h", "m", "l1", "o1", "b1", "l2", "o2", "b2")
            ends = [np.where(n > h, _moved(*x[k : k + 3], h, m), x[k + 2].view(np.uint64)).view(np.int64) for k in (0, 3)]
            keep = ["conv_id", "h", "m", "size", "b1", "b2", "o1", "o2", "given"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), *map(pa.array, ends)], names=[*keep, "e1", "e2"])

    head = "array<struct<p: long, t1: long, t2: long, p1: long, p2: long, bytes: long>>"
    return rows.mapInArrow(run, f"conv_id long, h long, m long, size long, b1 long, b2 long, o1 long, o2 long, given {head}, e1 long, e2 long")


def _rebuilt(named: DataFrame, spans: DataFrame, plans: DataFrame) -> DataFrame:
    """(conv_id, size, depth, k1, k2, up1, up2, bytes): every prefix of every rebuilt conversation, with its parent's name."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p, h, m, o1, b1, o2, b2 = _longs(batch, "p", "h", "m", "o1", "b1", "o2", "b2")
            t1, t2, p1, p2 = _longs(batch, "t1", "t2", "p1", "p2")
            keys = [_moved(t, o, b, h, m) for t, o, b in ((t1, o1, b1), (t2, o2, b2), (p1, o1, b1), (p2, o2, b2))]
            conv, size, length = _longs(batch, "conv_id", "size", "bytes")
            yield _batch(conv_id=conv, size=size, depth=p - h + m, k1=keys[0], k2=keys[1], up1=keys[2], up2=keys[3], bytes=length)

    # a conversation's plan goes to each range that has turns of it, so no key has more turns than a range
    dealt = plans.select("conv_id", "h", "m", "size", "b1", "b2", "o1", "o2").join(spans.select("conv_id", "part"), "conv_id")
    rest = named.join(dealt, ["conv_id", "part"]).where(F.col("p") > F.col("h"))
    rest = rest.mapInArrow(run, "conv_id long, size long, depth long, k1 long, k2 long, up1 long, up2 long, bytes long")
    given = plans.select("conv_id", "size", F.explode("given").alias("g")).select("conv_id", "size", "g.p", "g.t1", "g.t2", "g.p1", "g.p2", "g.bytes")
    zero = F.lit(0).cast("long")
    return rest.union(given).union(plans.select("conv_id", "size", *[zero] * 6))


# --- time-forward processing


def _added(m: np.ndarray) -> np.ndarray:
    """Messages (k1, k2, children, leaves, saved), one for each key, sorted."""
    m = m[np.lexsort((m[:, 1], m[:, 0]))]
    start = np.flatnonzero(np.append(True, (m[1:, 0] != m[:-1, 0]) | (m[1:, 1] != m[:-1, 1]))) if len(m) else np.zeros(0, np.int64)
    return np.column_stack([m[start, :2], np.add.reduceat(m[:, 2:], start)]) if len(m) else m


class Run:
    """A sorted run of messages, in memory or in a file."""

    def __init__(self, first: np.ndarray, uri: str | None = None):
        self.rows, self.uri, self.file = first, uri, _files.open_input(uri) if uri else None

    def more(self) -> bool:
        if self.file is None:
            return False
        self.rows = np.frombuffer(self.file.read(READ * 40), np.int64).reshape(-1, 5)
        if not len(self.rows):
            self.file.close()
            self.file = None
            _files.remove(self.uri)
        return self.file is not None

    def upto(self, k1: int, k2: int) -> Iterator[np.ndarray]:
        while len(self.rows) or self.more():
            a, b = np.searchsorted(self.rows[:, 0], k1, "left"), np.searchsorted(self.rows[:, 0], k1, "right")
            n = int(a + np.searchsorted(self.rows[a:b, 1], k2, "right"))
            if n:
                yield self.rows[:n]
            self.rows = self.rows[n:]
            if len(self.rows):
                return


class Queue:
    """Messages to nodes by reverse level order. All that a level sends goes to the next one, so the queue is a set of sorted runs of
    one level that is read and a buffer of the next that is filled; a full buffer becomes a run in the shared folder."""

    def __init__(self, folder: str, held: int = HELD):
        self.folder, self.held, self.runs, self.spilled, self.buffer, self.n = folder, held, [], [], [], 0

    def push(self, messages: np.ndarray) -> None:
        self.buffer.append(messages)
        self.n += len(messages)
        if self.n > self.held:
            rows = _added(np.concatenate(self.buffer))
            self.buffer, self.n = [rows], len(rows)
            if self.n > self.held // 2:
                uri = f"{self.folder}/{uuid.uuid4().hex}"
                with _files.create(uri) as out:
                    out.write(rows.tobytes())
                self.spilled.append(uri)
                self.buffer, self.n = [], 0

    def next_level(self) -> None:
        none = np.zeros((0, 5), np.int64)
        self.runs = [Run(_added(np.concatenate(self.buffer)) if self.buffer else none), *(Run(none, uri) for uri in self.spilled)]
        self.spilled, self.buffer, self.n = [], [], 0

    def upto(self, k1: int, k2: int) -> np.ndarray:
        return np.concatenate([np.zeros((0, 5), np.int64), *(m for run in self.runs for m in run.upto(k1, k2))])


def _forward(nodes: DataFrame, shard: list, held: int) -> DataFrame:
    """Nodes with n_children, n_leaves and saved_tokens of their subtrees. Shards are dealt over tasks; all nodes of a task are
    one forest in reverse level order. A top node sends no message: what it has is for the shard of its parent."""
    keep = ["conv_id", "n_convs", *NODE, "up1", "up2"]
    folder = f"{T.shared_dir(nodes.sparkSession)}/queues"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queue, level = Queue(folder, held), None
        for whole in batches:
            depths = _longs(whole, "depth")[0]
            cut = np.flatnonzero(np.append(True, depths[1:] != depths[:-1])) if len(depths) else np.zeros(0, np.int64)
            for a, b in zip(cut, np.append(cut[1:], len(depths))):
                batch = whole.slice(a, b - a)
                if depths[a] != level:
                    queue.next_level()
                    level = depths[a]
                k1, k2, up1, up2, own = _longs(batch, "k1", "k2", "up1", "up2", "own")
                sums = np.stack(_longs(batch, "n_children", "n_leaves", "saved_tokens"), axis=1)
                sent = queue.upto(int(k1[-1]), int(k2[-1]))
                if len(sent):
                    one, two = np.append(k1, sent[:, 0]), np.append(k2, sent[:, 1])
                    order = np.lexsort((two, one))
                    key = np.empty(len(order), np.int64)
                    key[order] = np.cumsum(np.append(False, (one[order][1:] != one[order][:-1]) | (two[order][1:] != two[order][:-1])))
                    total = np.zeros((len(order), 3), np.int64)
                    np.add.at(total, key[len(k1) :], sent[:, 2:])
                    sums += total[key[: len(k1)]]
                sums[:, 1] = np.where(sums[:, 0] == 0, 1, sums[:, 1])
                sums[:, 2] += own
                inner = ~batch.column("top").to_numpy(zero_copy_only=False).astype(bool)
                queue.push(np.column_stack([up1[inner], up2[inner], np.ones(int(inner.sum()), np.int64), sums[inner, 1:]]))
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in [*keep, "top"]), *map(pa.array, sums.T)], names=[*keep, "top", "n_children", "n_leaves", "saved_tokens"])

    order = [F.desc("depth"), "k1", "k2"]
    dealt = nodes.repartition(_parts(nodes.sparkSession), *shard).sortWithinPartitions(*order)
    return dealt.select(*keep, "own", "top", "n_children", "n_leaves", "saved_tokens").mapInArrow(run, "".join(f"{c} long, " for c in keep) + "top boolean, n_children long, n_leaves long, saved_tokens long")


def _messages(done: DataFrame) -> DataFrame:
    """What the tops of finished shards give to their parents."""
    sums = [F.count("*").alias("n_children"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens")]
    key = [(F.col("depth") - 1).alias("depth"), F.col("up1").alias("k1"), F.col("up2").alias("k2")]
    return done.where("top AND depth > 0").groupBy(*key).agg(*sums)


def _totals(rows: DataFrame, nodes: DataFrame, limit: int, levels: int, held: int) -> DataFrame:
    large = nodes.where(F.col("below") > limit)
    none = [F.lit(0).cast("long").alias(c) for c in ("n_children", "n_leaves", "saved_tokens")]
    # the first node below the large ones is the top of a conversation's shard
    marked = rows.select("conv_id", *NODE).join(large.select(*NODE, F.lit(True).alias("large")), NODE, "left")
    shards = marked.groupBy("conv_id").agg(F.min(F.when(F.col("large").isNull(), F.struct(*NODE))).alias("shard"))
    small = nodes.where(F.col("below") <= limit).join(shards, "conv_id").withColumn("top", F.col("depth") == F.col("shard.depth")).select("*", *none)
    done = T.written(_forward(small, ["shard"], held), "shards")
    deepest = large.agg(F.max("depth")).first()[0]
    if deepest is None:
        return done
    tops = rows.where((F.col("depth") % levels == 0) & (F.col("depth") > 0)).select("conv_id", F.col("depth").alias("band"), F.struct("k1", "k2").alias("ancestor"))
    given, parts = [T.written(_messages(done), "given")], [done]
    for k in range(deepest // levels, -1, -1):
        band = large.where((F.col("depth") >= k * levels) & (F.col("depth") < (k + 1) * levels)).withColumn("top", F.col("depth") == k * levels)
        band = band.join(tops.where(F.col("band") == k * levels).drop("band"), "conv_id") if k else band.withColumn("ancestor", F.lit(None).cast("struct<k1:bigint,k2:bigint>"))
        sums = ["n_children", "n_leaves", "saved_tokens"]
        got = given[0] if len(given) == 1 else given[0].union(given[1])
        got = got.groupBy(*NODE).agg(*(F.sum(c).alias(c) for c in sums))
        band = band.join(got, NODE, "left").fillna(0, sums)
        parts.append(T.written(_forward(band, ["ancestor"], held), "band"))
        given = [given[0], _messages(parts[-1])]
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out


def _ends(plans: DataFrame) -> DataFrame:
    """(depth, k1, k2, ends_sha256): the digest of the ids that end at each node, streamed in their order."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        for batch in batches:
            conv, depth, k1, k2 = _longs(batch, "conv_id", *NODE)
            order = np.lexsort((np.arange(len(conv)), k2, k1, depth))
            key = np.stack([depth, k1, k2])[:, order]
            new = np.append(True, (key[:, 1:] != key[:, :-1]).any(0)) if len(conv) else np.zeros(0, bool)
            cut = np.flatnonzero(new)
            rows = [(s, e) for a, b in zip(cut, np.append(cut[1:], len(conv))) for s, e in ((s, min(s + PACK, b)) for s in range(a, b, PACK))]
            at = np.array([s for s, _ in rows], np.int64)
            ids = [",".join(map(str, conv[order[s:e]].tolist())) for s, e in rows]
            yield _batch(depth=key[0, at], k1=key[1, at], k2=key[2, at], part=np.full(len(at), part), number=number + np.arange(len(at)), ids=ids if ids else pa.array([], pa.string()))
            number += len(at)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sha = None, None
        for batch in batches:
            out = []
            for *key, ids in zip(*(batch.column(c).to_pylist() for c in [*NODE, "ids"])):
                if key != now:
                    if sha is not None:
                        out.append((*now, sha.hexdigest()))
                    now, sha = key, hashlib.sha256(ids.encode())
                else:
                    sha.update(b"," + ids.encode())
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=[*NODE, "ends_sha256"])
        if sha is not None:
            yield pa.RecordBatch.from_arrays([pa.array([c]) for c in (*now, sha.hexdigest())], names=[*NODE, "ends_sha256"])

    parts = _parts(plans.sparkSession)
    ends = plans.select("conv_id", F.col("size").alias("depth"), F.col("e1").alias("k1"), F.col("e2").alias("k2"))
    packed = ends.repartitionByRange(parts, "conv_id").sortWithinPartitions("conv_id").mapInArrow(pack, "depth long, k1 long, k2 long, part long, number long, ids string")
    return packed.repartition(parts, *NODE).sortWithinPartitions(*NODE, "part", "number").mapInArrow(digest, "depth long, k1 long, k2 long, ends_sha256 string")


def prefix_trie(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", limit: int = LIMIT, levels: int = LEVELS, held: int = HELD) -> DataFrame:
    """One row per node: its smallest member, depth, parent, members, children, leaves and saved bytes of its subtree, and the digest of the members that end there."""
    spark = conversations.sparkSession
    T.importable(spark)
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    m = F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary")))
    turns = conversations.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("conv_id"), F.col(turn_col).alias("turn"), m.alias("m"), F.octet_length(text).cast("long").alias("bytes"), F.monotonically_increasing_id().alias("row"))
    scan = T.written(_scan(turns), "scan")
    spans = T.written(scan.groupBy("conv_id", "part").agg((F.max("j") + 1).alias("n"), F.max_by("t1", "j").alias("t1"), F.max_by("t2", "j").alias("t2")), "spans")
    named = T.written(_named(scan, spans), "named")
    first = F.when(F.col("p") <= MOST, F.struct("p", "t1", "t2", "p1", "p2", "bytes"))
    heads = named.groupBy("conv_id").agg(F.max("p").alias("n"), F.max_by("t1", "p").alias("l1"), F.max_by("t2", "p").alias("l2"), F.array_sort(F.collect_list(first)).alias("head"))
    plans = T.written(_plans(T.written(heads, "heads")), "plans")
    rows = T.written(_rebuilt(named, spans, plans), "rebuilt")
    nodes = rows.groupBy(*NODE).agg(
        F.min("conv_id").alias("conv_id"),
        F.count("*").alias("n_convs"),
        F.max("up1").alias("up1"),
        F.max("up2").alias("up2"),
        ((F.count("*") - 1) * F.max("bytes")).alias("own"),
        F.sum(F.col("size") - F.col("depth") + 1).alias("below"),
    )
    nodes = T.written(nodes, "nodes")
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("up1"), F.col("k2").alias("up2"), F.col("conv_id").alias("parent_conv_id"))
    out = _totals(rows, nodes, limit, levels, held).join(parents, ["depth", "up1", "up2"], "left").join(_ends(plans), NODE, "left")
    numbers = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    return out.select(*numbers, F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"))


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def brute_force(rows: list[tuple]) -> list[tuple]:
    """The same nodes of (conv_id, turn, role, text) with dictionaries of whole prefixes, for tests."""
    import zlib

    turns: dict[int, list] = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            turns.setdefault(conv, []).append((turn is not None, turn or 0, hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).hexdigest(), role, text))
    turns = {c: [t[3:] for t in sorted(v)] for c, v in turns.items()}
    members: dict[tuple, list[int]] = {}
    ends: dict[tuple, list[int]] = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % (MOST + 1)
        whole = tuple(turns.get(c - (abs(c) % EVERY) * (1 if c >= 0 else -1), [])[:h] + own[h:])
        ends.setdefault(whole, []).append(c)
        for d in range(len(whole) + 1):
            members.setdefault(whole[:d], []).append(c)
    leaves, saved, children = ({k: 0 for k in members} for _ in range(3))
    for k in sorted(members, key=len, reverse=True):
        leaves[k] = leaves[k] or 1
        saved[k] += (len(members[k]) - 1) * len(k[-1][1].encode()) if k else 0
        if k:
            leaves[k[:-1]], saved[k[:-1]], children[k[:-1]] = leaves[k[:-1]] + leaves[k], saved[k[:-1]] + saved[k], children[k[:-1]] + 1
    digest = lambda k: hashlib.sha256(",".join(map(str, sorted(ends.get(k, [])))).encode()).hexdigest()
    return [(min(v), len(k), min(members[k[:-1]]) if k else None, len(v), children[k], leaves[k], saved[k], digest(k)) for k, v in members.items()]


ORACLE_SQL = r"""
WITH o AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(strlen(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, ''))) AS p
  FROM conversations WHERE conv_id IS NOT NULL),
n AS (SELECT conv_id, max(p) AS n FROM o GROUP BY 1),
bits AS (SELECT conv_id, n, flatten(list_transform(string_split(conv_id::VARCHAR, ''), lambda x: [ascii(x)::BIGINT, 0, 0, 0, 0, 0, 0, 0])) AS bits FROM n),
h AS (SELECT conv_id, n, xor(list_reduce(list_prepend(4294967295::BIGINT, bits), lambda a, x: xor(xor(a, x) // 2, 3988292384::BIGINT * (xor(a, x) % 2))), 4294967295::BIGINT) % 9 AS h FROM bits),
c AS (SELECT h.conv_id, h.h, h.conv_id - h.conv_id % 5 AS base, least(h.h, coalesce(b.n, 0)) AS m FROM h LEFT JOIN n b ON b.conv_id = h.conv_id - h.conv_id % 5),
r AS (SELECT c.conv_id, o.p AS d, role, text FROM c JOIN o ON o.conv_id = c.base AND o.p <= c.h
      UNION ALL SELECT c.conv_id, o.p - c.h + c.m, role, text FROM c JOIN o ON o.conv_id = c.conv_id AND o.p > c.h),
k AS (SELECT conv_id, d, strlen(text) AS bytes, list({'role': role, 'text': text}) OVER (PARTITION BY conv_id ORDER BY d) AS k FROM r
      UNION ALL SELECT conv_id, 0, 0, [] FROM n),
node AS (SELECT row_number() OVER () AS node, * FROM (SELECT k, d, min(conv_id) AS conv_id, count(*) AS n, max(bytes) AS bytes FROM k GROUP BY k, d)),
path AS (SELECT k.conv_id, k.d, node.node, node.conv_id AS least FROM k JOIN node ON node.d = k.d AND node.k = k.k),
tree AS (SELECT y.node, y.d, (y.n - 1) * y.bytes AS saved, x.node AS above, x.d AS d_above FROM node y JOIN path x ON x.conv_id = y.conv_id AND x.d <= y.d),
kids AS (SELECT above AS node, count(*) AS n FROM tree WHERE d_above = d - 1 GROUP BY 1),
sums AS (SELECT above AS node, count(*) FILTER (WHERE kids.n IS NULL) AS leaves, sum(saved) AS saved FROM tree LEFT JOIN kids ON kids.node = tree.node GROUP BY 1),
last AS (SELECT conv_id, max(d) AS d FROM k GROUP BY 1),
ends AS (SELECT path.node, string_agg(path.conv_id::VARCHAR, ',' ORDER BY path.conv_id) AS ids FROM path JOIN last ON last.conv_id = path.conv_id AND last.d = path.d GROUP BY 1)
SELECT node.conv_id, node.d::BIGINT AS depth, up.least AS parent_conv_id, node.n AS n_convs, coalesce(kids.n, 0) AS n_children, leaves AS n_leaves, saved::BIGINT AS saved_tokens,
  sha256(coalesce(ids, '')) AS ends_sha256
FROM node JOIN sums ON sums.node = node.node LEFT JOIN kids ON kids.node = node.node LEFT JOIN ends ON ends.node = node.node
LEFT JOIN path up ON up.conv_id = node.conv_id AND up.d = node.d - 1"""
