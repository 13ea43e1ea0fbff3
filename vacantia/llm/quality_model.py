"""Quality classifier by gated-attention multiple-instance learning.

A document is a bag of passages of ``PASSAGE`` bytes. Each passage is encoded twice: by word, line and character
statistics, and by its words, hashed into ``BUCKETS`` rows of a learned embedding whose mean over the passage's words
is its content vector. A small network maps both to a hidden vector h, the gate w . (tanh(V h) * sigmoid(U h))
gives each passage an attention weight (softmax inside the document), and the document's score is the
logistic of the weighted sum of its passages' vectors. All weights, the embedding's too, are learned together
from document labels, by Adam over batches of ``BATCH`` documents on the driver.

The fit reads at most ``SAMPLE`` labelled documents, half of each label at most, those with the smallest hash of
their id, and of those, in this order, each that still fits into ``SAMPLE_PASSAGES`` passages together; a document is taken with
all of its passages or not at all. Scoring takes every passage of every document in one pass without a shuffle.

Cases: a null or empty text is one empty passage; without labels of both kinds every score is the share
of label 1 (0.5 without any); a document with several labels counts with each, repeated rows count once; null
labels are left out; a document with more passages than its label may have together is no example; empty tables give empty results; other columns, whatever their names, are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vacantia.llm import _text as T

PASSAGE = 1500
SAMPLE = 8000
SAMPLE_PASSAGES = 30_000
HIDDEN, GATE = 16, 8
BUCKETS, CONTENT = 4096, 8
BATCH, STEPS = 128, 500

_TABLES = {
    "upper": T.byte_table((65, 90)),
    "lower": T.byte_table((97, 122)),
    "digit": T.byte_table((48, 57)),
    "space": T.byte_table((32, 32), (9, 13)),
    "newline": T.byte_table((10, 10)),
    "stop": T.byte_table((46, 46), (44, 44)),
    "loud": T.byte_table((33, 33), (63, 63)),
    "symbol": T.byte_table(*((ord(c), ord(c)) for c in "#*$%&|<>@^~={}[]\\_+/")),
    "quote": T.byte_table((34, 34), (39, 41), (58, 59)),
    "high": T.byte_table((128, 255)),
}
FEATURES = len(_TABLES) + 10


@dataclass
class Bags:
    """Passages: statistics, documents' first passages, word buckets with weights, passages' first words."""

    x: np.ndarray
    first: np.ndarray
    bucket: np.ndarray
    weight: np.ndarray
    word: np.ndarray

    def take(self, docs: np.ndarray) -> Bags:
        count = np.diff(self.first)[docs]
        rows = T.ranges(self.first[docs], count)
        size = np.diff(self.word)[rows]
        own = T.ranges(self.word[rows], size)
        return Bags(self.x[rows], np.append(0, np.cumsum(count)), self.bucket[own], self.weight[own], np.append(0, np.cumsum(size)))


def encode_passages(texts: pa.Array) -> Bags:
    """The passages of each document."""
    data, offsets = T.utf8(texts)
    rows = len(offsets) - 1
    count = np.maximum(-(-np.diff(offsets) // PASSAGE), 1)
    first = np.concatenate([[0], np.cumsum(count)])
    row = np.repeat(np.arange(rows), count)
    begin = offsets[:-1][row] + PASSAGE * T.ranges(np.zeros(rows, np.int64), count)
    end = np.minimum(begin + PASSAGE, offsets[1:][row])
    bounds = np.append(begin, len(data))
    size = np.maximum(end - begin, 1).astype(float)
    out = [T.per_row(t[data], bounds) / size for t in _TABLES.values()]
    starts, ends, _ = T.spans(T.NOT_SPACE[data], offsets)
    h = T.span_hashes(T.prefix_sums(T.FOLDED_VALUES[data]), starts, ends)
    at = np.searchsorted(starts, bounds)
    words = np.diff(at)
    n = np.maximum(words, 1).astype(float)
    owner = np.repeat(np.arange(len(begin)), words)
    long = (ends - starts).astype(float)
    mean = np.bincount(owner, long, len(begin)) / n
    spread = np.sqrt(np.maximum(np.bincount(owner, long**2, len(begin)) / n - mean**2, 0))

    def distinct(key: np.ndarray, of: np.ndarray) -> np.ndarray:
        _, one = np.unique(T.mix(key + of.astype(T.U64) * T.U64(0xA24BAED4963EE407)), return_index=True)
        return np.bincount(of[one], minlength=len(begin))

    grams, _, owners = T.word_grams(h, at, 3)
    pairs = np.maximum(words - 2, 1).astype(float)
    seen = np.zeros(len(data) + 1, np.int64)
    np.cumsum(T.ASCII_OR_HIGH_LETTERS[data], out=seen[1:])
    lettered = np.bincount(owner, seen[ends] > seen[starts], len(begin)) / n
    out += [
        np.minimum(mean, 40) / 10, np.minimum(spread, 40) / 10, np.log1p(words) / 5, distinct(h, owner) / n,
        np.where(words > 2, distinct(grams, owners) / pairs, 1.0), lettered, np.log1p(size) / 8,
        np.log1p(np.diff(offsets)[row]) / 10, np.bincount(owner, long > 20, len(begin)) / n, (words == 0).astype(float),
    ]
    return Bags(np.stack(out, axis=1), first, (h >> T.U64(52)).astype(np.int64), 1 / n[owner], at)


class Model:
    """The network's weights and the scaling of its inputs."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, rate: float, seed: int = 7):
        r = np.random.default_rng(seed)
        self.mean, self.scale, self.rate = mean, scale, rate
        self.fitted = False
        self.p = {
            "E": r.normal(0, 0.3, (BUCKETS, CONTENT)), "W": r.normal(0, 1 / np.sqrt(FEATURES), (FEATURES + CONTENT, HIDDEN)), "b": np.zeros(HIDDEN), "V": r.normal(0, 0.3, (HIDDEN, GATE)), "U": r.normal(0, 0.3, (HIDDEN, GATE)),
            "w": r.normal(0, 0.3, GATE), "c": r.normal(0, 0.3, HIDDEN), "d": np.zeros(1),
        }

    def content(self, bags: Bags, block: int = 256) -> np.ndarray:
        """Weighted sums of the words' embeddings in each passage, so many passages at a time."""
        out = np.zeros((len(bags.x), CONTENT))
        for at in range(0, len(out), block):
            word = bags.word[at : at + block + 1]
            sums = np.zeros((word[-1] - word[0] + 1, CONTENT))
            np.cumsum(self.p["E"][bags.bucket[word[0] : word[-1]]] * bags.weight[word[0] : word[-1], None], axis=0, out=sums[1:])
            out[at : at + block] = sums[word[1:] - word[0]] - sums[word[:-1] - word[0]]
        return out

    def forward(self, bags: Bags) -> dict[str, np.ndarray]:
        p, first = self.p, bags.first
        bag = np.repeat(np.arange(len(first) - 1), np.diff(first))
        x = np.concatenate([(bags.x - self.mean) / self.scale, self.content(bags)], axis=1)
        h = np.tanh(x @ p["W"] + p["b"])
        t, g = np.tanh(h @ p["V"]), 1 / (1 + np.exp(-(h @ p["U"])))
        a = (t * g) @ p["w"]
        a = np.exp(a - np.maximum.reduceat(a, first[:-1])[bag])
        a = a / np.add.reduceat(a, first[:-1])[bag]
        z = np.add.reduceat(a[:, None] * h, first[:-1])
        score = 1 / (1 + np.exp(-np.clip(z @ p["c"] + p["d"], -30, 30)))
        return {"x": x, "h": h, "t": t, "g": g, "a": a, "z": z, "score": score, "bag": bag}

    def gradients(self, bags: Bags, y: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
        p, f, first = self.p, self.forward(bags), bags.first
        x, h, t, g, a, bag = f["x"], f["h"], f["t"], f["g"], f["a"], f["bag"]
        e = (f["score"] - y) * weight / weight.sum()
        dz = e[:, None] * p["c"]
        da = (h * dz[bag]).sum(1)
        ds = a * (da - np.add.reduceat(a * da, first[:-1])[bag])
        dt, dg = ds[:, None] * p["w"] * g * (1 - t**2), ds[:, None] * p["w"] * t * g * (1 - g)
        dh = (a[:, None] * dz[bag] + dt @ p["V"].T + dg @ p["U"].T) * (1 - h**2)
        dx = (dh @ p["W"].T)[np.repeat(np.arange(len(x)), np.diff(bags.word)), FEATURES:] * bags.weight[:, None]
        embedding = np.stack([np.bincount(bags.bucket, dx[:, k], BUCKETS) for k in range(CONTENT)], axis=1)
        return {"E": embedding, "W": x.T @ dh, "b": dh.sum(0), "V": h.T @ dt, "U": h.T @ dg, "w": (t * g).T @ ds, "c": f["z"].T @ e, "d": np.array([e.sum()])}

    def fit(self, bags: Bags, y: np.ndarray, steps: int = STEPS, rate: float = 0.02, seed: int = 3) -> None:
        positive, r = y.mean(), np.random.default_rng(seed)
        weight = np.where(y == 1, 0.5 / positive, 0.5 / (1 - positive))
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(u) for k, u in self.p.items()}
        queue = np.zeros(0, np.int64)
        for step in range(1, steps + 1):
            if not len(queue):
                queue = r.permutation(len(y))
            docs, queue = queue[:BATCH], queue[BATCH:]
            now = rate * min(1.0, 2 * (1 - step / (steps + 1)))  # falling over the second half
            for k, d in self.gradients(bags.take(docs), y[docs], weight[docs]).items():
                d = d + 1e-4 * self.p[k]
                m[k], v[k] = 0.9 * m[k] + 0.1 * d, 0.999 * v[k] + 0.001 * d * d
                self.p[k] = self.p[k] - now * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
        self.fitted = True

    def score(self, bags: Bags) -> np.ndarray:
        if not self.fitted:
            return np.full(len(bags.first) - 1, self.rate)
        return self.forward(bags)["score"]


def held_out(doc_id: str = "doc_id"):
    """The rows that never teach: crc32 of the id as text, mod 3, is 1."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample: int = SAMPLE, passages: int = SAMPLE_PASSAGES) -> Model:
    """Learns from at most ``sample`` labelled documents with at most ``passages`` passages, none of them held out."""
    T.importable(docs.sparkSession)
    known = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("y")).where(F.col("y").isin(0, 1) & F.col("doc_id").isNotNull())
    known = known.where(~held_out())
    # a bounded number of rows, so the join below may send them to every task
    picked = reduce(DataFrame.unionByName, [known.where(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample // 2) for y in (0, 1)])

    spark = docs.sparkSession
    key = [F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("t")]
    labelled = docs.select(*key, F.octet_length(text_col).alias("size")).join(F.broadcast(picked), "doc_id").distinct()
    chosen = []
    for label in (0, 1):
        left = passages // 2
        for row in labelled.where(F.col("y") == label).orderBy(F.xxhash64("doc_id"), "doc_id", "t").limit(sample // 2).collect():
            # one that doesn't fit is passed over
            size = max(1, -(-(row.size or 0) // PASSAGE))
            if size > left:
                continue
            left -= size
            chosen.append((row.doc_id, row.t, label))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in T.pieces(batch):
                bags = encode_passages(piece.column("text"))
                for k, (low, high) in enumerate(zip(bags.first[:-1], bags.first[1:])):
                    begin = bags.word[low : high + 1] - bags.word[low]
                    columns = (bags.x[low:high].astype("<f4"), bags.bucket[bags.word[low] : bags.word[high]].astype("<u2"), begin.astype("<u4"))
                    yield pa.RecordBatch.from_arrays([*(piece.column(c).slice(k, 1) for c in ("doc_id", "t", "y")), *(pa.array([c.tobytes()], pa.binary()) for c in columns)], names=["doc_id", "t", "y", "x", "bucket", "word"])

    few = spark.createDataFrame(chosen, "doc_id long, t long, y int")
    rows = docs.select(*key, F.col(text_col).alias("text")).join(F.broadcast(few), ["doc_id", "t"])
    rows = rows.mapInArrow(run, "doc_id long, t long, y int, x binary, bucket binary, word binary").dropDuplicates(["doc_id", "t", "y"])
    # one order whatever the tasks' order was
    table = rows.orderBy("y", F.xxhash64("doc_id"), "doc_id", "t").toArrow()
    y = table.column("y").to_numpy().astype(float)
    if not len(y) or y.min() == y.max():
        return Model(np.zeros(FEATURES), np.ones(FEATURES), float(y.mean()) if len(y) else 0.5)
    x, bucket, word = ([np.frombuffer(b, kind) for b in table.column(c).to_pylist()] for c, kind in (("x", "<f4"), ("bucket", "<u2"), ("word", "<u4")))
    first = np.append(0, np.cumsum([len(w) - 1 for w in word]))
    size = np.concatenate([np.diff(w.astype(np.int64)) for w in word])
    n = np.maximum(size, 1).astype(float)
    bags = Bags(np.concatenate(x).reshape(-1, FEATURES).astype(float), first, np.concatenate(bucket).astype(np.int32), np.repeat((1 / n).astype(np.float32), size), np.append(0, np.cumsum(size)))
    model = Model(bags.x.mean(0), np.maximum(bags.x.std(0), 1e-3), float(y.mean()))
    model.fit(bags, y)
    return model


def score_quality(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    T.importable(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in T.pieces(batch):
                score = sent.value.score(encode_passages(piece.column("text")))
                yield pa.RecordBatch.from_arrays([piece.column("doc_id"), piece.column("held_out"), pa.array(score), pa.array((score >= 0.5).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out(id_col).alias("held_out"), F.col(text_col).alias("text")).mapInArrow(
        run, "doc_id long, held_out boolean, score double, predicted int"
    )


def op3_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return score_quality(docs, fit_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
