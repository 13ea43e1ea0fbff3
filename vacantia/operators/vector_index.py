"""Embedding search over an inverted-file index: cells around centroids, exact comparison inside the cells that a query looks at.

Centroids come from k-means over a bounded sample (at most ``SAMPLE`` vectors, those with the smallest hashes); every vector
is then put into the cell of its nearest centroid, and the index keeps each cell's angle, the largest between a member and its
centroid. A search looks at the ``probes`` nearest cells of each query; without probes it is exact: it leaves out only cells
in which, by the triangle inequality of angles, no vector can reach the least similarity. Either way the similarities that it
returns are exact, and filters on other columns apply before anything is compared.

Cells are cut into blocks of about ``BLOCK`` vectors by a row number that is written with the index, and the queries of a cell into
portions of about ``PORTION``, so a cell that holds a third of all vectors is many groups. A group gives its best k for each query.

Cases: rows without an id or a vector are left out, of vectors and of queries; a zero vector has similarity 0 to all; a query isn't
compared with the row that has its id; repeated rows each count; equal similarities go by id; empty frames give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from vacantia.storage import importable, written

#: Vectors that the centroids are fitted on, and cells, at most.
SAMPLE, CELLS = 32_768, 4_096
ROUNDS = 8
BLOCK, PORTION = 4_096, 16_384


@dataclass
class Index:
    """rows: (vec_id, embedding, other columns, cell, row); centroids are unit vectors; sizes and angles are those of the cells."""

    rows: DataFrame
    centroids: np.ndarray
    sizes: np.ndarray
    angles: np.ndarray


def _matrix(vectors: pa.Array) -> np.ndarray:
    """Unit vectors as rows of doubles."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    m = vectors.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(vectors), -1)
    return m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-30)


def fit_centroids(vectors: DataFrame, cells: int | None = None, sample: int = SAMPLE) -> np.ndarray:
    """Unit centroids of at most ``sample`` vectors; as many as the root of the number of vectors unless stated."""
    known = vectors.where("vec_id IS NOT NULL AND embedding IS NOT NULL")
    picked = known.select("vec_id", "embedding").orderBy(F.xxhash64("vec_id"), "vec_id", "embedding").limit(sample).toArrow()
    if not picked.num_rows:
        return np.zeros((0, 0))
    m = _matrix(picked.column("embedding"))
    k = min(cells or int(np.ceil(np.sqrt(known.count()))), CELLS, len(m))
    centroids = m[np.unique(np.linspace(0, len(m) - 1, k).astype(int))]
    for _ in range(ROUNDS):
        own = (m @ centroids.T).argmax(1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, own, m)
        norm = np.linalg.norm(sums, axis=1, keepdims=True)
        centroids = np.where(norm > 1e-12, sums / np.maximum(norm, 1e-30), centroids)
    return centroids


def build_index(vectors: DataFrame, cells: int | None = None, sample: int = SAMPLE) -> Index:
    """Every vector in its cell; other columns of the vectors stay, for filters."""
    spark = vectors.sparkSession
    importable(spark)
    centroids = fit_centroids(vectors, cells, sample)
    sent = spark.sparkContext.broadcast(centroids)  # at most CELLS vectors
    rows = vectors.where("vec_id IS NOT NULL AND embedding IS NOT NULL").withColumn("row", F.monotonically_increasing_id())
    names = rows.columns

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            similar = _matrix(batch.column("embedding")) @ sent.value.T
            cell = similar.argmax(1) if len(similar) else np.zeros(0, np.int64)
            angle = np.arccos(np.clip(similar[np.arange(len(cell)), cell], -1, 1))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell.astype(np.int32)), pa.array(angle)], names=[*names, "cell", "angle"])

    schema = StructType([*rows.schema.fields, StructField("cell", IntegerType()), StructField("angle", DoubleType())])
    rows = written(rows.mapInArrow(assign, schema))
    sizes, angles = np.zeros(len(centroids), np.int64), np.zeros(len(centroids))
    for r in rows.groupBy("cell").agg(F.count("*").alias("n"), F.max("angle").alias("angle")).collect():  # a row for each cell
        sizes[r.cell], angles[r.cell] = r.n, r.angle
    return Index(rows, centroids, sizes, angles)


def _looks(index: Index, queries: DataFrame, least: float, probes: int | None) -> DataFrame:
    """(query_id, q, cell): the cells that each query looks at."""
    sent = queries.sparkSession.sparkContext.broadcast((index.centroids, index.angles, index.sizes))

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centroids, angles, sizes = sent.value
        for batch in batches:
            similar = _matrix(batch.column("q")) @ centroids.T
            if probes:
                near = np.argsort(-np.where(sizes > 0, similar, -2), axis=1, kind="stable")[:, :probes]
                cells = list(near.astype(np.int32))
            else:
                most = np.cos(np.maximum(np.arccos(np.clip(similar, -1, 1)) - angles, 0))
                cells = [np.flatnonzero(row).astype(np.int32) for row in (most >= least - 1e-6) & (sizes > 0)]
            yield pa.RecordBatch.from_arrays([batch.column("query_id"), batch.column("q"), pa.array(cells, pa.list_(pa.int32()))], names=["query_id", "q", "cells"])

    q = queries.where("vec_id IS NOT NULL AND embedding IS NOT NULL").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("q"))
    kind = q.schema["q"].dataType.simpleString()
    return q.mapInArrow(choose, f"query_id long, q {kind}, cells array<int>").select("query_id", "q", F.explode("cells").alias("cell"))


def probes_for(index: Index, queries: DataFrame, least: float, k: int, recall: float = 0.9, sample: int = 256) -> int:
    """How many cells to look at for this recall: from the exact results of at most ``sample`` queries, those with the smallest hashes of their ids, by the
    place of each result's cell among the nearest cells of its query; a third of what may be missed is kept in hand."""
    some = written(queries.where("vec_id IS NOT NULL AND embedding IS NOT NULL").select("vec_id", "embedding").orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample))
    found = search(index, some, least, k).join(index.rows.select("vec_id", "cell"), "vec_id").join(some.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("q")), "query_id")
    table = found.select("cell", "q").toArrow()
    if not table.num_rows:
        return 1
    similar = np.where(index.sizes > 0, _matrix(table.column("q")) @ index.centroids.T, -2)
    own = similar[np.arange(len(similar)), table.column("cell").to_numpy()]
    place = np.sort((similar > own[:, None]).sum(1) + 1)
    return int(place[min(len(place) - 1, int(np.ceil(len(place) * (recall + (1 - recall) / 3))))])


def search(index: Index, queries: DataFrame, least: float, k: int, probes: int | None = None, where: Column | str | None = None) -> DataFrame:
    """query_id, vec_id, similarity, rank: for each query its k most similar vectors of at least ``least`` that satisfy ``where``."""
    spark = queries.sparkSession
    importable(spark)
    out = "query_id long, vec_id long, similarity double"
    if not len(index.centroids):
        return spark.createDataFrame([], out + ", rank int")
    looks = written(_looks(index, queries, least, probes))
    # a row for each cell: its blocks of vectors and portions of queries
    wanted = [(r.cell, max(1, int(-(-index.sizes[r.cell] // BLOCK))), -(-r["count"] // PORTION)) for r in looks.groupBy("cell").count().collect()]
    cells = F.broadcast(spark.createDataFrame(wanted, "cell int, blocks int, portions int"))
    rows = index.rows if where is None else index.rows.where(where)
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    vectors = rows.join(cells, "cell").select("cell", F.pmod("row", "blocks").cast("int").alias("block"), every("portions").alias("portion"), "vec_id", "embedding")
    asked = looks.join(cells, "cell").withColumn("portion", F.pmod(F.xxhash64("query_id"), F.col("portions")).cast("int"))
    asked = asked.select("cell", every("blocks").alias("block"), "portion", "query_id", "q")

    def best(vectors: pa.Table, asked: pa.Table) -> pa.Table:
        if not vectors.num_rows or not asked.num_rows:
            return pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "similarity": pa.array([], pa.float64())})
        ids, own = (t.column(c).to_numpy() for t, c in ((asked, "query_id"), (vectors, "vec_id")))
        m, w = _matrix(asked.column("q")), _matrix(vectors.column("embedding"))
        found = []
        for at in range(0, len(ids), 1024):
            similar = np.round(m[at : at + 1024] @ w.T, 6)
            i, j = np.nonzero((similar >= least) & (own[None, :] != ids[at : at + 1024, None]))
            s = similar[i, j]
            order = np.lexsort((own[j], -s, i))
            i, j, s = i[order], j[order], s[order]
            start = np.flatnonzero(np.append(True, i[1:] != i[:-1])) if len(i) else np.zeros(0, int)
            keep = np.arange(len(i)) - np.repeat(start, np.diff(np.append(start, len(i)))) < k
            found.append((ids[at + i[keep]], own[j[keep]], s[keep]))
        return pa.table(dict(zip(("query_id", "vec_id", "similarity"), (np.concatenate(c) for c in zip(*found)))))

    key = ["cell", "block", "portion"]
    pairs = vectors.groupBy(*key).cogroup(asked.groupBy(*key)).applyInArrow(best, out)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("similarity"), "vec_id"))
    return pairs.withColumn("rank", rank).where(F.col("rank") <= k)
