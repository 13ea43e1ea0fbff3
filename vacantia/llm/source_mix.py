"""Mixing sources to target weights by entropy balancing, in DataFrame functions only.

Each source has a target number of words. Of all document rates whose words add up to the target and that stay at or below
``CAP``, those that differ least (in relative entropy) from taking every document once are exp(lambda x), cut at the cap, where x is the
document's size in units of its source's typical size. lambda solves the convex dual, one number for each source: Newton steps
inside a bracket, each an aggregation over all sources at once. They run on the counts of documents by source and size, which
is all that rates depend on, and sums are exact decimals, so the order of rows and tasks changes nothing.

Rates become copies in three steps. Cells (source, size) from large to small share out their expected copies by rounding
running sums, which leaves at most half of the largest document over; that rest is paid out from a few cells of each power of two, from
large to small, again until nothing more can be paid, so that what stays is about half of the smallest document. In a cell all documents get the same number of copies, and
as many as needed, in order of a hash, one more.

Cases: a null or empty text has size 0, takes no words and is in no mix; a null source is a source of its own, the last one;
rows that share id, source and text are told by nothing and counted together, whatever their number, and each is a row of
the result; rows that share an id only are documents of their own, and so are rows without an id; equal hashes go by id; an empty table
gives no rows; other columns, whatever their names, are not looked at by ``allot`` and pass through ``mixed``; a text is counted whole.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vacantia.llm import _text as T

#: Copies of a document, at most, and words of a source in units of its size.
CAP = 3
#: Weights of sources in their order, repeating.
WEIGHTS = (1, 2, 3)
#: A source is done when its expected words are this close to its target, in millionths; rounding pays out the difference.
CLOSE = 1
#: Documents of one cell that are ordered together, about.
TOGETHER = 4096
#: Sizes of one block of a running sum.
BLOCK = 1024
#: Rows of repeated documents that are made at a time.
ROWS = 10_000


def word_count(text: Column) -> Column:
    """Words of ``[^\\x20\\x09-\\x0D]+``: each becomes one letter, and white space goes."""
    return F.length(F.translate(F.regexp_replace(F.coalesce(text, F.lit("")), r"[^\x20\x09-\x0D]+", "x"), " \t\n\x0b\x0c\r", "")).cast("long")


def _exact(c: Column) -> Column:
    return c.cast("decimal(38,6)")


def _entries(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """(source, size, doc_id, h, c): distinct documents and their rows; sources as text that sorts as they do, without nulls."""
    source = F.coalesce(F.concat(F.lit("s"), F.col(source_col).cast("string")), F.lit("t"))
    key = [source.alias("source"), word_count(F.col(text_col)).alias("size"), F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("h")]
    return docs.select(*key).groupBy("source", "size", "doc_id", "h").agg(F.count("*").alias("c"))


def _weighed(sizes: DataFrame, weights: tuple[int, ...]) -> DataFrame:
    """(source, words, weight): places in the order of sources by ranges and their counts."""
    spark = sizes.sparkSession
    ranged = sizes.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), "source").withColumn("part", F.spark_partition_id())
    ranged = T.written(ranged, "sources")
    before = ranged.groupBy("part").agg(F.count("*").alias("n"))
    before = before.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))  # a row for each range
    place = F.row_number().over(Window.partitionBy("part").orderBy("source")) + F.col("before") - 1
    weight = F.get(F.array(*map(F.lit, weights)), F.pmod(place, F.lit(len(weights))).cast("int"))
    return T.written(ranged.join(before, "part").select("source", "words", weight.cast("long").alias("weight")), "weighed")


def targets(weighed: DataFrame, cap: int = CAP) -> DataFrame:
    """Adds target: shares of all words by weight, where what is above cap times a source's words is shared again."""
    total = weighed.agg(F.sum("words")).first()[0] or 0
    level = 0.0
    fixed, rest = 0, int(weighed.agg(F.sum("weight")).first()[0] or 0)
    while rest:
        level = (total - fixed) / rest  # words for a weight of 1
        full = F.col("weight") * F.lit(level) > F.col("words") * cap
        row = weighed.agg(F.sum(F.when(full, F.col("words") * cap)).alias("fixed"), F.sum(F.when(~full, F.col("weight"))).alias("rest")).first()
        if int(row.rest or 0) == rest:  # no further source is full
            break
        fixed, rest = int(row.fixed or 0), int(row.rest or 0)
    return weighed.withColumn("target", F.least(F.col("weight") * F.lit(level), (F.col("words") * cap).cast("double")))


def rates(cells: DataFrame, aims: DataFrame, cap: int = CAP, close: int = CLOSE) -> DataFrame:
    """Cells (source, size, m) with the rate of their documents."""
    scale = cells.groupBy("source").agg(F.sum(F.col("m").cast("decimal(38,0)") * F.col("size") * F.col("size")).cast("double").alias("squares"))
    start = aims.join(scale, "source").withColumn("unit", F.col("squares") / F.col("words"))
    none = F.lit(None).cast("double")
    # all or nothing needs no dual
    easy = (F.col("target") <= 0) | (F.col("target") >= F.col("words") * cap)
    state = start.select("source", "words", "target", "unit", F.log(F.when(easy, F.lit(1.0)).otherwise(F.col("target") / F.col("words"))).alias("dual"), none.alias("low"), none.alias("high"), easy.alias("done"))
    state = T.written(state, "dual")
    x, term = F.col("size") / F.col("unit"), F.exp(F.col("dual") * F.col("size") / F.col("unit"))
    words = F.col("m") * F.col("size").cast("double")
    while state.where("NOT done").limit(1).count():
        sums = cells.join(state.where("NOT done").select("source", "unit", "dual"), "source").groupBy("source")
        sums = sums.agg(F.sum(_exact(words * F.least(term, F.lit(float(cap))))).cast("double").alias("f"), F.sum(_exact(F.when(term < cap, words * x * term).otherwise(0.0))).cast("double").alias("slope"))
        now = state.join(sums, "source", "left")
        below = F.col("f") < F.col("target")
        now = now.withColumn("low", F.when(below, F.col("dual")).otherwise(F.col("low"))).withColumn("high", F.when(below, F.col("high")).otherwise(F.col("dual")))
        newton = F.col("dual") - (F.col("f") - F.col("target")) / F.nullif("slope", F.lit(0.0))
        # towards a side without a bound, at most this far; between two bounds, halfway if Newton's step leaves them
        far = F.abs("dual") + 1
        step = F.coalesce(F.greatest(F.least(newton, F.col("dual") + far), F.col("dual") - far), F.when(below, F.col("dual") + far).otherwise(F.col("dual") - far))
        inside = F.when((step > F.col("low")) & (step < F.col("high")), step).otherwise((F.col("low") + F.col("high")) / 2)
        step = F.coalesce(F.when(F.col("low").isNotNull() & F.col("high").isNotNull(), inside), step)
        found = F.abs(F.col("f") - F.col("target")) * 10**6 <= F.col("target") * close
        spent = F.coalesce((step == F.col("low")) | (step == F.col("high")), F.lit(False))  # the bracket is down to two neighbours
        done = F.col("done") | found | spent
        state = T.written(now.select("source", "words", "target", "unit", F.when(done, F.col("dual")).otherwise(step).alias("dual"), "low", "high", done.alias("done")), "dual")
    rate = F.when(F.col("target") <= 0, 0.0).when(F.col("target") >= F.col("words") * cap, float(cap)).otherwise(F.least(term, F.lit(float(cap))))
    return cells.join(state, "source").select("source", "size", "m", "target", rate.alias("rate"))


def copies(rated: DataFrame, cap: int = CAP) -> DataFrame:
    """Cells (source, size, m) with k, the copies that their documents get together."""
    cells = rated.where("size > 0").withColumn("block", F.expr(f"size div {BLOCK}")).withColumn("e", (F.col("m") * F.col("rate")).cast("decimal(28,9)"))
    blocks = cells.groupBy("source", "block").agg(F.sum("e").alias("all"))
    blocks = blocks.select("source", "block", (F.sum("all").over(Window.partitionBy("source").orderBy(F.desc("block"))) - F.col("all")).alias("before"))
    upto = F.col("before") + F.sum("e").over(Window.partitionBy("source", "block").orderBy(F.desc("size")))
    half = F.lit("0.5").cast("decimal(2,1)")
    k = (F.floor(upto + half) - F.floor(upto - F.col("e") + half)).cast("long")
    cells = cells.join(blocks, ["source", "block"]).withColumn("k", k).select("source", "size", "m", "target", "k")
    # the rest, from large to small: in each power of two the cells with most room to add or to take away, one of each sixteenth
    room = F.col("m") * cap - F.col("k")
    step = F.struct(F.max_by("size", F.struct(room, "size")).alias("more"), F.max(room).alias("more_room"), F.max_by("size", F.struct("k", "size")).alias("less"), F.max("k").alias("less_room"))
    none = F.array().cast("array<struct<size:bigint,q:bigint>>")

    def pay(acc: Column, b: Column) -> Column:
        up = acc["rest"] > 0
        size = F.when(up, b["s"]["more"]).otherwise(b["s"]["less"])
        most = F.when(up, b["s"]["more_room"]).otherwise(b["s"]["less_room"])
        # half a size or less stays, so each payment brings the rest closer to zero
        q = F.least(F.ceil(F.abs(acc["rest"]) / size - 0.5).cast("long"), most) * F.when(up, 1).otherwise(-1)
        return F.struct((acc["rest"] - q * size).alias("rest"), F.when(q == 0, acc["out"]).otherwise(F.concat(acc["out"], F.array(F.struct(size.alias("size"), q.cast("long").alias("q"))))).alias("out"))

    while True:
        cells = T.written(cells, "copies")
        bands = cells.groupBy("source", F.floor(F.log2("size")).alias("band"), (F.col("size") % 16).alias("part")).agg(step.alias("s"), F.sum(F.col("k") * F.col("size")).alias("taken"), F.max("target").alias("target"))
        per = bands.groupBy("source").agg((F.max("target") - F.sum("taken")).alias("rest"), F.reverse(F.array_sort(F.collect_list(F.struct("band", "part", "s")))).alias("bands"))
        paid = per.select("source", F.explode(F.aggregate("bands", F.struct(F.col("rest").cast("double").alias("rest"), none.alias("out")), pay)["out"]).alias("p"))
        paid = T.written(paid.select("source", "p.size", "p.q"), "paid")
        if not paid.limit(1).count():
            return cells.select("source", "size", "m", "k")
        cells = cells.join(paid, ["source", "size"], "left").withColumn("k", F.col("k") + F.coalesce("q", F.lit(0))).drop("q")


def allot(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", cap: int = CAP, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """(source, doc_id, h, size, c, source_size, target, base, extra): of the c rows of a document, base copies each and extra more of them together."""
    entries = T.written(_entries(docs, id_col, text_col, source_col), "entries")
    cells = T.written(entries.groupBy("source", "size").agg(F.sum("c").alias("m")), "cells")
    sizes = cells.groupBy("source").agg(F.sum(F.col("size") * F.col("m")).alias("words"))
    aims = T.written(targets(_weighed(sizes, weights), cap), "targets")
    whole = cells.join(aims.select("source", F.col("words").alias("source_size"), "target"), "source")
    given = copies(rates(cells.where("size > 0"), aims.where("words > 0"), cap), cap)
    whole = whole.join(given.select("source", "size", "k"), ["source", "size"], "left").withColumn("k", F.coalesce("k", F.lit(0)))
    whole = T.written(whole.select("source", "size", "m", "source_size", "target", F.expr("k div m").alias("base"), (F.col("k") % F.col("m")).alias("more")), "allotted")
    # in a cell, one more for as many as needed: shared over buckets of documents by running sums, and in a bucket by order
    key = ["source", "size", "bucket"]
    hashed = F.xxhash64("doc_id", "h")
    rows = entries.join(whole, ["source", "size"]).withColumn("hashed", hashed).withColumn("bucket", F.pmod("hashed", F.ceil(F.col("m") / TOGETHER)))
    counts = rows.groupBy(*key).agg(F.sum("c").alias("n"), F.first("m").alias("m"), F.first("more").alias("more"))
    upto = F.sum("n").over(Window.partitionBy("source", "size").orderBy("bucket"))
    counts = counts.withColumn("upto", upto).select(*key, F.expr("(more * CAST(upto AS DECIMAL(20,0))) div m - (more * CAST(upto - n AS DECIMAL(20,0))) div m").alias("give"))
    before = F.sum("c").over(Window.partitionBy(*key).orderBy("hashed", "doc_id", "h")) - F.col("c")
    extra = F.greatest(F.lit(0), F.least(F.col("c"), F.col("give") - before))
    return rows.join(counts, key).select("source", "doc_id", "h", "size", "c", "source_size", "target", "base", extra.alias("extra"))


def _times(rows: DataFrame, n: Column) -> DataFrame:
    """Each row n times, in portions."""
    portions = rows.withColumn("__n", n).where("__n > 0").withColumn("__at", F.explode(F.expr(f"sequence(0, (__n - 1) div {ROWS})")))
    return portions.withColumn("__copy", F.explode(F.expr(f"sequence(1, least({ROWS}, __n - __at * {ROWS}))"))).drop("__n", "__at", "__copy")


def mix_report(docs: DataFrame, **columns) -> DataFrame:
    """One row per document row: doc_id, size, source_size, target of its source, and the words that the mix takes of it."""
    rows = allot(docs, **columns)
    kinds = F.array(F.struct((F.col("base") + 1).alias("copies"), F.col("extra").alias("n")), F.struct(F.col("base").alias("copies"), (F.col("c") - F.col("extra")).alias("n")))
    rows = rows.withColumn("kind", F.explode(F.filter(kinds, lambda k: k["n"] > 0)))
    return _times(rows, F.col("kind.n")).select("doc_id", "size", "source_size", "target", (F.col("kind.copies") * F.col("size")).alias("taken"))


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The mix itself: rows of docs, each as often as it is taken."""
    found = allot(docs, id_col, text_col, source_col, **options)
    key = ["__source", "__id", "__h", "__size"]
    taken = found.select(*(F.col(c).alias(k) for c, k in zip(("source", "doc_id", "h", "size"), key)), (F.col("base") * F.col("c") + F.col("extra")).alias("__taken")).where("__taken > 0")
    own = [F.coalesce(F.concat(F.lit("s"), F.col(source_col).cast("string")), F.lit("t")), F.col(id_col).cast("long"), F.xxhash64(text_col), word_count(F.col(text_col))]
    rows = docs.select("*", *(c.alias(k) for c, k in zip(own, key))).dropDuplicates(key)
    same = reduce(lambda a, b: a & b, (rows[k].eqNullSafe(taken[k]) for k in key))
    return _times(rows.join(taken, same).select(*(rows[c] for c in docs.columns), "__taken"), F.col("__taken")).select(*docs.columns)


def op13_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_report(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def brute_targets(sizes: dict[str | None, int], weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> dict[str | None, float]:
    """Targets by sharing the excess again and again, for tests."""
    from fractions import Fraction

    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    out, left, free = {}, Fraction(sum(sizes.values())), set(sizes)
    while True:
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if share[s] > cap * sizes[s]}
        if not over:
            return {**out, **{s: float(v) for s, v in share.items()}}
        for s in over:
            out[s] = float(cap * sizes[s])
            left -= cap * sizes[s]
        free -= over
        if not free:
            return out
