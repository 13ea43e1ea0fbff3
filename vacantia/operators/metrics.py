"""Report metrics: distributions, concentration, ratios, skills, pay, fill time, audits.

Percentages are half-even of (count / known) * 100; unknown values are null, 'unknown' and 'null'; ties go
to the larger count and then the smaller key. Operators take frames and column names; those with ranks or sketches
write their counts once and the others stay lazy.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vacantia.operators import order_statistics
from vacantia.storage import written

UNKNOWN = ("unknown", "null")


def is_known(column: str) -> Column:
    return F.col(column).isNotNull() & ~F.col(column).isin(*UNKNOWN)


def percent(part: Column, whole: Column) -> Column:
    """Half-even percentage, null of nothing."""
    return F.when(whole > 0, F.bround(part / whole * 100)).cast("int")


def distribution(df: DataFrame, column: str, by: list[str] | None = None) -> DataFrame:
    """Count and percentage of each known value; total, known, unknown and coverage on every row."""
    by = by or []
    counts = df.groupBy(*by, F.when(is_known(column), F.col(column)).alias("code")).agg(F.count("*").alias("n"))
    total, known = F.sum("n"), F.sum(F.when(F.col("code").isNotNull(), F.col("n")))
    if by:
        whole = Window.partitionBy(*by)  # over one row per value, not per posting
        counts = counts.withColumn("total", total.over(whole)).withColumn("known", F.coalesce(known.over(whole), F.lit(0)))
    else:  # totals are one row
        counts = counts.crossJoin(F.broadcast(counts.agg(total.alias("total"), F.coalesce(known, F.lit(0)).alias("known"))))
    return counts.where("code IS NOT NULL").select(
        *by, "code", "n", percent(F.col("n"), F.col("known")).alias("pct"), "total", "known", (F.col("total") - F.col("known")).alias("unknown"), percent(F.col("known"), F.col("total")).alias("coverage_pct")
    )


def value_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """Counts of every value of several columns, nulls too, with the number of distinct values and the mode."""
    pairs = F.explode(F.array(*(F.struct(F.lit(c).alias("dimension"), F.col(c).cast("string").alias("value")) for c in columns)))
    counts = df.select(pairs.alias("p")).groupBy("p.dimension", "p.value").agg(F.count("*").alias("n"))
    # one row for each dimension: the mode is the most frequent known value, the smallest of equals
    first = F.min(F.struct(F.col("value").isNull(), -F.col("n"), "value").alias("m"))["value"]
    whole = counts.groupBy("dimension").agg(F.sum("n").alias("total"), F.count("value").alias("n_values"), first.alias("mode"))
    return counts.join(whole, "dimension").select("dimension", "value", "n", "total", "n_values", F.col("value").eqNullSafe(F.col("mode")).alias("is_mode"))


def top_k(df: DataFrame, column: str, k: int, by: list[str] | None = None) -> DataFrame:
    """The k most frequent values, overall or per group, with their share of all rows in percent."""
    by = by or []
    counts = df.groupBy(*by, column).agg(F.count("*").alias("n"))
    if not by:  # totals are one row, and the window is over k rows
        best = counts.orderBy(F.desc("n"), column).limit(k).withColumn("rank", F.row_number().over(Window.orderBy(F.desc("n"), column)))
        return best.crossJoin(F.broadcast(counts.agg(F.sum("n").alias("total")))).select(column, "n", percent(F.col("n"), F.col("total")).alias("pct"), "rank")
    whole = Window.partitionBy(*by)
    ranked = counts.withColumn("total", F.sum("n").over(whole)).withColumn("rank", F.row_number().over(whole.orderBy(F.desc("n"), column)))
    return ranked.where(F.col("rank") <= k).select(*by, column, "n", percent(F.col("n"), F.col("total")).alias("pct"), "rank")


def merge_names(df: DataFrame, column: str, aliases: DataFrame) -> DataFrame:
    """Names replaced by their canonical ones; ``aliases`` has (alias, canonical), one row per alias."""
    names = aliases.select(F.col("alias").alias(column), "canonical")
    return df.join(names, column, "left").withColumn(column, F.coalesce("canonical", column)).drop("canonical")


def employer_metrics(df: DataFrame, column: str = "employer_name", top: int = 15) -> DataFrame:
    """The top employers with counts and shares, and on each row the number of employers and jobs per employer."""
    counts = df.groupBy(column).agg(F.count("*").alias("n"))
    totals = counts.agg(F.sum("n").alias("jobs"), F.count("*").alias("employers"))
    best = counts.orderBy(F.desc("n"), column).limit(top)
    rank = F.row_number().over(Window.orderBy(F.desc("n"), column))  # over at most ``top`` rows
    # totals are one row
    return best.crossJoin(F.broadcast(totals)).select(
        column, "n", percent(F.col("n"), F.col("jobs")).alias("pct"), rank.alias("rank"), "employers", F.bround(F.col("jobs") / F.col("employers"), 2).alias("jobs_per_employer")
    )


def concentration(df: DataFrame, column: str = "employer_name", tops: tuple[int, ...] = (5, 15)) -> DataFrame:
    """Share of all rows that the largest groups hold."""
    counts = df.groupBy(column).agg(F.count("*").alias("n"))
    best = counts.orderBy(F.desc("n"), column).limit(max(tops)).withColumn("rank", F.row_number().over(Window.orderBy(F.desc("n"), column)))
    sums = best.agg(*(F.coalesce(F.sum(F.when(F.col("rank") <= k, F.col("n"))), F.lit(0)).alias(f"top{k}") for k in tops))
    return sums.crossJoin(F.broadcast(counts.agg(F.sum("n").alias("jobs")))).select(*(percent(F.col(f"top{k}"), F.col("jobs")).alias(f"top{k}_pct") for k in tops), "jobs")


def seniority_metrics(df: DataFrame, column: str = "seniority", senior: tuple = ("senior", "staff_principal", "director_plus"), junior: tuple = ("junior",), entry: tuple = ("junior", "mid")) -> DataFrame:
    """Senior-to-junior ratio (null without juniors) and the entry-level rate among known."""
    n = lambda values: F.sum(F.when(F.col(column).isin(*values), 1).otherwise(0))
    sums = df.agg(n(senior).alias("senior"), n(junior).alias("junior"), n(entry).alias("entry"), F.sum(is_known(column).cast("int")).alias("known"))
    return sums.select("senior", "junior", "known", F.when(F.col("junior") > 0, F.bround(F.col("senior") / F.col("junior"), 1)).alias("senior_to_junior"), percent(F.col("entry"), F.col("known")).alias("entry_pct"))


def top_skills(df: DataFrame, skills: str = "skills_all", k: int = 15) -> DataFrame:
    """Mentions of each skill (repeats in a posting count) over postings with skills."""
    whole = df.where(F.size(skills) > 0)
    counts = whole.select(F.explode(skills).alias("skill")).groupBy("skill").agg(F.count("*").alias("n"))
    best = counts.orderBy(F.desc("n"), "skill").limit(k)
    return best.crossJoin(F.broadcast(whole.agg(F.count("*").alias("with_skills")))).select("skill", "n", percent(F.col("n"), F.col("with_skills")).alias("pct"))


def skill_pairs(df: DataFrame, skills: str = "skills", k: int | None = 10, anchor: str | None = None, by: list[str] | None = None, parts: int | None = None) -> DataFrame:
    """Unordered pairs of distinct skills and the postings that have both, overall or per group.

    The pairs of one posting come from its own array, row by row, so no two rows are joined. Where groups are many and small, so that
    counts are about as many as pairs, ``parts`` deals the pairs into so many partitions before they are counted."""
    by = by or []
    own = F.array_sort(F.array_distinct(skills))
    rows = df.select(*by, own.alias("s")).where(F.size("s") > 1)
    first = rows.select(*by, F.posexplode("s").alias("i", "a"), "s")
    pairs = first.select(*by, "a", F.explode(F.slice("s", F.col("i") + 2, F.greatest(F.size("s") - F.col("i") - 1, F.lit(0)))).alias("b"))
    if anchor:
        pairs = pairs.where((F.col("a") == anchor) | (F.col("b") == anchor))
    pairs = pairs.repartition(parts, *by, "a", "b") if parts else pairs
    counts = pairs.groupBy(*by, "a", "b").agg(F.count("*").alias("n"))
    return counts.orderBy(F.desc("n"), *by, "a", "b").limit(k) if k else counts


def frequent_pairs(df: DataFrame, skills: str = "skills", k: int = 10, tracked: int = 16_384) -> DataFrame:
    """The k most frequent unordered pairs of distinct skills (a, b, n), exactly, when there are too many pairs to count them all.

    Every task keeps a frequent-items sketch, and the merged one names at most ``tracked`` pairs; what it leaves out occurs at
    most 2 * 3.5 / (its size) times as often as there are pairs together. A second pass counts the named pairs only. If the k-th of them isn't
    above that bound, a sketch of eight times the size is tried, and past Spark's largest one all pairs are counted."""
    spark = df.sparkSession
    own = F.array_sort(F.array_distinct(skills))
    rows = df.select(own.alias("s")).where(F.size("s") > 1).select(F.posexplode("s").alias("i", "a"), "s")
    rows = rows.select(F.explode(F.transform(F.slice("s", F.col("i") + 2, F.greatest(F.size("s") - F.col("i") - 1, F.lit(0))), lambda b: F.to_json(F.array("a", b)))).alias("pair"))
    while tracked <= 1_000_000:
        row = rows.agg(F.count("*").alias("n"), F.expr(f"approx_top_k(pair, {tracked}, {tracked})").alias("top")).first()
        named = row.top or []
        size = 2 ** math.ceil(math.log2(tracked / 0.75))
        missed = max(7 * row.n / size, named[-1]["count"] if len(named) == tracked else 0)
        # at most ``tracked`` names
        names = F.broadcast(spark.createDataFrame([(r["item"],) for r in named], "pair string"))
        counts = written(rows.join(names, "pair").groupBy("pair").agg(F.count("*").alias("n")))
        pair = F.from_json("pair", "array<string>")
        best = counts.select(pair[0].alias("a"), pair[1].alias("b"), "n").orderBy(F.desc("n"), "a", "b").limit(k)
        first = [r.n for r in best.select("n").collect()]
        if len(first) == k and first[-1] > missed or (counts.agg(F.sum("n")).first()[0] or 0) == row.n:  # or every pair was named
            return best
        tracked *= 8
    return skill_pairs(df, skills, k)


def nearest_rank(df: DataFrame, value: str, by: list[str] | None = None, least: int = 1, points: tuple[tuple[str, float], ...] = order_statistics.QUARTILES) -> DataFrame:
    """Percentiles by floor nearest rank, the element at index int(n * p), for groups of ``least`` rows, by selection over ranges of distinct values."""
    by = by or []
    return order_statistics.at_ranks(order_statistics.count_values(df, value, by), by, value, points, least=least)


def compensation(df: DataFrame, value: str = "salary_midpoint", by: list[str] | None = None, least: int = 20) -> DataFrame:
    """Quartiles of pay and their distance, for groups of at least ``least`` postings."""
    return nearest_rank(df, value, by, least).withColumn("iqr", F.col("p75") - F.col("p25"))


def fill_time(df: DataFrame, by: list[str], posted: str = "posted_date", closed: str = "url_checked_at", status: str = "url_status", gone: tuple = ("404", "soft_404"), most_days: int = 365, least: int = 3) -> DataFrame:
    """Median days from posting to closing of closed postings, for groups of at least ``least``."""
    days = F.datediff(F.col(closed), F.col(posted))
    rows = df.where(F.col(status).isin(*gone)).withColumn("days", days).where((F.col("days") > 0) & (F.col("days") < most_days))
    return rows.groupBy(*by).agg(F.percentile("days", 0.5).alias("median_days"), F.count("*").alias("n")).where(F.col("n") >= least)


def confident_mode(df: DataFrame, key: str, value: str, share: float = 0.7, least: int = 3) -> DataFrame:
    """The modal known value of each key where at least ``least`` rows give it at least ``share``."""
    counts = df.where(is_known(value)).groupBy(key, value).agg(F.count("*").alias("n"))
    own = Window.partitionBy(key)
    ranked = counts.withColumn("total", F.sum("n").over(own)).withColumn("rank", F.row_number().over(own.orderBy(F.desc("n"), value)))
    return ranked.where((F.col("rank") == 1) & (F.col("total") >= least) & (F.col("n") / F.col("total") >= share)).select(key, value, "n", "total")


def cross_tab(df: DataFrame, a: str, b: str) -> DataFrame:
    """Counts of pairs with margins; a margin has 'All'."""
    name = lambda c: F.when(F.grouping(c) == 1, "All").otherwise(F.coalesce(c, F.lit("none"))).alias(c)
    return df.cube(a, b).agg(F.count("*").alias("n"), F.grouping(a).alias("_a"), F.grouping(b).alias("_b")).select(
        F.when(F.col("_a") == 1, "All").otherwise(F.coalesce(a, F.lit("none"))).alias(a), F.when(F.col("_b") == 1, "All").otherwise(F.coalesce(b, F.lit("none"))).alias(b), "n"
    )


def grouping_sets_counts(df: DataFrame, sets: list[str]) -> DataFrame:
    """Counts by each column apart, and in all."""
    rows = F.explode(F.array(F.struct(F.lit("total").alias("dimension"), F.lit("all").alias("value")), *(F.struct(F.lit(c).alias("dimension"), F.coalesce(F.col(c).cast("string"), F.lit("none")).alias("value")) for c in sets)))
    return df.select(rows.alias("r")).groupBy("r.dimension", "r.value").agg(F.count("*").alias("n"))


def age_buckets(df: DataFrame, by: str, last: str, as_of: Column, edges: tuple[int, ...] = (3, 7)) -> DataFrame:
    """Rows per age of their last check: never, up to each edge in days, or older."""
    age = F.datediff(as_of, F.col(last))
    bucket = F.when(age.isNull(), "never")
    for e in edges:
        bucket = bucket.when(age <= e, f"<={e}")
    return df.groupBy(by, bucket.otherwise(f">{edges[-1]}").alias("bucket")).agg(F.count("*").alias("n"))


def period_compare(current: DataFrame, previous: DataFrame, key: str, value: str, least: float = 1.0) -> DataFrame:
    """Values of two periods side by side: change, and whether it is new, gone, up or down by ``least``."""
    both = current.select(key, F.col(value).alias("now")).join(previous.select(key, F.col(value).alias("before")), key, "full")
    change = F.coalesce("now", F.lit(0)) - F.coalesce("before", F.lit(0))
    kind = F.when(F.col("before").isNull(), "new").when(F.col("now").isNull(), "gone").when(change >= least, "up").when(change <= -least, "down").otherwise("same")
    return both.select(key, "now", "before", change.alias("change"), kind.alias("kind"))


def biggest_movers(compared: DataFrame, key: str) -> DataFrame:
    """The largest gain and the largest decline of period_compare."""
    moved = compared.where("kind IN ('up', 'down')")
    up = moved.where("change > 0").orderBy(F.desc("change"), key).limit(1).withColumn("what", F.lit("gainer"))
    down = moved.where("change < 0").orderBy("change", key).limit(1).withColumn("what", F.lit("decline"))
    return up.unionByName(down).select("what", key, "change")


def fill_rates(df: DataFrame, columns: list[str], by: list[str] | None = None) -> DataFrame:
    """Per column the rows with a value and in all."""
    by = by or []
    pairs = F.explode(F.array(*(F.struct(F.lit(c).alias("field"), F.col(c).isNotNull().cast("long").alias("filled")) for c in columns)))
    return df.select(*by, pairs.alias("p")).groupBy(*by, "p.field").agg(F.sum("p.filled").alias("filled"), F.count("*").alias("n"))


def accuracy(pairs: DataFrame, fields: dict[str, tuple[str, str]]) -> DataFrame:
    """Null-safe equality of gold and predicted columns, per field and of all fields of a row together."""
    hits = [F.col(g).eqNullSafe(F.col(p)) for g, p in fields.values()]
    every = hits[0]
    for h in hits[1:]:
        every = every & h
    rows = F.explode(F.array(*(F.struct(F.lit(f).alias("field"), h.alias("hit")) for f, h in zip(fields, hits)), F.struct(F.lit("all_fields").alias("field"), every.alias("hit"))))
    return pairs.select(rows.alias("r")).groupBy("r.field").agg(F.sum(F.col("r.hit").cast("long")).alias("right"), F.count("*").alias("n"))


def mismatches(pairs: DataFrame, gold: str, predicted: str, k: int = 3) -> DataFrame:
    """The most frequent wrong pairs."""
    wrong = pairs.where(~F.col(gold).eqNullSafe(F.col(predicted))).groupBy(gold, predicted).agg(F.count("*").alias("n"))
    return wrong.orderBy(F.desc("n"), F.col(gold).asc_nulls_last(), F.col(predicted).asc_nulls_last()).limit(k)


def set_agreement(pairs: DataFrame, a: str, b: str) -> DataFrame:
    """Mean Jaccard of two array columns; two empty sets agree."""
    union = F.size(F.array_union(a, b))
    j = F.when(union == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / union)
    return pairs.agg(F.sum(F.bround(j, 6).cast("decimal(18,6)")).alias("jaccard_sum"), F.count("*").alias("n"))


def running_totals(df: DataFrame, day: str, by: str) -> DataFrame:
    """Rows per day and group, and their running total."""
    return cumulated(df.groupBy(by, F.col(day).alias("day")).agg(F.count("*").alias("n")), by)


def cumulated(counts: DataFrame, by: str) -> DataFrame:
    """Counts (by, day, n) with their running total: a row for each group and day."""
    return counts.withColumn("cumulative", F.sum("n").over(Window.partitionBy(by).orderBy("day").rowsBetween(Window.unboundedPreceding, 0)))


def growth(df: DataFrame, by: list[str], day: str = "posted_date") -> DataFrame:
    """Rows per month and group, with the count of the month before in the data."""
    counts = df.groupBy(*by, F.trunc(day, "month").alias("month")).agg(F.count("*").alias("n"))
    return counts.withColumn("previous", F.lag("n").over(Window.partitionBy(*by).orderBy("month")))


def share_within(df: DataFrame, outer: str, inner: str) -> DataFrame:
    """Counts of pairs and their share of the outer group in percent."""
    counts = df.groupBy(outer, inner).agg(F.count("*").alias("n"))
    return counts.withColumn("pct", percent(F.col("n"), F.sum("n").over(Window.partitionBy(outer))))


def conditional_counts(df: DataFrame, by: list[str], conditions: dict[str, Column]) -> DataFrame:
    """Rows in all and under each condition."""
    return df.groupBy(*by).agg(F.count("*").alias("n"), *(F.sum(F.when(c, 1).otherwise(0)).alias(k) for k, c in conditions.items()))


def compare_segments(df: DataFrame, segment: str, value: str, least: int = 10) -> DataFrame:
    """Shares of a value in pairs of segments that differ by over 20 points or twofold."""
    shares = distribution(df, value, [segment]).where(F.col("total") >= least).select(segment, "code", "pct")
    other = shares.select(F.col(segment).alias("other"), "code", F.col("pct").alias("other_pct"))
    both = shares.join(other, "code").where(F.col(segment) < F.col("other"))
    apart = (F.abs(F.col("pct") - F.col("other_pct")) > 20) | (F.greatest("pct", "other_pct") > 2 * F.least("pct", "other_pct"))
    return both.where(apart).select("code", segment, "other", "pct", "other_pct")
