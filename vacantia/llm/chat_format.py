"""Chat formatting into a prefix tree.

Conversations that begin with the same turns share the nodes of those turns. The output is one stream
that has each node's characters once, depth first, with position ids (the place inside a conversation),
the loss mask (assistant texts), and for each node the stream intervals of its ancestors, which are all
that it may attend to besides itself. A conversation is its leaf: its ancestors' intervals and the leaf's
own give its characters back.

A node is a prefix of turns, named by its length and 128 bits of hash, a running XOR over the turns.
Depth-first order is the order of the distinct paths sorted as arrays; a node belongs to the first path
that has it. Offsets are prefix sums inside range partitions plus the partitions' sums, so no step gathers
a tree, however many conversations share a first turn.

Template: ``[INST]`` role ``[/INST]`` text ``</s>`` for each turn; inside roles and texts a backslash is
doubled and the three control strings get a backslash after their first character.

Cases: null roles and texts are empty; turns are ordered by (turn, role, text), nulls first, so repeated
turns stay; a null conv_id is one conversation; equal conversations share a leaf; an empty table gives
empty outputs; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vacantia.llm import _text as T

BEGIN, MIDDLE, END = "[INST]", "[/INST]", "</s>"


def escape(c: Column) -> Column:
    c = F.replace(c, F.lit("\\"), F.lit("\\\\"))
    for mark in (BEGIN, MIDDLE, END):
        c = F.replace(c, F.lit(mark), F.lit(mark[0] + "\\" + mark[1:]))
    return c


def unescape(c: Column) -> Column:
    return F.regexp_replace(c, r"(?s)\\(.)", "$1")


def _turns(conversations: DataFrame) -> DataFrame:
    """One row per turn: its place, node, formatted text and where that begins in the conversation."""
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("depth", F.row_number().over(order)).withColumn("head", F.concat(F.lit(BEGIN), escape(F.col("role")), F.lit(MIDDLE)))
    rows = rows.withColumn("formatted", F.concat("head", escape(F.col("text")), F.lit(END)))
    return rows.select(
        "conv_id",
        "depth",
        F.struct(F.bit_xor(F.xxhash64("depth", "role", "text")).over(so_far).alias("a"), F.bit_xor(F.xxhash64(F.lit("second"), "depth", "role", "text")).over(so_far).alias("b")).alias("node"),
        "formatted",
        (F.sum(F.length("formatted")).over(so_far) - F.length("formatted")).alias("position"),
        F.when(F.col("role") == "assistant", F.length("head")).alias("loss_start"),
        F.when(F.col("role") == "assistant", F.length("formatted") - F.length("head") - len(END)).alias("loss_length"),
    )


def format_conversations(conversations: DataFrame) -> dict[str, DataFrame]:
    """``stream``: nodes in depth-first order; ``paths``: each distinct conversation's nodes and intervals;
    ``members``: conv_id to path. All three are written tables."""
    turns = T.written(_turns(conversations), "turns")
    path = F.array_sort(F.collect_list(F.struct("depth", "node")))
    convs = turns.groupBy("conv_id").agg(path.alias("p")).select("conv_id", F.transform("p", lambda x: x["node"]).alias("path"))
    ranked = T.written(convs.select("path").distinct().orderBy("path").select(F.monotonically_increasing_id().alias("rank"), "path"), "paths")
    first = ranked.select("rank", F.posexplode("path").alias("depth", "node")).groupBy("node").agg(F.min("rank").alias("rank"), F.min("depth").alias("depth"))
    texts = turns.groupBy("node").agg(*(F.first(c).alias(c) for c in ("formatted", "position", "loss_start", "loss_length")))
    nodes = first.join(texts, "node").repartitionByRange("rank", "depth").withColumn("part", F.spark_partition_id())
    nodes = T.written(nodes.withColumn("length", F.length("formatted").cast("long")), "nodes")
    # offsets: sums inside a partition after the sums of the partitions before it (one row per partition)
    sums = nodes.groupBy("part").agg(F.sum("length").alias("n"))
    base = sums.select("part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    own = Window.partitionBy("part").orderBy("rank", "depth").rowsBetween(Window.unboundedPreceding, 0)
    placed = nodes.withColumn("end", F.sum("length").over(own)).join(base, "part")
    placed = placed.select("node", "rank", "depth", (F.col("base") + F.col("end") - F.col("length")).alias("start"), (F.col("base") + F.col("end")).alias("end"), "position", "formatted", "loss_start", "loss_length")
    placed = T.written(placed, "placed")
    # along each distinct path: ancestors whose stream ranges touch make one interval
    steps = ranked.select("rank", F.posexplode("path").alias("depth", "node")).join(placed.select("node", "start", "end", F.col("rank").alias("owner")), "node")
    along = Window.partitionBy("rank").orderBy("depth")
    steps = steps.withColumn("break", F.coalesce(F.col("start") != F.lag("end").over(along), F.lit(True)))
    steps = steps.withColumn("from", F.last(F.when(F.col("break"), F.col("start")), ignorenulls=True).over(along.rowsBetween(Window.unboundedPreceding, 0)))
    steps = steps.withColumn("last", F.coalesce(F.lead("break").over(along), F.lit(False)))
    closed = F.collect_list(F.when(F.col("last"), F.struct(F.col("from").alias("start"), "end"))).over(along.rowsBetween(Window.unboundedPreceding, -1))
    steps = T.written(steps.withColumn("closed", closed), "steps")
    # what a node attends to: closed intervals, and the ancestors right before it in its own interval
    seen = F.when(F.col("start") > F.col("from"), F.concat("closed", F.array(F.struct(F.col("from").alias("start"), F.col("start").alias("end"))))).otherwise(F.col("closed"))
    attends = steps.where("rank = owner").select("node", seen.alias("ancestors"))
    stream = placed.join(attends, "node").select("start", "end", "position", "formatted", "loss_start", "loss_length", "ancestors", "rank", "depth")
    paths = steps.groupBy("rank").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("depth", "start"))), lambda x: x["start"]).alias("nodes"),
        F.max_by(F.concat("closed", F.array(F.struct(F.col("from").alias("start"), "end"))), "depth").alias("intervals"),
    )
    leaf = ranked.select("rank", F.element_at("path", -1).alias("leaf"))
    members = convs.select("conv_id", F.element_at("path", -1).alias("leaf")).join(leaf, "leaf").select("conv_id", "rank")
    return {"stream": T.written(stream.repartitionByRange("start").sortWithinPartitions("start"), "stream"), "paths": T.written(paths, "index"), "members": T.written(members, "members")}


def read_conversations(output: dict[str, DataFrame]) -> DataFrame:
    """conv_id, turns (role, text), loss text and formatted length, from the three tables alone."""
    parts = output["paths"].select("rank", F.explode("nodes").alias("start")).join(output["stream"], "start")
    rows = parts.groupBy(output["paths"]["rank"].alias("rank")).agg(F.array_sort(F.collect_list(F.struct("position", "formatted", "loss_start", "loss_length"))).alias("n"))
    text = F.array_join(F.transform("n", lambda x: x["formatted"]), "")
    loss = F.array_join(F.transform(F.filter("n", lambda x: x["loss_start"].isNotNull()), lambda x: unescape(F.substr(x["formatted"], x["loss_start"] + 1, x["loss_length"]))), "")
    rows = rows.select("rank", text.alias("formatted"), loss.alias("loss"))
    cut = F.split("formatted", END, -1)

    def turn(x: Column) -> Column:
        role = F.substring_index(x, MIDDLE, 1)
        return F.struct(unescape(F.substr(role, F.lit(len(BEGIN) + 1))).alias("role"), unescape(F.substr(x, F.length(role) + len(MIDDLE) + 1)).alias("text"))

    rows = rows.select("rank", "loss", F.length("formatted").alias("formatted_chars"), F.transform(F.slice(cut, F.lit(1), F.size(cut) - 1), turn).alias("turns"))
    return output["members"].join(rows, "rank").drop("rank")


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    odd = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    table = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text")
    back = read_conversations(format_conversations(table.unionByName(odd)))
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(lines, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.col("formatted_chars").cast("long").alias("formatted_chars"),
    )


ORACLE_SQL = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (SELECT *, replace(replace(replace(replace(role, '\', '\\'), '[INST]', '[\INST]'), '[/INST]', '[\/INST]'), '</s>', '<\/s>') AS r,
             replace(replace(replace(replace(text, '\', '\\'), '[INST]', '[\INST]'), '[/INST]', '[\/INST]'), '</s>', '<\/s>') AS t FROM c)
SELECT conv_id::BIGINT AS conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       sum(length(r) + length(t) + 17)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id"""
