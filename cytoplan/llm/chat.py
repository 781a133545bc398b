r"""Chat formatting over reply trees (DataFrame operations only).

``reply_paths`` enumerates root-to-leaf paths by self-joins that double the jump length each
round, so a chain of n replies takes log2(n) rounds; branches of a tree are ranked by the sum
of their scores, then by the leaf id. ``format_paths`` renders a chosen path as one text.

Template: ``<|start|>role<|message|>text<|end|>`` per turn. Inside roles and texts ``\`` is
written ``\\`` and ``<|`` is written ``<\|``, so no control string can occur there and the
escape can be undone. ``parse_formatted`` reads turns back from the text alone.

Defined cases: null text or role is empty; rows of one turn are ordered by role, then text, and a null turn comes last; null tree ids form one tree; a reply whose parent
is missing is a root; rows on a cycle have no root and yield nothing; equal scores prefer the
smallest leaf; repeated rows are separate turns; extra
columns are not read; a long text is one cell of a row; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialize, table

START, MESSAGE, END = "<|start|>", "<|message|>", "<|end|>"
#: Longest path that doubling covers: 2**MAX_ROUNDS replies.
MAX_ROUNDS = 40


def escape(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(c: Column) -> Column:
    return F.regexp_replace(c, r"(?s)\\(.)", "$1")


def reply_paths(nodes: DataFrame, top: int = 1) -> DataFrame:
    """nodes(tree, node, parent, score), node unique in its tree -> tree, rank, leaf, node, depth."""
    ids = nodes.select("tree", F.col("node").alias("parent"))
    linked = nodes.join(ids, ["tree", "parent"], "left_semi").select("tree", "node", F.col("parent").alias("up"), "score")
    roots = nodes.join(linked.select("tree", "node"), ["tree", "node"], "left_anti").select("tree", "node", F.lit(None).cast(nodes.schema["node"].dataType).alias("up"), "score")
    step = linked.unionByName(roots).select("tree", "node", "up", F.col("score").cast("double").alias("total"), F.when(F.col("up").isNull(), 0).otherwise(1).cast("long").alias("depth"), F.col("up").isNull().alias("rooted"))
    step = materialize(step, "jump0")
    # Rows whose jump has left the tree are finished and only looked up; the others double it.
    done, going, jumps = step.where("up is null"), step.where("up is not null"), []
    links = going.count()
    for k in range(MAX_ROUNDS):
        if 2**k > links or going.isEmpty():  # no path is longer than there are links: what is left are cycles
            break
        jumps.append(going)
        every = done.unionByName(going)
        far = every.select("tree", F.col("node").alias("up"), F.col("up").alias("up2"), F.col("total").alias("t2"), F.col("depth").alias("d2"), F.col("rooted").alias("r2"))
        doubled = going.join(far, ["tree", "up"], "left").select(
            "tree", "node", F.col("up2").alias("up"), (F.col("total") + F.coalesce("t2", F.lit(0.0))).alias("total"),
            (F.col("depth") + F.coalesce("d2", F.lit(0))).alias("depth"), (F.col("rooted") | F.coalesce("r2", F.lit(False))).alias("rooted"),
        )
        step = materialize(doubled, f"jump{k + 1}")
        done, going = done.unionByName(step.where("up is null")), step.where("up is not null")
    done = materialize(done.where("rooted").select("tree", "node", "total", "depth"), "rooted")
    leaves = done.join(linked.select("tree", F.col("up").alias("node")).distinct(), ["tree", "node"], "left_anti")
    by_score = Window.partitionBy("tree").orderBy(F.col("total").desc_nulls_last(), F.col("node").asc())
    chosen = leaves.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= top)
    chosen = materialize(chosen.select("tree", "rank", F.col("node").alias("leaf")), "leaves")
    # All distances are sums of distinct powers of two: apply each jump table once, longest first.
    paths = chosen.withColumn("node", F.col("leaf"))
    for k, jump in reversed(list(enumerate(jumps))):
        paths = materialize(paths.unionByName(paths.join(jump.select("tree", "node", "up"), ["tree", "node"]).select("tree", "rank", "leaf", F.col("up").alias("node"))), f"path{k}")
    return paths.join(done.select("tree", "node", "depth"), ["tree", "node"])


def format_paths(turns: DataFrame, by: list[str]) -> DataFrame:
    """turns(*by, depth, role, text) -> *by, formatted."""
    one = F.concat(F.lit(START), escape(F.coalesce("role", F.lit(""))), F.lit(MESSAGE), escape(F.coalesce("text", F.lit(""))), F.lit(END))
    rows = turns.select(*by, F.struct(F.col("depth"), one.alias("turn")).alias("part")).groupBy(*by)
    return rows.agg(F.array_join(F.sort_array(F.collect_list("part"))["turn"], "").alias("formatted"))


def parse_formatted(c: Column) -> Column:
    """array<struct<role, text>> from a formatted text."""
    parts = F.filter(F.split(c, r"<\|start\|>"), lambda p: p != "")
    both = F.transform(parts, lambda p: F.split(F.substring_index(p, END, 1), r"<\|message\|>"))
    return F.transform(both, lambda b: F.struct(unescape(b[0]).alias("role"), unescape(b[1]).alias("text")))


def conversations_as_trees(conv: DataFrame) -> DataFrame:
    """Rows of linear conversations as reply trees: each turn answers the one before it."""
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_last(), F.coalesce("role", F.lit("")), F.coalesce("text", F.lit("")))
    numbered = conv.select("conv_id", "turn", "role", "text").withColumn("node", F.row_number().over(order).cast("long"))
    return numbered.select(
        F.coalesce(F.col("conv_id").cast("string"), F.lit("null")).alias("tree"), "conv_id", "node", F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"),
        F.lit(1.0).alias("score"), "role", "text",
    )


def formatted_digests(formatted: DataFrame) -> DataFrame:
    """The contract's digests, read back from the formatted text."""
    read = formatted.withColumn("turns", parse_formatted(F.col("formatted")))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join(F.transform(F.filter("turns", lambda t: t["role"] == "assistant"), lambda t: t["text"]), "")
    return read.withColumn("loss", loss).select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"),
    )


def format_conversations(conv: DataFrame) -> DataFrame:
    """conv_id, formatted."""
    nodes = materialize(conversations_as_trees(conv), "nodes")
    paths = reply_paths(nodes.select("tree", "node", "parent", "score"))
    turns = nodes.join(paths.select("tree", "node", "depth"), ["tree", "node"])
    return format_paths(turns, ["conv_id"])


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    trick = "</s>[INST] ok [/INST]"
    conv = table(spark, sf_dir, "conversations").selectExpr("cast(conv_id as bigint) conv_id", "cast(turn as bigint) turn", "role", "text")
    extra = spark.range(1).selectExpr("bigint(-1) conv_id", f"inline(array(struct(bigint(0) as turn, 'user' as role, '{trick}' as text), struct(bigint(1) as turn, 'assistant' as role, '{trick}' as text)))")
    return formatted_digests(format_conversations(conv.unionByName(extra)))


OP2_SQL = r"""
with c as (select conv_id, turn, coalesce(role,'') role, coalesce(text,'') text from conversations
  union all select * from (values (-1::bigint, 0::bigint, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]'))),
e as (select *, length('<|start|>' || replace(replace(role,'\','\\'),'<|','<\|') || '<|message|>' || replace(replace(text,'\','\\'),'<|','<\|') || '<|end|>') n from c)
select conv_id, count(*) n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) turns_sha256,
  coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), '')) loss_sha256, sum(n)::bigint formatted_chars
from e group by conv_id
"""
