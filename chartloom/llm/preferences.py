"""Preference formatting: paired completions after the longest common run of turns.

A conversation is the array of its turns in order. The turns that the chosen and the rejected conversation share from
the start are rendered once as the prompt; what follows in either is its completion, with the character spans of
assistant turns that a loss is taken over. All of it is DataFrame expressions.

Null roles and texts render empty and are equal to each other. Repeated turn numbers are ordered by role and text. Equal
conversations give a prompt and empty completions. Without a rejected conversation, the last turn is the chosen completion
if it is an assistant's, all before it are the prompt, and what is of the rejected one is null.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chartloom.llm.common import cut

OPEN, CLOSE, STOP = "<|", "|>\n", "\n<|end|>\n"


def _turn() -> Column:
    return F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))


def conversations(turns: DataFrame) -> DataFrame:
    """`conv_id` and its `turns`, an array of (turn, role, text). One row holds one conversation, as rendering needs.

    Turns without `conv_id` belong to none.
    """
    rows = turns.where("conv_id IS NOT NULL").groupBy("conv_id")
    return rows.agg(F.array_sort(F.collect_list(_turn())).alias("turns"))


def _same(a: Column, b: Column) -> Column:
    return (a["role"] == b["role"]) & (a["text"] == b["text"])


def common_turns(a: str, b: str) -> Column:
    """Number of leading turns that arrays `a` and `b` share."""
    pairs = F.zip_with(a, b, lambda x, y: F.coalesce(_same(x, y), F.lit(False)))
    first = F.array_position(pairs, False)
    return F.when(first == 0, F.size(pairs)).otherwise(first - 1).cast("int")


def _shown(t: Column) -> Column:
    return F.concat(F.lit(OPEN), t["role"], F.lit(CLOSE), t["text"], F.lit(STOP))


def rendered(turns: Column) -> Column:
    return F.array_join(F.transform(turns, _shown), "")


def loss_spans(turns: Column) -> Column:
    """Start and length, in characters of the rendered turns, of assistant texts and their stops."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans"))

    def step(state: Column, t: Column) -> Column:
        head = F.length(F.concat(F.lit(OPEN), t["role"], F.lit(CLOSE)))
        body = F.length(t["text"]) + len(STOP)
        span = F.struct((state["at"] + head).cast("int").alias("start"), body.cast("int").alias("length"))
        more = F.when(t["role"] == "assistant", F.concat(state["spans"], F.array(span))).otherwise(state["spans"])
        return F.struct((state["at"] + head + body).cast("int").alias("at"), more.alias("spans"))

    return F.aggregate(turns, start, step)["spans"]


def format_preferences(pairs: DataFrame) -> DataFrame:
    """Prompt, completions and loss spans of pairs (`pair_id`, `chosen`, `rejected`), arrays of turns."""
    closed = (F.size("chosen") > 0) & (F.try_element_at("chosen", F.lit(-1))["role"] == "assistant")
    alone = F.size("chosen") - closed.cast("int")
    split = pairs.withColumn("shared", F.when(F.col("rejected").isNull(), alone).otherwise(common_turns("chosen", "rejected")))
    rest = {c: F.expr(f"slice({c}, shared + 1, greatest(size({c}) - shared, 0))") for c in ("chosen", "rejected")}
    return split.select(
        "pair_id",
        F.col("shared").alias("prompt_turns"),
        rendered(F.expr("slice(chosen, 1, shared)")).alias("prompt"),
        *[rendered(rest[c]).alias(f"{c}_completion") for c in rest],
        *[loss_spans(rest[c]).alias(f"{c}_loss") for c in rest],
    )


def following_replies(rows: DataFrame) -> DataFrame:
    """`conv_id` and `other`, the next larger id with a reply, for all ids that have one.

    Ids (`conv_id`, unique, and `last`, 0 without a reply) are dealt to ranges between quantiles. Within a range the
    next id comes from a running window; the last ones of a range take the first reply of the ranges after it.
    """
    spark = rows.sparkSession
    ids = cut(rows.select("conv_id", (F.col("last") > 0).alias("replied"), F.col("conv_id").cast("double").alias("at")))
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    places = ids.approxQuantile("at", [i / parts for i in range(1, parts)], 1 / (4 * parts))
    splits = [-float("inf"), *sorted(set(places) or {0.0}), float("inf")]
    placed = Bucketizer(splits=splits, inputCol="at", outputCol="bin").transform(ids).drop("at")
    firsts = placed.where("replied").groupBy("bin").agg(F.min("conv_id").alias("first")).collect()
    first, after, edges = {r["bin"]: r["first"] for r in firsts}, None, []
    for bin_ in reversed(range(len(splits) - 1)):
        edges.append((float(bin_), after))
        after = first.get(float(bin_), after)
    kind = rows.schema["conv_id"].dataType.simpleString()
    edges = spark.createDataFrame(edges, f"bin double, after {kind}").hint("broadcast")  # one row a range
    before = Window.partitionBy("bin").orderBy(F.desc("conv_id")).rowsBetween(Window.unboundedPreceding, -1)
    inside = F.last(F.when(F.col("replied"), F.col("conv_id")), ignorenulls=True).over(before)
    found = placed.withColumn("inside", inside).join(edges, "bin")
    return found.select("conv_id", F.coalesce("inside", "after").alias("other")).where("other IS NOT NULL")


def reply_pairs(turns: DataFrame) -> DataFrame:
    """Pairs from plain conversations: each up to its last reply, against the same with the next one's last reply.

    The next conversation is the one with the next larger id that has a reply. `rejected` is null where there is none.
    A conversation without a reply is there with all its turns and no `rejected`; so is each turn of a null id.
    """
    rows = conversations(turns)
    asked = F.expr("transform(turns, (t, i) -> if(t.role = 'assistant', i + 1, 0))")
    rows = rows.withColumn("last", F.coalesce(F.array_max(asked), F.lit(0)))
    own = rows.select("conv_id", F.expr("if(last > 0, slice(turns, 1, last), turns)").alias("chosen"), "last")
    other = rows.where("last > 0").select(F.col("conv_id").alias("other"), F.expr("turns[last - 1].text").alias("reply"))
    joined = own.join(following_replies(rows), "conv_id", "left").join(other, "other", "left")
    head = F.expr("slice(chosen, 1, greatest(last - 1, 0))")
    reply = F.expr("array(named_struct('turn', try_element_at(chosen, last).turn, 'role', 'assistant', 'text', reply))")
    rejected = F.when(F.col("reply").isNotNull() & (F.col("last") > 0), F.concat(head, reply))
    pairs = joined.select(F.col("conv_id").alias("pair_id"), "chosen", rejected.alias("rejected"))
    single = turns.where("conv_id IS NULL").select(F.col("conv_id").alias("pair_id"), F.array(_turn()).alias("chosen"))
    return pairs.unionByName(single, allowMissingColumns=True)
