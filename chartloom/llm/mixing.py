"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

Each source is cut into a fixed number of blocks by a hash of the document id. A source's quota is drawn as a prefix of
its permuted blocks, pass after pass, so blocks of one pass are disjoint. A binary tree over the output shards then
splits the drawn blocks: at every node exactly half of them, picked without regard to source, go left, which makes the
counts per source multivariate hypergeometric. Documents follow their blocks and are shuffled within their shard.

Only the table of blocks, at most sources * blocks * passes rows whatever the input size, is ever ranked as a whole.
Rows that are carried meet their blocks where they are read: the input is read once for the sums of blocks and again for
its rows, whose texts move in one shuffle, that to the shards. Give it a table that reads the same each time.
Nulls: a null source is a source of its own, ordered last; a null text has size 0; null ids hash alike. Repeated rows
are documents of their own, and so are rows of one id and text under several sources: every row is drawn for itself.
A source without words has target 0, an empty table gives an empty result. Other columns of the input are carried as
they are, whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chartloom.llm.common import cut

WORD = r"[^\x20\x09-\x0D]+"
#: Most blocks whose draws are sent to every task; more are joined by a shuffle.
SMALL = 100_000


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _named(column: str) -> Column:
    return F.col(f"`{column}`")


def source_targets(
    sizes: DataFrame, weights: Sequence[int] = (3, 1, 2), share: float = 1.5, most: float = 2.0
) -> DataFrame:
    """Targets of all sources from (`source`, `size`): by weight, but at most `most` times a source's size.

    Giving the excess of full sources to the others until none is above its cap ends where every open source has the
    same target per weight. Sources ordered by cap per weight fill up in that order, so a running sum finds the level.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights)))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn + 1).cast("int"))
    ranked = totals.withColumn("weight", weight).withColumn("cap", most * F.col("source_size"))
    filling = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    every = Window.partitionBy(F.lit(1))
    before = F.sum("cap").over(filling.rowsBetween(Window.unboundedPreceding, -1))
    rest = F.sum("weight").over(filling.rowsBetween(0, Window.unboundedFollowing))
    wanted = share * F.sum("source_size").over(every)
    level = (wanted - F.coalesce(before, F.lit(0.0))) / rest
    levels = ranked.withColumn("level", level).withColumn("full", F.col("cap") <= F.col("level") * F.col("weight"))
    final = F.min(F.when(~F.col("full"), F.struct(F.col("cap") / F.col("weight"), "level"))).over(every)["level"]
    target = F.when(F.col("full"), F.col("cap")).otherwise(final * F.col("weight"))
    return levels.select("source", "source_size", F.least(target, F.col("cap")).alias("target"))


def drawn_blocks(blocks: DataFrame, passes: int, seed: int) -> DataFrame:
    """Blocks (`source`, `block`, `words`, `source_size`, `target`) drawn in each pass, with the words taken from each.

    All drawn blocks of a source but the last are taken whole.
    """
    every = blocks.withColumn("pass", F.explode(F.sequence(F.lit(0), F.lit(passes - 1))))
    key = F.xxhash64(F.lit(seed), F.lit("permute"), "pass", "source", "block")
    before = F.sum("words").over(
        Window.partitionBy("source", "pass").orderBy(key, "block").rowsBetween(Window.unboundedPreceding, -1)
    )
    quota = F.greatest(
        F.lit(0), F.least(F.col("source_size"), F.round("target").cast("long") - F.col("pass") * F.col("source_size"))
    )
    taken = F.least(F.col("words"), quota - F.coalesce(before, F.lit(0)))
    return every.withColumn("taken", taken).where("taken > 0").select("source", "block", "pass", "words", "taken")


def split_tree(draws: DataFrame, shards: int, seed: int) -> DataFrame:
    """Deal `draws` to `shards` leaves of a binary tree; each node sends half of what it has to either side."""
    if shards < 1 or shards & (shards - 1):
        raise ValueError("shards must be a power of two")
    nodes = draws.withColumn("shard", F.lit(0))
    for level in range(shards.bit_length() - 1):
        here = Window.partitionBy("shard")
        key = F.xxhash64(F.lit(seed), F.lit(level), "source", "block", "pass")
        right = F.row_number().over(here.orderBy(key, "source", "block", "pass")) > F.ceil(
            F.count(F.lit(1)).over(here) / 2
        )
        nodes = nodes.withColumn("shard", 2 * F.col("shard") + right.cast("int"))
    return nodes


def mix_plan(
    documents: DataFrame,
    weights: Sequence[int] = (3, 1, 2),
    share: float = 1.5,
    most: float = 2.0,
    blocks: int = 256,
    shards: int = 32,
    seed: int = 17,
    carry: bool = False,
) -> DataFrame:
    """One row per document: `doc_id`, `source`, `size`, `source_size`, `target` and its `draws`.

    With `carry` the input row itself is there as the struct `row`.

    `draws` is an array of (`pass`, `shard`, `words`, `order`); `order` sorts the documents of a shard at random. The
    one block in which a source's quota ends is cut by documents in hash order, the last of them within its words.
    """
    passes = int(-(-most // 1))
    size = word_count(F.col("text")).alias("size")
    sized = documents.select(
        "doc_id",
        "source",
        F.xxhash64("doc_id", "text").alias("row_key"),
        *(["text", F.struct(*[_named(c) for c in documents.columns]).alias("row")] if carry else [size]),
        F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(blocks)).cast("int").alias("block"),
    )
    sized = sized if carry else cut(sized)
    summed = sized.select("source", "block", size if carry else "size")
    summed = cut(summed.groupBy("source", "block").agg(F.sum("size").alias("words")))
    targets = cut(source_targets(summed.withColumnRenamed("words", "size"), weights, share, most))
    summed = summed.alias("b").join(targets.alias("t"), F.expr("b.source <=> t.source"))
    summed = summed.select("b.source", "b.block", "b.words", "t.source_size", "t.target")
    draws = split_tree(drawn_blocks(summed, passes, seed), shards, seed)
    plans = cut(
        draws.groupBy("source", "block").agg(
            F.array_sort(F.collect_list(F.struct("pass", "shard", "taken", "words"))).alias("plan")
        )
    )
    if plans.count() <= SMALL:
        plans = F.broadcast(plans)
    joined = sized.alias("d").join(plans.alias("p"), F.expr("d.source <=> p.source AND d.block = p.block"), "left")
    joined = joined.select("d.*", "p.plan")
    split = F.exists("plan", lambda d: d["taken"] < d["words"])
    order = Window.partitionBy("source", "block").orderBy(
        F.xxhash64(F.lit(seed), F.lit("rows"), "doc_id"), "doc_id", "row_key"
    )
    running = F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, -1))
    last, whole = joined.where(split), joined.where(~F.coalesce(split, F.lit(False)))
    if carry:
        last, whole = (rows.select("*", size) for rows in (last, whole))
    last = last.withColumn("before", F.coalesce(running, F.lit(0)))
    whole = whole.withColumn("before", F.lit(0).cast("long"))

    def draw(d: Column) -> Column:
        return F.struct(
            d["pass"].alias("pass"),
            d["shard"].alias("shard"),
            F.when(d["taken"] == d["words"], F.col("size"))
            .otherwise(F.greatest(F.lit(0), F.least(F.col("size"), d["taken"] - F.col("before"))))
            .alias("words"),
            F.xxhash64(F.lit(seed), d["shard"], d["pass"], "doc_id", "row_key").alias("order"),
        )

    drawn = whole.unionByName(last).withColumn(
        "draws", F.filter(F.transform(F.coalesce("plan", F.array()), draw), lambda d: d["words"] > 0)
    )
    drawn = drawn.alias("d").join(targets.alias("t"), F.expr("d.source <=> t.source"))
    return drawn.select(
        "d.doc_id", "d.source", "d.size", "t.source_size", "t.target", "d.draws", *(["d.row"] if carry else [])
    )


def mixed_rows(documents: DataFrame, **parameters) -> DataFrame:
    """The mix itself: each document's columns once for every time it is taken, shard by shard and shuffled within it.

    A document taken in part keeps its first words. Each row is drawn by its own plan, which carries it, so equal ids and
    texts of several sources stay apart and no texts are joined.
    """
    plan = mix_plan(documents, carry=True, **parameters)
    drawn = plan.select("row", "size", F.explode("draws").alias("draw"))
    drawn = drawn.repartitionByRange("draw.shard", "draw.order").sortWithinPartitions("draw.shard", "draw.order")
    words = F.regexp_extract_all(F.col("row.text"), F.lit(WORD), F.lit(0))
    part = F.array_join(F.slice(words, 1, F.col("draw.words").cast("int")), " ")
    text = F.when(F.col("draw.words") < F.col("size"), part).otherwise(F.col("row.text"))
    columns = {c: F.col("row")[c] for c in documents.columns} | {"text": text}
    if "n_chars" in columns:
        columns["n_chars"] = F.length(text).cast(documents.schema["n_chars"].dataType)
    return drawn.select(*[column.alias(name) for name, column in columns.items()])
