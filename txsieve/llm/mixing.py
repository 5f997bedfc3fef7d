"""Mixing sources to target weights by repeating documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txsieve.llm.common import nullable_key, words_of
from txsieve.session import materialize

#: Weights of the sources in their order, repeating.
WEIGHTS = (3, 1, 2)
#: Size of the mix in percent of the input.
SHARE_PERCENT = 150
#: No source and no document is taken more often than this.
MAX_REPEATS = 2


def source_targets(sizes: DataFrame) -> DataFrame:
    """``(key, source_size, target)`` from documents ``(key, size)``.

    Targets share ``SHARE_PERCENT`` of all sizes by weight and stop at
    ``MAX_REPEATS`` times the source's size; the excess goes to the others by
    weight. In the order of room per weight, the sources that stop are a prefix:
    a source stops if its room is not above what the rest would get. Only one
    row per source is ranked, after a partial aggregation in every task.
    """
    weights = F.array(*[F.lit(w) for w in WEIGHTS])
    sources = sizes.groupBy("key").agg(F.sum("size").alias("source_size"))
    ranked = sources.withColumn(
        # NULL has the key "", which is put last
        "rank",
        F.row_number().over(Window.orderBy(F.col("key") == "", "key")) - 1,
    )
    weighed = ranked.withColumn(
        "weight", F.element_at(weights, (F.col("rank") % len(WEIGHTS) + 1).cast("int"))
    ).withColumn("room", F.col("source_size") * MAX_REPEATS)
    order = Window.orderBy(F.col("room") / F.col("weight"), "rank")
    everything = Window.partitionBy()
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    filled = (
        weighed.withColumn("all_size", F.sum("source_size").over(everything))
        .withColumn("all_weight", F.sum("weight").over(everything))
        .withColumn("room_before", F.coalesce(F.sum("room").over(before), F.lit(0)))
        .withColumn("weight_before", F.coalesce(F.sum("weight").over(before), F.lit(0)))
        .withColumn(
            "level",
            (F.col("all_size") * (SHARE_PERCENT / 100) - F.col("room_before"))
            / (F.col("all_weight") - F.col("weight_before")),
        )
        .withColumn("stops", F.col("room") <= F.col("level") * F.col("weight"))
    )
    shared = F.min(F.when(~F.col("stops"), F.struct("room_before", "rank", "level"))).over(everything)
    return filled.withColumn("shared", shared["level"]).select(
        "key",
        "source_size",
        F.when(F.col("stops"), F.col("room").cast("double"))
        .otherwise(F.col("shared") * F.col("weight"))
        .alias("target"),
    )


def draw(doc_id: Column, text: Column) -> Column:
    """A number from 0 to 1 that depends on the id and the text alone, with 52 random bits."""
    of_text = F.md5(F.coalesce(text, F.lit("")))
    digest = F.md5(F.concat(F.lit("mix:"), F.coalesce(doc_id.cast("string"), F.lit("null")), F.lit(":"), of_text))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("bigint") / F.lit(float(2**52))


def mix_plan(docs: DataFrame) -> DataFrame:
    """``doc_id, size, source_size, target, copies, taken`` and all of ``row`` per row of ``docs``.

    A document of a source with repetition rate r (target by size) is taken
    floor(r) times, and once more with probability r - floor(r), decided by a
    hash of its id and text. The table of sources is written first, so Spark knows its size
    and broadcasts it only if it is small. NULL source is a source of its own, last in the order; NULL
    text has size 0. A source without words has the target 0 and its documents
    are not taken. Rows of equal id and text draw alike; rows whose ids are NULL or repeated
    draw by their texts. An empty table gives an empty result. Other columns do not matter.
    """
    size = F.size(words_of(F.col("text"))).cast("bigint")
    sized = docs.select(
        F.col("doc_id"),
        size.alias("size"),
        nullable_key(F.col("source")).alias("key"),
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
    )
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    whole = F.floor(rate)
    more = F.when(draw(F.col("doc_id"), F.col("row.text")) < rate - whole, F.lit(1)).otherwise(F.lit(0))
    return (
        sized.join(materialize(source_targets(sized), "sources"), "key")
        .withColumn("copies", (whole + more).cast("bigint"))
        .withColumn("taken", F.col("copies") * F.col("size"))
        .drop("key")
    )


def mixed(docs: DataFrame) -> DataFrame:
    """Rows of ``docs`` with all their columns, each as often as the mix takes it, see ``mix_plan``.

    Rows with NULL text or source are mixed like others, with size 0 or as a source of their own; repeated rows are
    each taken as often. An empty table gives an empty result.
    """
    repeats = F.sequence(F.lit(1).cast("bigint"), F.col("copies"))
    return (
        mix_plan(docs)
        .where("copies > 0")
        .select("row", F.explode(repeats).alias("copy"))
        .select("row.*")
    )
