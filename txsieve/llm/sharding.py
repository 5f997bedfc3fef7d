"""Sharding by extendible hashing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txsieve.session import materialize

#: Bits of a hash, and the byte limit of a shard.
BITS = 60
LIMIT = 1 << 20
#: Levels of the directory that are counted in one pass over the documents.
LEVELS = 12


def hash_bits(doc_id: Column) -> Column:
    """The first ``BITS`` bits of a digest of the id; NULL counts as ``null``."""
    digest = F.md5(F.coalesce(doc_id.cast("string"), F.lit("null")))
    return F.conv(F.substring(digest, 1, BITS // 4), 16, 10).cast("bigint")


def prefix(bits: Column, depth: Column | int) -> Column:
    depth = F.lit(depth) if isinstance(depth, int) else depth
    return F.call_function("shiftright", bits, F.lit(BITS) - depth)


def split_buckets(sized: DataFrame, limit: int) -> DataFrame:
    """``depth, prefix`` of every bucket that splits, from documents ``(bits, n_bytes)``.

    A bucket splits on its next bit if its documents exceed the limit and differ in
    their hashes. Each pass counts ``LEVELS`` levels below the buckets that still
    split, pre-aggregated in every task by the deepest prefix; one row per bucket remains.
    """
    splits: list[DataFrame] = []
    within, top = sized, 0
    while top < BITS:
        low = min(BITS, top + LEVELS)
        cells = (
            within.groupBy(prefix(F.col("bits"), low).alias("cell"))
            .agg(F.sum("n_bytes").alias("n_bytes"), F.min("bits").alias("least"), F.max("bits").alias("most"))
        )
        depths = F.sequence(F.lit(top), F.lit(low - 1))
        counted = (
            cells.select(F.explode(depths).alias("depth"), "*")
            .groupBy("depth", F.expr(f"shiftright(cell, {low} - depth)").alias("prefix"))
            .agg(F.sum("n_bytes").alias("n_bytes"), F.min("least").alias("least"), F.max("most").alias("most"))
            .where((F.col("n_bytes") > limit) & (F.col("least") < F.col("most")))
            .select("depth", "prefix")
        )
        found = materialize(counted, "splits")
        splits.append(found)
        deepest = found.where(F.col("depth") == low - 1).select(F.col("prefix").alias("open"))
        if not deepest.head(1):
            break
        within = within.join(deepest, prefix(F.col("bits"), low - 1) == F.col("open"), "left_semi")
        top = low
    everything = splits[0]
    for more in splits[1:]:
        everything = everything.union(more)
    return everything


def leaves_of(splits: DataFrame) -> DataFrame:
    """``depth, prefix`` of the buckets that exist and don't split: the shards."""
    children = splits.select(
        (F.col("depth") + 1).alias("depth"),
        F.explode(F.array(F.col("prefix") * 2, F.col("prefix") * 2 + 1)).alias("prefix"),
    )
    return children.join(splits, ["depth", "prefix"], "left_anti")


def assign(sized: DataFrame, limit: int = LIMIT) -> DataFrame:
    """Adds ``depth`` and ``prefix`` of its shard to every row of ``sized (bits, n_bytes, ...)``.

    The directory has an entry for each prefix of a common depth, at most eight
    times as many as there are shards; an entry names the shard that holds it. The
    few shards below that depth are looked up by their own prefixes.
    """
    splits = materialize(split_buckets(sized, limit), "splits")
    leaves = materialize(leaves_of(splits), "leaves")
    counted = leaves.agg(F.count(F.lit(1)), F.max("depth")).first()
    if not counted[0]:
        return sized.withColumn("depth", F.lit(0)).withColumn("prefix", F.lit(0).cast("bigint"))
    deepest = int(counted[1])
    common = min(deepest, (int(counted[0]) - 1).bit_length() + 2)
    width = F.expr(f"shiftleft(1L, {common} - depth)")
    entries = (
        leaves.where(F.col("depth") <= common)
        .select("depth", "prefix", (F.col("prefix") * width).alias("begin"), width.alias("width"))
        .select(
            "depth", "prefix", F.explode(F.sequence(F.col("begin"), F.col("begin") + F.col("width") - 1)).alias("entry")
        )
    )
    entries = materialize(entries, "directory")
    looked_up = sized.withColumn("entry", prefix(F.col("bits"), common))
    found = looked_up.join(entries, "entry").drop("entry")
    if deepest == common:
        return found
    below = leaves.where(F.col("depth") > common).select(F.col("depth").alias("at"), F.col("prefix").alias("leaf"))
    deeper = (
        looked_up.join(entries.select("entry"), "entry", "left_anti")
        .drop("entry")
        .withColumn("depth", F.explode(F.sequence(F.lit(common + 1), F.lit(deepest))))
        .withColumn("prefix", prefix(F.col("bits"), F.col("depth")))
        .join(below, (F.col("depth") == F.col("at")) & (F.col("prefix") == F.col("leaf")))
        .drop("at", "leaf")
    )
    return found.unionByName(deeper)


def shard_documents(docs: DataFrame, limit: int = LIMIT, keep: list[str] | None = None) -> DataFrame:
    """``row, n_bytes, bits, depth, prefix, shard`` per row of ``docs (doc_id, text)``.

    ``row`` holds the columns ``keep`` of the row, all by default.

    ``shard`` spells the hash prefix in bits. Every shard holds at most ``limit`` bytes of text, unless it is
    one document or rows of one id. NULL text has no bytes, NULL ids are one id, and rows
    of one id stay together. An empty table gives an empty result.
    """
    sized = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in keep or docs.columns]).alias("row"),
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint").alias("n_bytes"),
        hash_bits(F.col("doc_id")).alias("bits"),
    )
    spelled = F.when(F.col("depth") == 0, F.lit("")).otherwise(
        F.call_function("lpad", F.bin("prefix"), F.col("depth"), F.lit("0"))
    )
    return assign(sized, limit).withColumn("shard", spelled)


def write_shards(docs: DataFrame, path: str, limit: int = LIMIT) -> None:
    """One folder per shard below ``path``, each within the byte limit of the text."""
    placed = shard_documents(docs, limit).select("row.*", F.concat(F.lit("s"), "shard").alias("shard"))
    placed.repartition("shard").sortWithinPartitions("shard").write.partitionBy("shard").parquet(path)
