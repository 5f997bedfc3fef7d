"""Document fingerprints by winnowing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txsieve.llm.common import let, words_of
from txsieve.session import materialize

#: Units of a gram, and grams of a window: texts that share GRAM + WINDOW - 1 units in a row share a fingerprint.
GRAM = 3
WINDOW = 6
#: Scripts without spaces: each character is a unit. Otherwise a unit is a word.
UNSPACED = r"[\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}]"
_POSITIONS = 31  # bits


def units(text: Column) -> Column:
    apart = F.when(text.rlike(UNSPACED), F.regexp_replace(text, f"({UNSPACED})", " $1 ")).otherwise(text)
    return words_of(F.lower(apart))


def _rotate(value: Column, bits: int) -> Column:
    return F.shiftleft(value, bits).bitwiseOR(F.shiftrightunsigned(value, 64 - bits))


def selected(text: Column) -> Column:
    """Chosen grams in text order, each a number: 32 bits of hash, then the inverted position.

    Unit hashes roll into gram hashes as a cyclic polynomial. The smallest number
    of a window is its smallest hash, and of equal hashes the rightmost. A text
    of fewer units than a gram is one gram, of fewer grams than a window one window.
    """
    last = 2**_POSITIONS - 1

    def grams(h: Column) -> Column:
        def gram(i: Column) -> Column:
            rolled = F.get(h, i)
            for k in range(1, GRAM):
                later = F.coalesce(F.get(h, i + k), F.lit(0).cast("bigint"))
                rolled = rolled.bitwiseXOR(_rotate(later, 21 * k))
            return F.shiftleft(F.shiftrightunsigned(rolled, 32), _POSITIONS).bitwiseOR(
                (F.lit(last) - i).cast("bigint")
            )

        return F.transform(F.sequence(F.lit(0), F.greatest(F.lit(0), F.size(h) - GRAM)), gram)

    def choose(g: Column) -> Column:
        windows = F.sequence(F.lit(0), F.greatest(F.lit(0), F.size(g) - WINDOW))
        return F.array_distinct(
            F.transform(windows, lambda i: F.least(*[F.get(g, i + k) for k in range(WINDOW)]))
        )

    hashed = F.transform(units(text), lambda w: F.xxhash64(w))
    none = F.array().cast("array<bigint>")
    return let(hashed, lambda h: F.when(F.size(h) == 0, none).otherwise(let(grams(h), choose)))


def spelled(chosen: Column) -> Column:
    """``position:hash`` of the chosen grams; positions count units from 0."""
    last = 2**_POSITIONS - 1
    return F.array_join(
        F.transform(
            chosen,
            lambda x: F.concat(
                (F.lit(last) - x.bitwiseAND(F.lit(last))).cast("string"),
                F.lit(":"),
                F.lower(F.hex(F.shiftright(x, _POSITIONS))),
            ),
        ),
        " ",
    )


def hashes(chosen: Column) -> Column:
    """The distinct hashes, without positions, as signed 32-bit numbers."""
    return F.array_distinct(
        F.transform(chosen, lambda x: (F.shiftright(x, _POSITIONS) - F.lit(2**31)).cast("int"))
    )


def likeness(first: Column, second: Column) -> Column:
    """Shared share of the distinct hashes (Jaccard); two empty fingerprints are alike."""
    shared = F.size(F.array_intersect(first, second))
    union = F.size(first) + F.size(second) - shared
    return F.when(union == 0, F.lit(1.0)).otherwise(shared / union)


def next_documents(docs: DataFrame) -> DataFrame:
    """``id, needed_by, need, text_hash`` for each distinct id of ``docs (doc_id, text)``.

    ``needed_by`` is the id that comes before in descending order, around the end;
    ``need`` is a third of the length of its text. Ids are ranged over partitions, and neighbours looked up
    within; only the first id of each partition is gathered in one place.
    """
    ids = docs.groupBy("doc_id").agg(
        F.max(F.floor(F.length("text") / 3)).alias("third"), F.min(F.xxhash64("text")).alias("text_hash")
    )
    ranged = materialize(
        ids.repartitionByRange("doc_id").withColumn("range", F.spark_partition_id()), "ids"
    )
    me = F.struct(F.col("doc_id").alias("id"), F.col("third").alias("third"))
    by_range = Window.orderBy("range")
    firsts = ranged.groupBy("range").agg(F.min(me).alias("first"))
    following = firsts.select(
        "range",
        F.coalesce(
            F.lead("first").over(by_range),
            F.min("first").over(Window.partitionBy()),
        ).alias("after"),
    )
    within = F.lead(me).over(Window.partitionBy("range").orderBy("doc_id"))
    return (
        ranged.withColumn("within", within)
        # one row per partition
        .join(F.broadcast(following), "range")
        .withColumn("user", F.coalesce("within", "after"))
        .select(
            F.col("doc_id").alias("id"),
            F.col("user.id").alias("needed_by"),
            F.col("user.third").alias("need"),
            "text_hash",
        )
    )


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, n_chars, fingerprint`` of every row of ``docs``; NULL text is empty, with the empty fingerprint."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        "doc_id", F.length(text).cast("bigint").alias("n_chars"), spelled(selected(text)).alias("fingerprint")
    )


def edited_likeness(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likeness.

    The edited text has its last third replaced by the start of the next document, in
    descending order of ``doc_id``, NULL last, and around the end. Of repeated ids the
    text with the smallest hash is the next document; each row is fingerprinted. NULL
    text is empty; two empty texts have the likeness 1. An empty table gives an
    empty result. Other columns are ignored.

    A document sends the part of its text that is needed, and its hashes, to
    the one before; whole texts are shuffled once, by id.
    """
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    neighbours = next_documents(docs)
    # Plain keys in place of a NULL: all steps then need the same partitioning, and both
    # joins the same columns, so the texts are shuffled once.
    kind = docs.schema["doc_id"].dataType
    missing = lambda name: F.col(name).isNull().alias("no_id")
    present = lambda name: F.coalesce(F.col(name), F.lit(0).cast(kind)).alias("an_id")
    keyed = docs.select(missing("doc_id"), present("doc_id"), "text")
    sent = (
        keyed.join(neighbours.select(missing("id"), present("id"), "needed_by", "need", "text_hash"), ["no_id", "an_id"])
        # not written as an equality, which would make it a join key and cost a shuffle of its own
        .where(F.xxhash64("text").bitwiseXOR(F.col("text_hash")) == 0)
        .select(
            missing("needed_by"),
            present("needed_by"),
            F.substring(F.col("text"), F.lit(1), F.col("need").cast("int")).alias("part"),
            hashes(selected(F.col("text"))).alias("next_hashes"),
        )
        .groupBy("no_id", "an_id")
        .agg(F.first("part").alias("part"), F.first("next_hashes").alias("next_hashes"))
    )
    length = F.length("text")
    third = F.floor(length / 3).cast("int")
    edited = F.concat(
        F.substring(F.col("text"), F.lit(1), length - third), F.substring(F.col("part"), F.lit(1), third)
    )
    return (
        keyed.join(sent, ["no_id", "an_id"])
        .select(
            F.when(~F.col("no_id"), F.col("an_id")).alias("doc_id"), "text", edited.alias("edited"), "next_hashes"
        )
        .withColumn("own", selected(F.col("text")))
        .withColumn("other", selected(F.col("edited")))
        .withColumn("own_hashes", hashes(F.col("own")))
        .withColumn("other_hashes", hashes(F.col("other")))
        .select(
            "doc_id",
            F.length("text").cast("bigint").alias("n_chars"),
            F.sha2("edited", 256).alias("edited_sha256"),
            spelled(F.col("own")).alias("fingerprint"),
            spelled(F.col("other")).alias("edited_fingerprint"),
            likeness(F.col("own_hashes"), F.col("other_hashes")).alias("near_edited"),
            likeness(F.col("own_hashes"), F.col("next_hashes")).alias("near_next"),
        )
    )
