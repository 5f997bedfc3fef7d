"""Quality rules: word counts, repetition, and lines that many documents of a host share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txsieve.llm.common import SPACE, let, nullable_key, words_of
from txsieve.session import materialize

SYMBOLS = r"[#*$%&|<>]"
MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50
#: A line is common on a host that has it in this many distinct documents ...
COMMON_DOCUMENTS = 50
#: ... and on a small host from this many, if they are more than this share of its distinct texts.
MIN_LINE_DOCUMENTS = 20
MAX_LINE_PERCENT = 10
#: A document is depleted if common lines leave it less than both of these ...
MIN_LEFT_WORDS = 50
MIN_LEFT_PERCENT = 50
#: ... or less than this share of its words, however many they are.
LEAST_LEFT_PERCENT = 10
#: The lines of a host are spread over this many tasks, however hot one of them is.
SALTS = 32



def repeated_words(words: Column) -> Column:
    """Words that lie in a window of three words found twice or more in ``words``.

    A sort of 32-bit hashes with positions picks the windows that may occur
    again; only those are compared by their words, so the count is exact.
    """

    def count(w: Column) -> Column:
        windows = F.sequence(F.lit(0), F.size(w) - 3)
        hashed = F.transform(
            windows,
            lambda i: F.shiftleft(
                F.hash(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).cast("bigint"), 31
            ).bitwiseOR(i.cast("bigint")),
        )
        suspects = let(
            F.sort_array(hashed),
            lambda s: F.filter(
                s,
                lambda x, i: F.shiftright(x, 31).eqNullSafe(F.shiftright(F.get(s, i - 1), 31))
                | F.shiftright(x, 31).eqNullSafe(F.shiftright(F.get(s, i + 1), 31)),
            ),
        )
        spelled = F.transform(
            F.transform(suspects, lambda x: x.bitwiseAND(F.lit(2**31 - 1)).cast("int")),
            lambda i: F.struct(
                F.concat_ws(" ", F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("at"),
                i.alias("i"),
            ),
        )
        repeated = let(
            F.sort_array(spelled),
            lambda s: F.transform(
                F.filter(
                    s,
                    lambda x, i: x["at"].eqNullSafe(F.get(s, i - 1)["at"])
                    | x["at"].eqNullSafe(F.get(s, i + 1)["at"]),
                ),
                lambda x: x["i"],
            ),
        )
        covered = let(
            F.sort_array(repeated),
            lambda p: F.aggregate(
                F.transform(
                    p, lambda x, i: F.least(F.lit(3), F.coalesce(F.get(p, i + 1) - x, F.lit(3)))
                ),
                F.lit(0).cast("bigint"),
                lambda total, x: total + x,
            ),
        )
        return F.when(F.size(w) >= 4, covered).otherwise(F.lit(0).cast("bigint"))

    return let(words, count)


def word_metrics(docs: DataFrame) -> DataFrame:
    """Adds the base counts to ``docs``; NULL and empty texts count as no words."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda line: F.length(F.regexp_replace(line, SPACE, "")) > 0)
    return (
        docs.withColumn("__words", words_of(F.col("text")))
        .withColumn("n_words", F.size("__words").cast("bigint"))
        .withColumn("word_chars", F.length(F.array_join("__words", "")).cast("bigint"))
        .withColumn("n_symbols", F.regexp_count(text, F.lit(SYMBOLS)).cast("bigint"))
        .withColumn(
            "n_dup_lines", let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("bigint")
        )
        .withColumn("n_repeat_words", repeated_words(F.col("__words")))
        .drop("__words")
    )


def normal_line(line: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(line), SPACE, " "))


def lines_of(text: Column) -> Column:
    lines = F.transform(F.split(F.coalesce(text, F.lit("")), "\n"), normal_line)
    return F.filter(lines, lambda line: line != "")


def common_lines(docs: DataFrame) -> DataFrame:
    """``host, line``: hashes of the lines that too many distinct documents of a host share.

    For a line, documents are told apart by the smallest md5 of their *other*
    lines. Exact copies are one document, and most members of a group of near
    copies share that line too and are one; a notice on unlike documents has about as
    many others as it has documents. Counts are pre-aggregated by host, line and
    other line, so neither a hot line nor a hot host is a group in one task.
    """
    marked = F.transform(
        lines_of(F.col("text")), lambda line: F.struct(F.xxhash64(line).alias("line"), F.md5(line).alias("digest"))
    )
    first_two = lambda e: F.slice(
        F.array_sort(F.array_distinct(F.transform(e, lambda x: x["digest"]))), 1, 2
    )
    beside = lambda e, m: F.transform(
        e,
        lambda x: F.struct(
            x["line"].alias("line"),
            F.xxhash64(
                F.when(x["digest"] == F.get(m, 0), F.coalesce(F.get(m, 1), F.lit(""))).otherwise(F.get(m, 0))
            ).alias("other"),
        ),
    )
    whole = F.struct(F.lit(None).cast("bigint").alias("line"), F.xxhash64("text_key").alias("other"))
    each = let(marked, lambda e: let(first_two(e), lambda m: F.concat(F.array(whole), beside(e, m))))
    counts = (
        docs.select("host", F.explode(each).alias("x"))
        .select("host", "x.line", "x.other")
        .distinct()
        .groupBy("host", "line")
        .agg(F.count(F.lit(1)).alias("documents"))
    )
    hosts = counts.where("line is null").select("host", F.col("documents").alias("host_documents"))
    return (
        counts.where(F.col("line").isNotNull() & (F.col("documents") >= MIN_LINE_DOCUMENTS))
        .join(hosts, "host")
        .where(
            (F.col("documents") >= COMMON_DOCUMENTS)
            | (F.col("documents") * 100 > F.col("host_documents") * MAX_LINE_PERCENT)
        )
        .select("host", "line")
    )


def depleted_texts(docs: DataFrame) -> DataFrame:
    """``host, text_key, common_words, common_lines``: words and hashes of the common lines of each text that has some."""
    whole = F.struct(F.lit(None).cast("bigint").alias("line"), F.lit(1).alias("words"))
    each = F.transform(
        lines_of(F.col("text")),
        lambda line: F.struct(F.xxhash64(line).alias("line"), F.size(F.split(line, " ")).alias("words")),
    )
    found = (
        docs.select("host", "text_key", F.explode(F.concat(F.array(whole), each)).alias("x"))
        .groupBy("host", F.col("x.line").alias("line"), "text_key")
        .agg(F.sum("x.words").alias("words"))
        .withColumn("salt", F.pmod(F.xxhash64("text_key"), F.lit(SALTS)).cast("int"))
    )
    common = common_lines(docs).select(
        "host", "line", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"), F.lit(True).alias("common")
    )
    return (
        found.join(common, ["host", "line", "salt"], "left")
        .where("line is null or common")
        .groupBy("host", "text_key")
        .agg(
            F.sum(F.when(F.col("line").isNull(), F.col("words"))).alias("copies"),
            F.sum(F.when(F.col("common"), F.col("words"))).alias("common_words"),
            F.collect_set(F.when(F.col("common"), F.col("line"))).alias("common_lines"),
        )
        .where("common_words > 0")
        .select(
            "host", "text_key", F.expr("common_words div copies").alias("common_words"), "common_lines"
        )
    )


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words")
    )


def is_depleted() -> Column:
    left = F.col("n_words") - F.coalesce(F.col("common_words"), F.lit(0))
    few = (left < MIN_LEFT_WORDS) & (left * 100 < MIN_LEFT_PERCENT * F.col("n_words"))
    return few | (left * 100 < LEAST_LEFT_PERCENT * F.col("n_words"))


def text_key() -> Column:
    return F.unhex(F.md5(F.coalesce(F.col("text"), F.lit(""))))


def quality_rules(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (``doc_id, text, source``): base counts and the verdict.

    Lines are normalised (lower case, single spaces), hashed, and counted once
    per distinct document of a host (``source``, see ``common_lines``). Lines in
    at least ``COMMON_DOCUMENTS`` of them are taken out; on small hosts also those in at least
    ``MIN_LINE_DOCUMENTS`` that are more than ``MAX_LINE_PERCENT`` of its texts. A document is rejected if less than
    ``MIN_LEFT_WORDS`` words and less than ``MIN_LEFT_PERCENT`` of its words are left,
    or less than ``LEAST_LEFT_PERCENT`` of them.

    NULL or empty text has no words and fails the base rules. NULL source is a
    host of its own. Repeated rows each get a row; their text counts once. Other
    columns of ``docs`` are ignored. An empty table gives an empty result.
    """
    keyed = docs.select(
        "doc_id",
        "text",
        nullable_key(F.col("source")).alias("host"),
        text_key().alias("text_key"),
    )
    return (
        word_metrics(keyed)
        .drop("text")
        .join(depleted_texts(keyed), ["host", "text_key"], "left")
        .withColumn("base_failed", base_failed())
        .withColumn("kept", ~(F.col("base_failed") | is_depleted()))
        .withColumn("common_words", F.coalesce(F.col("common_words"), F.lit(0)).cast("bigint"))
        .select(
            "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
            "base_failed", "kept", "common_words",
        )
    )


def keep_good(docs: DataFrame) -> DataFrame:
    """Rows of ``docs`` that the rules keep, whole and with all their columns.

    The verdict of a row depends on its text and host alone and is joined by
    those, so repeated rows stay repeated and NULL ids do no harm.
    """
    named = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col("text"),
        nullable_key(F.col("source")).alias("host"),
        text_key().alias("text_key"),
    )
    return (
        word_metrics(named)
        .where(~base_failed())
        .join(depleted_texts(named), ["host", "text_key"], "left")
        .where(~is_depleted())
        .select("row.*")
    )


def without_common_lines(docs: DataFrame) -> DataFrame:
    """The rows that ``keep_good`` keeps, with the common lines of their host taken out of ``text``.

    Other columns stay as they are. Texts without common lines are unchanged.
    NULL or empty texts fail the base rules and go, repeated rows stay repeated,
    an empty table gives an empty result.
    """
    named = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col("text"),
        nullable_key(F.col("source")).alias("host"),
        text_key().alias("text_key"),
    )
    left = F.filter(
        F.split("text", "\n"),
        lambda line: ~F.array_contains("common_lines", F.xxhash64(normal_line(line))),
    )
    text = F.when(F.col("common_lines").isNull(), F.col("text")).otherwise(F.array_join(left, "\n"))
    return (
        word_metrics(named)
        .where(~base_failed())
        .join(depleted_texts(named), ["host", "text_key"], "left")
        .where(~is_depleted())
        .withColumn("row", F.col("row").withField("text", text))
        .select("row.*")
    )
