"""Chat formatting in budgeted windows with loss masks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txsieve.llm.common import let, words_of
from txsieve.session import materialize

#: Tokens of a window, of repeated history, and of the marks around a turn. A word counts as one token.
BUDGET = 512
HISTORY = 128
OVERHEAD = 4
#: A window takes at least this many tokens of new turns, however long the system turn is.
LEAST_NEW = 64
#: Characters of a role or text that decide where the sorted turns are cut into ranges.
CUT_CHARS = 64
#: Marks of a turn. Texts and roles never hold them: see ``escape``.
OPEN, MIDDLE, CLOSE = "### ", " ###\n", " </turn>\n"
SYSTEM, TARGET = "system", "assistant"


def escape(text: Column) -> Column:
    r"""Puts a backslash before each ``\``, ``#`` and ``<``, so none of the marks can occur."""
    return F.regexp_replace(text, r"([\\#<])", r"\\$1")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def render(role: Column, text: Column) -> Column:
    return F.concat(F.lit(OPEN), escape(role), F.lit(MIDDLE), escape(text), F.lit(CLOSE))


def placed_turns(turns: DataFrame) -> DataFrame:
    """All turns with ``before``, the tokens of their conversation before them, and ``part``, their range of the order.

    The turns are sorted into ranges, so a long conversation lies in many of
    them: sums run within a range, and the sums of whole ranges are added up.
    Ranges are cut by the first characters of roles and texts, so cuts stay small;
    only repeats of one turn are never told apart by them.
    """
    rows = turns.select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    ).withColumn("cost", (F.size(words_of(F.col("text"))) + OVERHEAD).cast("bigint"))
    ranged = materialize(
        rows.repartitionByRange(
            "conv_id", "turn", F.substring("role", 1, CUT_CHARS), F.substring("text", 1, CUT_CHARS)
        ).withColumn("part", F.spark_partition_id()),
        "turns",
    )
    sums = ranged.groupBy("conv_id", "part").agg(F.sum("cost").alias("total"))
    so_far = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # stored, so its size is known and Spark need not shuffle the texts to join a small one
    bases = materialize(
        sums.select("conv_id", "part", F.coalesce(F.sum("total").over(so_far), F.lit(0)).alias("base")), "ranges"
    )
    earlier = (
        Window.partitionBy("conv_id", "part")
        .orderBy("turn", "role", "text")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        join_parts(ranged, bases)
        .withColumn("before", F.col("base") + F.coalesce(F.sum("cost").over(earlier), F.lit(0)))
        .drop("base")
    )


def join_parts(rows: DataFrame, parts: DataFrame) -> DataFrame:
    """``rows`` with the columns of their conversation's range in ``parts``."""
    other = parts.withColumnsRenamed({"conv_id": "__conv", "part": "__part"})
    same = F.col("conv_id").eqNullSafe(F.col("__conv")) & (F.col("part") == F.col("__part"))
    return rows.join(other, same).drop("__conv", "__part")


def format_windows(turns: DataFrame) -> DataFrame:
    """``conv_id, window, formatted, loss, n_repeated, tokens`` from ``conv_id, turn, role, text``.

    Prefix sums of the turn tokens cut a conversation into spans of whole turns: a
    turn belongs to the span that its start falls into. Each window holds the
    system turn (if the first turn is one), the last turns before the span as
    far as ``HISTORY`` tokens and the budget allow, and the span. ``n_repeated``
    turns at its start were in an earlier window. ``loss`` lists start (from 0) and
    length, in code points, of the texts of the span's assistant turns; repeated
    ones are masked. Only the last turn of a span can exceed the budget; it isn't cut.
    Numbers of windows start from 0 and rise; a turn longer than a span leaves a gap.

    A window is put together on its own, from the turns of its span and those
    that start at most ``HISTORY`` tokens before one, so a row is bounded by the
    budget and one turn, however long the conversation is.

    NULL role or text is empty. Turns with equal numbers are ordered by role and text,
    NULL numbers come first, repeated rows are repeated turns. NULL ids are
    one conversation. An empty table gives an empty result. Other columns are ignored.
    """
    placed = materialize(placed_turns(turns), "turns")
    first = placed.where("before = 0").select(
        F.col("conv_id").alias("__conv"),
        (F.col("role") == SYSTEM).cast("int").alias("has_system"),
        F.when(F.col("role") == SYSTEM, F.struct("before", "role", "text", "cost")).alias("system_turn"),
    )
    # one row per conversation and range
    parts = materialize(
        placed.select("conv_id", "part")
        .distinct()
        .join(first, F.col("conv_id").eqNullSafe(F.col("__conv")))
        .drop("__conv")
        .withColumn("system_cost", F.coalesce(F.col("system_turn.cost"), F.lit(0)).cast("bigint"))
        .withColumn("room", F.greatest(F.lit(LEAST_NEW), BUDGET - HISTORY - F.col("system_cost"))),
        "ranges",
    )
    spanned = join_parts(placed, parts.select("conv_id", "part", "has_system", "room")).withColumn(
        "span", F.floor(F.col("before") / F.col("room"))
    )
    last = F.floor((F.col("before") + HISTORY) / F.col("room"))
    may_repeat = (last > F.col("span")) & ~((F.col("before") == 0) & (F.col("has_system") == 1))
    serves = F.when(may_repeat, F.sequence("span", last)).otherwise(F.array("span"))
    turn = F.struct("before", "role", "text", "cost")
    own = F.col("window") == F.col("span")
    windows = (
        spanned.withColumn("window", F.explode(serves))
        .groupBy("conv_id", "window")
        .agg(
            F.sort_array(F.collect_list(F.when(own, turn))).alias("new"),
            F.sort_array(F.collect_list(F.when(~own, turn))).alias("near"),
            F.min(F.when(own, F.col("part"))).alias("part"),
        )
        .where(F.size("new") > 0)
    )
    windows = (
        join_parts(windows, parts.select("conv_id", "part", "system_turn", "system_cost"))
        .withColumn("new_cost", F.aggregate("new", F.lit(0).cast("bigint"), lambda a, t: a + t["cost"]))
        .withColumn(
            "allowed", F.least(F.lit(HISTORY), BUDGET - F.col("new_cost") - F.col("system_cost"))
        )
        .withColumn("begins", F.col("new")[0]["before"])
        .withColumn("history", F.filter("near", lambda t: F.col("begins") - t["before"] <= F.col("allowed")))
        .withColumn(
            "system", F.when(F.col("begins") > 0, F.array_compact(F.array("system_turn"))).otherwise(F.slice("new", 1, 0))
        )
        .withColumn("parts", F.concat("system", "history", "new"))
        .withColumn("n_repeated", F.size("system") + F.size("history"))
        .select("conv_id", "window", "parts", "n_repeated")
    )
    pieces = F.transform("parts", lambda t: render(t["role"], t["text"]))
    header = lambda t: F.length(F.concat(F.lit(OPEN), escape(t["role"]), F.lit(MIDDLE)))
    starts = F.transform(
        F.sequence(F.lit(0), F.size("parts") - 1),
        lambda i: F.length(F.array_join(F.slice("pieces", 1, i), "")) + header(F.get("parts", i)),
    )
    masks = F.zip_with(
        "parts",
        starts,
        lambda t, at: F.struct(
            t["role"].alias("role"), at.alias("start"), F.length(escape(t["text"])).alias("length")
        ),
    )
    targets = F.filter(
        F.slice("masks", F.col("n_repeated") + 1, F.size("masks") - F.col("n_repeated")),
        lambda m: m["role"] == TARGET,
    )
    return (
        windows.withColumn("pieces", pieces)
        .withColumn("masks", masks)
        .select(
            "conv_id",
            "window",
            F.array_join("pieces", "").alias("formatted"),
            F.transform(targets, lambda m: F.struct(m["start"].alias("start"), m["length"].alias("length"))).alias("loss"),
            "n_repeated",
            F.aggregate("parts", F.lit(0).cast("bigint"), lambda a, t: a + t["cost"]).alias("tokens"),
        )
    )


def read_windows(windows: DataFrame) -> DataFrame:
    """``conv_id, window, turns, targets, chars``: what each formatted window says, read back.

    ``turns`` are ``role, text`` in order without the repeated ones, ``targets`` the texts under the loss masks.
    """
    split = F.split("formatted", CLOSE)
    each = let(split, lambda p: F.slice(p, F.col("n_repeated") + 1, F.size(p) - 1 - F.col("n_repeated")))
    parsed = F.transform(
        each,
        lambda p: F.struct(
            unescape(F.substring_index(F.substring(p, len(OPEN) + 1, 2**31 - 1), MIDDLE, 1)).alias("role"),
            unescape(
                F.substring(p, F.instr(p, MIDDLE) + len(MIDDLE), F.lit(2**31 - 1))
            ).alias("text"),
        ),
    )
    targets = F.transform(
        "loss", lambda m: unescape(F.substring(F.col("formatted"), m["start"] + 1, m["length"]))
    )
    return windows.select(
        "conv_id", "window", parsed.alias("turns"), targets.alias("targets"), F.length("formatted").alias("chars")
    )


def digest(read: DataFrame) -> DataFrame:
    """Sizes and checksums of what was read back, per conversation.

    A checksum is over all that a conversation says, so its windows come
    together here as two strings; ``format_windows`` and ``read_windows`` never do that.
    """
    said = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    in_order = lambda name: F.array_join(F.transform("windows", lambda w: w[name]), "")
    return (
        read.select(
            "conv_id", "window", F.size("turns").alias("n"), "chars",
            F.array_join(said, "").alias("said"), F.array_join("targets", "").alias("learned"),
        )
        .groupBy("conv_id")
        .agg(
            F.sum("n").alias("n_turns"),
            F.sum("chars").alias("formatted_chars"),
            F.sort_array(F.collect_list(F.struct("window", "said", "learned"))).alias("windows"),
        )
        .select("conv_id", "n_turns", "formatted_chars", in_order("said").alias("said"), in_order("learned").alias("learned"))
        .select(
            "conv_id",
            F.col("n_turns").cast("bigint"),
            F.sha2("said", 256).alias("turns_sha256"),
            F.length("learned").cast("bigint").alias("loss_chars"),
            F.sha2("learned", 256).alias("loss_sha256"),
            F.col("formatted_chars").cast("bigint"),
        )
    )
