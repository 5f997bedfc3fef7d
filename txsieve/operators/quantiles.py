"""Exact quantiles of very large columns.

The built-in ``percentile`` keeps every distinct value of a group in one task,
which a large table of doubles does not allow; quantile sketches are small per
task but add up when hundreds of thousands of tasks send one to a single
reducer. Here a small random sample only proposes cut points; exact counts over
all rows decide between which cut points the wanted rank lies; and the rows
left there are ranked once they are few. Each round is one scan that sends a
few counts and the sample to the reducer, and each round divides the candidates
by a few hundred. An unlucky sample costs another round and never changes the
result. Columns whose rows are few to begin with need no round.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SAMPLE_ROWS = 400_000
RANKABLE_ROWS = 400_000
GRID_STEPS = 1_000
GRID_ACCURACY = 10_000
DEVIATIONS = 5
SKETCH_SIZE = 4_000
SKETCH_GROUPS = 256


@dataclass
class _Search:
    """Where the value of a 0-based rank can be: strictly between two values.

    ``before`` rows are at or below ``low``; ``inside`` rows lie strictly
    between the bounds. ``cuts`` are unproven cut points for the next scan, and
    ``expected`` is the number of rows they are expected to enclose.
    """

    rank: int
    inside: int
    low: float | None = None
    high: float | None = None
    before: int = 0
    cuts: tuple[float, ...] = ()
    expected: float = 0.0
    found: float | None = None
    up_to_found: int = 0

    def between(self, value: Column, guessed: bool = False) -> Column:
        """Whether a value lies inside the proven, or else the guessed, interval."""
        low, high = (self.cuts[0], self.cuts[-1]) if guessed and self.cuts else (self.low, self.high)
        inside = value.isNotNull()
        if low is not None:
            inside = inside & (value > F.lit(low))
        if high is not None:
            inside = inside & (value < F.lit(high))
        return inside

    def sample_share(self) -> float:
        return min(1.0, SAMPLE_ROWS / max(1.0, self.expected if self.cuts else self.inside))

    def narrow(self, counts: list[tuple[float, int, int]]) -> bool:
        """Use exact ``(cut, rows below, rows at or below)``; True if the guess held."""
        after = self.before + self.inside
        for cut, below, up_to in counts:
            if below <= self.rank < up_to:
                self.found, self.up_to_found = cut, up_to
                return False
            if up_to <= self.rank:
                self.low, self.before = cut, up_to
            elif self.high is None or cut < self.high:
                self.high, after = cut, below
        self.inside = after - self.before
        return not counts or (self.low, self.high) == (counts[0][0], counts[-1][0])

    def propose(self, grid: list[float] | None, share: float) -> None:
        """Pick the sampled values around the wanted relative rank.

        They lie ``DEVIATIONS`` standard errors of a sampled rank, one row and
        the error of the grid apart from it.
        """
        self.cuts = ()
        if not grid or self.inside == 0:
            return
        place = (self.rank - self.before) / self.inside
        spread = max(place * (1 - place), 1e-4) * (1 - share)  # a full sample has no error
        error = DEVIATIONS * math.sqrt(spread / (self.inside * share))
        error += 1 / self.inside + 1 / GRID_ACCURACY
        first = max(0, math.floor((place - error) * GRID_STEPS))
        last = min(GRID_STEPS, math.ceil((place + error) * GRID_STEPS))
        self.cuts = tuple(sorted({grid[first], grid[last]}))
        self.expected = self.inside * (last - first) / GRID_STEPS


def exact_quantiles(
    df: DataFrame,
    columns: list[str],
    q: float,
    rows: int | None = None,
    rankable: int = RANKABLE_ROWS,
) -> dict[str, float | None]:
    """Exact ``q`` quantile of each column, interpolated linearly.

    NULL is ignored; a column without values gives None. ``rows`` may pass a
    known row count if the columns hold no NULL. ``df`` is scanned several
    times, so it should be a stored table or a cheap projection of one.
    """
    values = df.select(*[F.col(name).cast("double").alias(name) for name in columns])
    if rows is None:
        counted = values.agg(*[F.count(name).alias(name) for name in columns]).first()
        sizes = {name: counted[name] for name in columns}
    else:
        sizes = dict.fromkeys(columns, rows)
    searches = {
        name: _Search(rank=math.floor(q * (size - 1)), inside=size)
        for name, size in sizes.items()
        if size > 0
    }

    while wide := {
        name: search
        for name, search in searches.items()
        if search.found is None and search.inside > rankable
    }:
        _narrow_by_scan(values, wide, rankable)

    neighbours = _rank_candidates(
        values, {name: search for name, search in searches.items() if search.found is None}
    )
    following = {}
    for name, (value, up_to, above) in neighbours.items():
        searches[name].found, searches[name].up_to_found = value, up_to
        # Candidates end below ``high``, which is a value of the column.
        following[name] = searches[name].high if above is None else above
    ends = {
        name: search
        for name, search in searches.items()
        if search.up_to_found <= search.rank + 1 < sizes[name]
    }
    # A scan of its own is needed only after a cut point hit the rank.
    unknown = {name: search for name, search in ends.items() if following.get(name) is None}
    following |= _next_values(values, unknown)

    result: dict[str, float | None] = dict.fromkeys(columns)
    for name, search in searches.items():
        share = q * (sizes[name] - 1) - search.rank
        upper = following[name] if name in ends else search.found
        result[name] = search.found + (upper - search.found) * share
    return result


def approximate_quantiles(
    df: DataFrame, columns: list[str], q: float, k: int = SKETCH_SIZE
) -> dict[str, float | None]:
    """One-scan alternative: KLL sketches, a rank error below 0.1 % for the default size.

    The sketches of all tasks are first merged into ``SKETCH_GROUPS`` and then
    into one, so that no reducer receives one from every task.
    """
    group = F.pmod(F.spark_partition_id(), F.lit(SKETCH_GROUPS)).alias("_group")
    values = df.select(group, *[F.col(name).cast("double").alias(name) for name in columns])
    partial = values.groupBy("_group").agg(
        *[F.kll_sketch_agg_double(name, k).alias(name) for name in columns]
    )
    merged = partial.agg(*[F.kll_merge_agg_double(name).alias(name) for name in columns])
    row = merged.select(
        *[
            F.when(
                F.kll_sketch_get_n_double(name) > 0,
                F.kll_sketch_get_quantile_double(name, F.lit(float(q))),
            ).alias(name)
            for name in columns
        ]
    ).first()
    return row.asDict()


def _narrow_by_scan(values: DataFrame, searches: dict[str, _Search], rankable: int) -> None:
    """One scan: count at the cut points and, while many rows are left, sample between them.

    The sampled values are computed in a projection of their own, which is
    compiled, whereas expressions inside the sketch function would be interpreted.
    """
    grid_points = F.expr(f"array({','.join(f'{i / GRID_STEPS}D' for i in range(GRID_STEPS + 1))})")
    sampled = {name: s for name, s in searches.items() if not s.cuts or s.expected > rankable}
    shares = {name: search.sample_share() for name, search in sampled.items()}
    drawn = values.withColumn("_draw", F.rand(0)).select(
        *searches,
        *[
            F.when(
                search.between(F.col(name), guessed=True) & (F.col("_draw") < F.lit(shares[name])),
                F.col(name),
            ).alias(f"_{name}")
            for name, search in sampled.items()
        ],
    )
    # Over a bounded sample the sketches are bounded in total, not only per task.
    aggregates = [
        F.percentile_approx(f"_{name}", grid_points, GRID_ACCURACY).alias(f"{name}.grid")
        for name in sampled
    ]
    for name, search in searches.items():
        value = F.col(name)
        for i, cut in enumerate(search.cuts):
            aggregates.append(F.count_if(value < F.lit(cut)).alias(f"{name}.below{i}"))
            aggregates.append(F.count_if(value <= F.lit(cut)).alias(f"{name}.upto{i}"))
    row = drawn.agg(*aggregates).first()
    for name, search in searches.items():
        counts = [
            (cut, row[f"{name}.below{i}"], row[f"{name}.upto{i}"])
            for i, cut in enumerate(search.cuts)
        ]
        held = search.narrow(counts)
        # A sample of an interval that turned out wrong says nothing; the next
        # scan then draws a new one over the interval now proven.
        if held and name in sampled:
            search.propose(row[f"{name}.grid"], shares[name])
        else:
            search.cuts = ()


def _rank_candidates(
    values: DataFrame, searches: dict[str, _Search]
) -> dict[str, tuple[float, int, float | None]]:
    """Value at each rank, the number of rows up to it, and the next candidate above.

    Equal values are counted before the shuffle, and no column has more than
    ``rankable`` candidates, which bounds the per-column ranking window.
    """
    if not searches:
        return {}
    candidates = [
        F.when(
            search.between(F.col(name)),
            F.struct(F.lit(name).alias("name"), F.col(name).alias("value")),
        )
        for name, search in searches.items()
    ]
    goals = F.create_map(
        *[F.lit(part) for name, s in searches.items() for part in (name, s.rank - s.before)]
    )
    running = Window.partitionBy("name").orderBy("value")
    ranked = (
        values.select(F.inline(F.array_compact(F.array(*candidates))))
        .groupBy("name", "value")
        .agg(F.count(F.lit(1)).alias("copies"))
        .withColumn("upto", F.sum("copies").over(running))
        .withColumn("above", F.lead("value").over(running))
        .withColumn("goal", goals[F.col("name")])
        .where((F.col("upto") > F.col("goal")) & (F.col("upto") - F.col("copies") <= F.col("goal")))
    )
    return {
        row["name"]: (row["value"], row["upto"] + searches[row["name"]].before, row["above"])
        for row in ranked.collect()
    }


def _next_values(values: DataFrame, searches: dict[str, _Search]) -> dict[str, float]:
    """Smallest value above each found one."""
    if not searches:
        return {}
    row = values.agg(
        *[
            F.min(F.when(F.col(name) > F.lit(search.found), F.col(name))).alias(name)
            for name, search in searches.items()
        ]
    ).first()
    return row.asDict()
