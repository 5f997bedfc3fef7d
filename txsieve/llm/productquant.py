"""Near-duplicate embeddings: inverted lists with residual product codes, table-lookup distances, exact rerank."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txsieve.llm.components import connected_components
from txsieve.llm.vectors import is_finite, list_column, matrix
from txsieve.session import materialize, ship_package

#: Vectors are linked from this cosine on.
LEAST_COSINE = 0.9
ANGLE = math.acos(LEAST_COSINE)
#: Angles are told apart up to this.
SLACK = 1e-6
#: The index is fitted on at most so many vectors, chosen by a hash; so many of them a list.
TRAIN_ROWS = 131_072
TRAIN_ROWS_PER_LIST = 32
#: Components of a subspace and entries of its codebook.
SUBSPACE = 4
ENTRIES = 256
FIT_ROUNDS = 8
#: A vector enters each list whose centroid is at most this much (over the root of the dimension) less similar
#: than its own. A pair at the threshold in a random direction is lost in about 1 of 2,000 cases, a closer one less often.
PROBE_MARGIN = 1.2
#: Vectors searched for balls at once; queries and entries of a list compared in one group.
CHUNK = 4096
QUERIES = 4096
CODES = 16_384


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows scaled to length one; their largest component is taken out first, so nothing overflows."""
    rows = rows / np.abs(rows).max(1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def angles(cosines: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(cosines, -1.0, 1.0))


class Index:
    """Coarse centroids on the unit sphere and codebooks of the residuals."""

    def __init__(self, sample: np.ndarray, lists: int) -> None:
        rng = np.random.default_rng(13)
        sample = sample.astype(np.float32)
        self.width = sample.shape[1]
        self.centroids = sample[rng.choice(len(sample), lists, replace=False)].copy()
        for _ in range(FIT_ROUNDS):
            home = self.scores(sample).argmax(1)
            sums = np.zeros_like(self.centroids)
            np.add.at(sums, home, sample)
            lengths = np.linalg.norm(sums, axis=1)
            used = lengths > 1e-6
            self.centroids[used] = sums[used] / lengths[used, None]
        self.subspaces = -(-self.width // SUBSPACE)
        residuals = self.cut(sample - self.centroids[self.scores(sample).argmax(1)])
        entries = min(ENTRIES, len(sample))
        self.books = np.stack([self._book(residuals[:, m], entries, rng) for m in range(self.subspaces)])

    def scores(self, rows: np.ndarray) -> np.ndarray:
        return rows.astype(np.float32) @ self.centroids.T

    def cut(self, rows: np.ndarray) -> np.ndarray:
        """``rows x subspaces x SUBSPACE``, zero-padded."""
        padded = np.zeros((len(rows), self.subspaces * SUBSPACE), np.float32)
        padded[:, : self.width] = rows
        return padded.reshape(len(rows), self.subspaces, SUBSPACE)

    @staticmethod
    def _closest(rows: np.ndarray, book: np.ndarray) -> np.ndarray:
        return ((book * book).sum(1) - 2 * rows @ book.T).argmin(1)

    def _book(self, rows: np.ndarray, entries: int, rng: np.random.Generator) -> np.ndarray:
        book = rows[rng.choice(len(rows), entries, replace=False)].copy()
        for _ in range(FIT_ROUNDS):
            at = self._closest(rows, book)
            sums, n = np.zeros_like(book), np.bincount(at, minlength=entries)
            np.add.at(sums, at, rows)
            book[n > 0] = sums[n > 0] / n[n > 0, None]
        return book

    def codes(self, rows: np.ndarray, home: np.ndarray) -> np.ndarray:
        """The entry of each subspace that is closest to the residual."""
        residuals = self.cut(rows - self.centroids[home])
        closest = [self._closest(residuals[:, m], book) for m, book in enumerate(self.books)]
        return np.stack(closest, axis=1).astype(np.uint8)

    def decoded(self, codes: np.ndarray, home: np.ndarray) -> np.ndarray:
        parts = [book[codes[:, m]] for m, book in enumerate(self.books)]
        return self.centroids[home] + np.concatenate(parts, axis=1)[:, : self.width]

    def tables(self, rows: np.ndarray) -> np.ndarray:
        """Inner products of each row with each entry, ``subspaces x rows x entries``."""
        return np.einsum("rms,mes->mre", self.cut(rows), self.books, optimize=True)


def fit(vectors: DataFrame, width: int, rows: int) -> Index:
    """An index of about the square root of ``rows`` lists, fitted on a bounded sample of the ``vectors``."""
    lists = max(1, min(math.isqrt(rows), TRAIN_ROWS // TRAIN_ROWS_PER_LIST))
    order = F.xxhash64("vector", "row")
    sample = vectors.select(order.alias("order"), "row", "vector").orderBy("order", "row").limit(lists * TRAIN_ROWS_PER_LIST)
    return Index(unit(matrix(sample.toArrow().column("vector").combine_chunks(), width)), lists)


def gathered(rows: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
    """Balls of unit ``rows``: positions of the members, their mean direction, the largest angle to it.

    Members are within half the angle of a link of the first one, so all of them are linked with each other.
    """
    near = rows.astype(np.float32) @ rows.astype(np.float32).T >= math.cos(ANGLE / 2 - SLACK) + 1e-5
    crowded = near.sum(1) > 1
    free = np.ones(len(rows), bool)
    for first in range(len(rows)):
        if not free[first]:
            continue
        members = np.flatnonzero(near[first] & free) if crowded[first] else np.array([first])
        if first not in members:  # its own product may round below a bound near one
            members = np.append(members, first)
        free[members] = False
        if len(members) == 1:
            yield members, rows[first], 0.0
        else:
            center = unit(rows[members].mean(0, keepdims=True))[0]
            yield members, center, float(angles(rows[members] @ center).max()) + SLACK


def balls(vectors: DataFrame, index: Index) -> DataFrame:
    """``row, vec_id, vector, ball`` of every vector and, on one row of each ball, its ``center, radius, n, least``.

    Vectors are dealt by ranges of (list, row), so a list that holds most of them is spread over many tasks,
    and each task looks for balls in chunks of a list.
    """

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                home = index.scores(unit(matrix(batch.column("vector"), index.width))).argmax(1)
                yield batch.append_column("list", pa.array(home, pa.int32()))

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def chunks(final: bool) -> Iterator[pa.RecordBatch]:
            nonlocal held
            rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            home = rows.column("list").to_numpy()
            starts = [0, *(np.flatnonzero(np.diff(home)) + 1).tolist(), len(home)]
            done = 0
            for start, end in zip(starts, starts[1:], strict=False):
                for at in range(start, end, CHUNK):
                    # the last run may go on in the next batch
                    if final or end < len(home) or at + CHUNK <= end:
                        done = min(at + CHUNK, end)
                        yield found(rows.slice(at, done - at))
            held = [rows.slice(done)] if done < len(home) else []

        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                if sum(b.num_rows for b in held) >= CHUNK:
                    yield from chunks(False)
        if held:
            yield from chunks(True)

    def found(chunk: pa.RecordBatch) -> pa.RecordBatch:
        points = unit(matrix(chunk.column("vector"), index.width))
        ids, rows = chunk.column("vec_id").to_pylist(), chunk.column("row").to_numpy()
        ball = np.empty(len(rows), np.int64)
        center, radius, n, least = ([None] * len(rows) for _ in range(4))
        for members, middle, reach in gathered(points):
            first = members[0]
            ball[members] = rows[first]
            center[first], radius[first], n[first] = middle.tolist(), reach, len(members)
            least[first] = min((ids[m] for m in members if ids[m] is not None), default=None)
        columns = [chunk.column(c) for c in ("row", "vec_id", "vector")]
        columns += [pa.array(ball), pa.array(center, pa.list_(pa.float64())), pa.array(radius, pa.float64())]
        columns += [pa.array(n, pa.int64()), pa.array(least, chunk.schema.field("vec_id").type)]
        return pa.RecordBatch.from_arrays(columns, ["row", "vec_id", "vector", "ball", "center", "radius", "n", "least"])

    kind = vectors.schema["vec_id"].dataType.simpleString()
    source = f"row long, vec_id {kind}, vector array<double>"
    return (
        vectors.select("row", "vec_id", "vector")
        .mapInArrow(assign, f"{source}, list int")
        .repartitionByRange("list", "row")
        .sortWithinPartitions("list", "row")
        .mapInArrow(gather, f"{source}, ball long, center array<double>, radius double, n long, least {kind}")
    )


def coded(centers: DataFrame, index: Index) -> DataFrame:
    """``ball, center, radius, home, lists, code, along, across`` of ``centers (ball, center, radius)``.

    ``along`` and ``across`` are the parts of the decoded vector along the center and across it.
    """
    margin = PROBE_MARGIN / math.sqrt(index.width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = matrix(batch.column("center"), index.width)
            scores = index.scores(rows)
            home = scores.argmax(1)
            probed = scores >= scores.max(1, keepdims=True) - np.float32(margin)
            codes = index.codes(rows, home)
            decoded = index.decoded(codes, home)
            along = (rows * decoded).sum(1)
            across = np.sqrt(np.maximum((decoded * decoded).sum(1) - along * along, 0))
            lists = pa.ListArray.from_arrays(
                pa.array(np.concatenate([[0], np.cumsum(probed.sum(1))]), pa.int32()),
                pa.array(np.nonzero(probed)[1], pa.int32()),
            )
            columns = [batch.column(0), list_column(rows.astype(np.float32), pa.float32()), batch.column("radius")]
            columns += [pa.array(home, pa.int32()), lists, pa.array([c.tobytes() for c in codes], pa.binary())]
            columns += [pa.array(along, pa.float64()), pa.array(across, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, ["ball", "center", "radius", "home", "lists", "code", "along", "across"])

    schema = "ball long, center array<float>, radius double, home int, lists array<int>, code binary, along double, across double"
    return centers.mapInArrow(run, schema)


def possible(queries: pa.Table, entries: pa.Table, index: Index) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of balls that the table-lookup distance leaves possible.

    At an angle t from its center, the inner product of a query with the decoded vector
    is at least ``along cos t - across sin t``; below the value at the largest angle that
    links members of both balls there is no link. The bound is exact.
    """
    codes = np.frombuffer(b"".join(entries.column("code").to_pylist()), np.uint8).reshape(len(entries), -1)
    home = entries.column("home").to_numpy()
    ball = entries.column("ball").to_numpy()
    along, across = (entries.column(c).to_numpy() for c in ("along", "across"))
    reach = ANGLE + SLACK + entries.column("radius").to_numpy()
    low = (along * np.cos(reach) - across * np.sin(reach)).astype(np.float32)
    turn = (along * np.sin(reach) + across * np.cos(reach)).astype(np.float32)
    rows = matrix(queries.column("center").combine_chunks(), index.width).astype(np.float32)
    own, radius = queries.column("ball").to_numpy(), queries.column("radius").to_numpy()
    for start in range(0, len(rows), 256):
        block = rows[start : start + 256]
        tables = index.tables(block)
        estimate = index.scores(block)[:, home]
        for m in range(index.subspaces):
            estimate += tables[m][:, codes[:, m]]
        r = radius[start : start + 256, None].astype(np.float32)
        q, e = np.nonzero(estimate >= np.cos(r) * low - np.sin(r) * turn - np.float32(1e-4))
        a, b = own[start : start + 256][q], ball[e]
        yield np.minimum(a, b)[a != b], np.maximum(a, b)[a != b]


def candidates(codes: DataFrame, index: Index) -> DataFrame:
    """Distinct pairs ``a, b`` of balls that may hold linked vectors.

    Queries meet the codes that entered their list, in groups of bounded size: a long
    list is cut into blocks of queries and blocks of codes, each block of one with each of the other.
    """
    queries = codes.select(F.col("home").alias("list"), "ball", "center", "radius")
    entries = codes.select(F.explode("lists").alias("list"), "ball", "home", "code", "along", "across", "radius")
    # one row a list, and there are at most TRAIN_ROWS / TRAIN_ROWS_PER_LIST lists
    sizes = queries.groupBy("list").agg(F.count("*").alias("q")).join(entries.groupBy("list").agg(F.count("*").alias("e")), "list")
    blocks = F.broadcast(sizes.select(
        "list", F.ceil(F.col("q") / QUERIES).cast("int").alias("qs"), F.ceil(F.col("e") / CODES).cast("int").alias("es")
    ))

    def dealt(rows: DataFrame, own: str, other: str) -> DataFrame:
        block = F.pmod(F.xxhash64("ball"), F.col(f"{own}s")).cast("int").alias(own)
        others = F.explode(F.sequence(F.lit(0), F.col(f"{other}s") - 1)).alias(other)
        return rows.join(blocks, "list").select(*rows.columns, block, others)

    keys = ["list", "q", "e"]

    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        pairs = list(possible(left, right, index)) if len(left) and len(right) else []
        ends = [np.concatenate([p[k] for p in pairs]) if pairs else np.empty(0, np.int64) for k in (0, 1)]
        return pa.table({"a": pa.array(ends[0], pa.int64()), "b": pa.array(ends[1], pa.int64())})

    left, right = dealt(queries, "q", "e"), dealt(entries, "e", "q")
    # both come from one table: new names for one side, or Spark finds its columns ambiguous
    grouped = left.groupBy(*keys).cogroup(right.toDF(*right.columns).groupBy(*keys))
    return grouped.applyInArrow(compare, "a long, b long").distinct()


def dot(a: str, b: str) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def judged(pairs: DataFrame, centers: DataFrame) -> DataFrame:
    """``a, b, n_a, n_b, all_linked`` of the pairs that are linked, or may be where ``all_linked`` is false."""
    left = centers.select(F.col("ball").alias("a"), F.col("center").alias("ca"), F.col("radius").alias("ra"), F.col("n").alias("n_a"))
    right = centers.select(F.col("ball").alias("b"), F.col("center").alias("cb"), F.col("radius").alias("rb"), F.col("n").alias("n_b"))
    compared = pairs.join(left, "a").join(right, "b").withColumn("cosine", dot("ca", "cb"))
    angle, reach = F.acos(F.least(F.lit(1.0), F.greatest(F.lit(-1.0), "cosine"))), F.col("ra") + F.col("rb")
    single = (F.col("n_a") == 1) & (F.col("n_b") == 1)
    linked = F.when(single, F.col("cosine") >= LEAST_COSINE).otherwise(angle + reach <= ANGLE - SLACK)
    return compared.select("a", "b", "n_a", "n_b", linked.alias("all_linked"), (~single & (angle - reach <= ANGLE + SLACK)).alias("open")).where(
        "all_linked or open"
    ).drop("open")


def counted(open_pairs: DataFrame, members: DataFrame, width: int) -> DataFrame:
    """``a, b, row, links`` of members of either ball with links to members of the other.

    A group holds two balls, each of one chunk at most.
    """

    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        sides = [unit(matrix(t.column("vector").combine_chunks(), width)) for t in (left, right)]
        linked = sides[0] @ sides[1].T >= LEAST_COSINE
        parts = []
        for table, links in ((left, linked.sum(1)), (right, linked.sum(0))):
            part = table.select(["a", "b", "row"]).append_column("links", pa.array(links, pa.int64()))
            parts.append(part.filter(pa.array(links > 0)))
        return pa.concat_tables(parts)

    sides = []
    for end in ("a", "b"):
        side = members.select(F.col("ball").alias(end), "row", "vector")
        sides.append(open_pairs.join(side, end).select("a", "b", "row", "vector").toDF("a", "b", "row", "vector").groupBy("a", "b"))
    return sides[0].cogroup(sides[1]).applyInArrow(compare, "a long, b long, row long, links long")


def near_vectors(vectors: DataFrame) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row of ``vectors (vec_id, embedding)``.

    Vectors are linked if their cosine in double precision is at least 0.9; a vector that is NULL, zero or
    holds NULL or a component that isn't finite has no links. Shorter vectors count as ending in zeros.
    Vectors so close that all are linked with each other make a ball, so copies are compared as one. Balls
    enter inverted lists; table lookups with residual codes rule out pairs, the others are decided by exact cosines.
    Only the choice of lists can lose a link.

    Rows are vectors of their own, also with equal or NULL ids. ``component_id`` is the smallest id
    that isn't NULL, ``kept`` holds for its rows, or for all rows where there is none.
    An empty table gives an empty result. Other columns are ignored.
    """
    spark = vectors.sparkSession
    ship_package(spark)
    vector = F.col("embedding").cast("array<double>")
    usable = is_finite(F.col("embedding")) & F.exists(vector, lambda x: x != 0)
    source = materialize(
        vectors.select(
            F.monotonically_increasing_id().alias("row"), "vec_id", F.when(usable, vector).alias("vector")
        ),
        "vectors",
    )
    alone = source.where("vector is null").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept")
    )
    source = source.where("vector is not null")
    rows, width = source.agg(F.count("*"), F.max(F.size("vector"))).first()
    if not rows:
        return alone
    index = fit(source, width, rows)
    members = materialize(balls(source, index), "balls")
    centers = members.where("n is not null").select("ball", "center", "radius", "n", "least")
    codes = materialize(coded(centers.select("ball", "center", "radius"), index), "codes")
    pairs = materialize(judged(candidates(codes, index), centers), "pairs")
    whole, part = pairs.where("all_linked"), pairs.where("not all_linked").select("a", "b")
    some = materialize(counted(part, members, width), "counted")

    links = whole.select("a", "b").union(some.select("a", "b").distinct())
    labels = connected_components(links).withColumnsRenamed({"node": "ball"})
    labelled = centers.join(labels, "ball", "left").withColumn("label", F.coalesce("label", "ball"))
    smallest = labelled.groupBy("label").agg(F.min("least").alias("component_id"))
    both = whole.select(F.col("a").alias("ball"), F.col("n_b").alias("links")).union(whole.select("b", "n_a"))
    of_ball = (
        labelled.join(smallest, "label")
        .join(both.groupBy("ball").agg(F.sum("links").alias("outside")), "ball", "left")
        .select("ball", "component_id", (F.col("n") - 1 + F.coalesce("outside", F.lit(0))).alias("of_ball"))
    )
    of_row = some.groupBy("row").agg(F.sum("links").alias("of_row"))
    return (
        members.select("row", "vec_id", "ball")
        .join(of_ball, "ball")
        .join(of_row, "row", "left")
        .select(
            "vec_id",
            (F.col("of_ball") + F.coalesce("of_row", F.lit(0))).alias("n_links"),
            "component_id",
            F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"),
        )
        .union(alone)
    )
