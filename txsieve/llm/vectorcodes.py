"""Codes of vectors by exact integer k-means, with nearest entries found in the Walsh-Hadamard domain."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txsieve.llm.common import nullable_key
from txsieve.llm.vectors import is_finite, matrix
from txsieve.session import ship_package

PARTS = 4
ENTRIES = 256
ROUNDS = 4
#: Components become floor(SCALE * x).
SCALE = 1024
#: Coefficients added before entries are eliminated anew.
STEP = 4
#: Rows compared with a codebook at once.
BLOCK = 512
#: Entries are compared one by one once less than this share of them is left, and as a block before.
FEW = 0.1
#: Bits of a limb of a sum of numbers that 64 bits don't hold.
LIMB = 30
#: Rows of a label are spread over so many groups when its total comes back to them.
SPREAD = 64


def padded_size(width: int) -> int:
    """The least power of two from ``width`` on."""
    return 1 << max(0, width - 1).bit_length()


def sequency_order(size: int) -> np.ndarray:
    """Rows of the Hadamard matrix of ``size`` by their number of sign changes."""
    matrix_ = np.ones((1, 1), np.int64)
    while len(matrix_) < size:
        matrix_ = np.block([[matrix_, matrix_], [matrix_, -matrix_]])
    return np.argsort((np.diff(matrix_, axis=1) != 0).sum(1), kind="stable")


def transformed(rows: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard transform of zero-padded integer rows, coefficients by ascending sequency.

    Sums and differences only: of integers it is exact, and squared distances
    become ``padded_size`` times as large.
    """
    n, width = rows.shape
    size = padded_size(width)
    out = np.zeros((n, size), rows.dtype)
    out[:, :width] = rows
    half = 1
    while half < size:
        pairs = out.reshape(n, -1, 2, half)
        out = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(n, size)
        half *= 2
    return out[:, sequency_order(size)]


def nearest(rows: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest of transformed ``entries`` for transformed ``rows`` (ties to the lower), and the squared distance.

    Squared differences are added up a few coefficients at a time. The whole distance of the
    entry that leads by then is a bound; what exceeds the least bound is out for good.
    """
    size = rows.shape[1]
    found, errors = [], []
    for start in range(0, len(rows), BLOCK):
        block = rows[start : start + BLOCK]
        sums, bound, done = np.zeros((len(block), len(entries)), rows.dtype), None, 0
        while True:
            for k in range(done, min(done + STEP, size)):
                difference = block[:, k, None] - entries[None, :, k]
                difference *= difference
                sums += difference
            done += STEP
            lead = entries[sums.argmin(1)] - block
            whole = (lead * lead).sum(1)
            bound = whole if bound is None else np.minimum(bound, whole)
            left = sums <= bound[:, None]
            if done >= size or left.sum() < FEW * left.size:
                break
        row, entry = np.nonzero(left)
        sums = sums[row, entry]
        for k in range(done, size, STEP):
            difference = block[row, k : k + STEP] - entries[entry, k : k + STEP]
            sums = sums + (difference * difference).sum(1)
            left = sums <= bound[row]
            row, entry, sums = row[left], entry[left], sums[left]
        first = np.flatnonzero(np.diff(row, prepend=-1))
        least = np.minimum.reduceat(sums, first)
        equal = np.flatnonzero(sums == least[row])
        best = equal[np.flatnonzero(np.diff(row[equal], prepend=-1))]
        found.append(entry[best])
        errors.append(least // size)
    return np.concatenate(found), np.concatenate(errors)


class Codec:
    """Integer vectors of ``width`` components in ``PARTS`` parts; ``wide`` if 64 bits can't hold the distances."""

    def __init__(self, width: int, largest: float) -> None:
        self.width = PARTS * max(1, -(-width // PARTS))
        self.part = self.width // PARTS
        # size**2 * 4 * limit**2 stays below 2**63
        self.wide = SCALE * largest + 1 >= (1 << 30) // padded_size(self.part)
        self.limbs = -(-(int(SCALE * largest).bit_length() + 2) // LIMB) if self.wide else 1

    def integers(self, vectors: pa.Array) -> np.ndarray:
        """``rows x parts x components`` as exact integers."""
        scaled = np.floor(matrix(vectors, self.width) * SCALE)
        shape = (len(vectors), PARTS, self.part)
        if self.wide:
            return np.array([int(x) for x in scaled.reshape(-1)], dtype=object).reshape(shape)
        return scaled.astype(np.int64).reshape(shape)

    def split(self, sums: np.ndarray) -> list[int]:
        """Integers as limbs that 64-bit columns can add up."""
        if not self.wide:
            return sums.tolist()
        low = [[(int(v) >> (LIMB * k)) & ((1 << LIMB) - 1) for v in sums] for k in range(self.limbs - 1)]
        return [x for limb in [*low, [int(v) >> (LIMB * (self.limbs - 1)) for v in sums]] for x in limb]

    def joined(self, limbs: list[int]) -> list[int]:
        return [sum(limbs[k * self.part + i] << (LIMB * k) for k in range(self.limbs)) for i in range(self.part)]


def kept_rows(vectors: DataFrame) -> DataFrame:
    return vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"), "label").where(
        is_finite(F.col("embedding"))
    )


def train(kept: DataFrame, codec: Codec) -> np.ndarray:
    """Codebooks ``parts x entries x components`` after ``ROUNDS`` rounds over all rows.

    The driver holds the codebooks only. Tasks add up the parts of each entry,
    Spark adds up the tasks; a round returns at most ``PARTS * ENTRIES`` rows.
    """
    first = kept.orderBy(F.col("vec_id").asc_nulls_last(), "embedding").limit(ENTRIES).select("embedding").toArrow()
    books = codec.integers(first.column(0).combine_chunks()).transpose(1, 0, 2).copy()
    names = [f"s{k}" for k in range(codec.part * codec.limbs)]

    for _ in range(ROUNDS):
        current = books

        def sums(batches: Iterator[pa.RecordBatch], books: np.ndarray = current) -> Iterator[pa.RecordBatch]:
            coded = [transformed(book) for book in books]
            total, counts = np.zeros_like(books), np.zeros(books.shape[:2], np.int64)
            for batch in batches:
                rows = codec.integers(batch.column(0))
                for part in range(PARTS):
                    entry, _ = nearest(transformed(rows[:, part]), coded[part])
                    np.add.at(total[part], entry, rows[:, part])
                    counts[part] += np.bincount(entry, minlength=len(coded[part]))
            part, entry = np.nonzero(counts)
            if len(part):
                split = [codec.split(total[p, e]) for p, e in zip(part, entry, strict=True)]
                columns = [part, entry, counts[part, entry], *map(list, zip(*split, strict=True))]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["part", "entry", "n", *names])

        schema = ", ".join(f"{name} long" for name in ["part", "entry", "n", *names])
        found = (
            kept.select("embedding").mapInArrow(sums, schema)
            .groupBy("part", "entry").agg(F.sum("n").alias("n"), *[F.sum(x).alias(x) for x in names])
        )
        books = books.copy()
        for part, entry, n, *limbs in found.collect():
            books[part, entry] = [s // n for s in codec.joined(limbs)]
    return books


def encode(vectors: DataFrame) -> DataFrame:
    """``vec_id, code, error, label_error, codebooks_sha256`` of ``vectors (vec_id, embedding, label)``.

    Rows whose vector is NULL, or holds NULL or a component that isn't finite, are
    left out. Components become ``floor(1024 * x)``, vectors ``PARTS`` equal parts;
    a vector shorter than the longest counts as ending in zeros, and so does a length
    that isn't a multiple of ``PARTS``. Codebooks start from the rows with the smallest ids (NULL
    ids last, equal ids by vector) and are refined by integer k-means over all rows. ``code`` has the
    nearest entry of each part in hex, ``error`` the squared distances added up (NULL beyond
    64 bits), ``label_error`` the errors of all rows of the label, NULL being a label. Repeated
    rows each count. An empty table gives an empty result. Other columns are ignored.
    """
    spark = vectors.sparkSession
    ship_package(spark)
    kind = vectors.schema["vec_id"].dataType.simpleString()
    kept = kept_rows(vectors)
    size = F.max(F.size("embedding")).alias("width")
    # NULL for rows of empty vectors only
    largest = F.max(F.array_max(F.transform("embedding", F.abs))).alias("largest")
    width, largest = kept.agg(size, largest).first()
    schema = f"vec_id {kind}, code string, error long, label_error long, codebooks_sha256 string"
    if width is None:
        return spark.createDataFrame([], schema)
    codec = Codec(width, largest or 0.0)
    books = train(kept, codec)
    digest = hashlib.sha256(",".join(str(x) for x in books.reshape(-1)).encode()).hexdigest()

    def codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coded = [transformed(book) for book in books]
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = codec.integers(batch.column(2))
            found = [nearest(transformed(rows[:, part]), coded[part]) for part in range(PARTS)]
            code = [bytes(c).hex() for c in np.stack([f[0] for f in found], axis=1).astype(np.uint8)]
            errors = sum(f[1] for f in found)
            if codec.wide:
                errors = [int(e) if e < 1 << 63 else None for e in errors]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(code), pa.array(errors, pa.int64())],
                names=["vec_id", "label", "code", "error"],
            )

    key = nullable_key(F.col("label")).alias("label")
    coded = kept.select("vec_id", key, "embedding").mapInArrow(codes, f"vec_id {kind}, label string, code string, error long")
    # a label may hold most rows: its total is joined in SPREAD places
    total = F.sum(F.col("error").cast("decimal(38,0)")).cast("long")
    totals = coded.groupBy("label").agg(F.when(F.count("error") == F.count("*"), total).alias("label_error"))
    totals = totals.withColumn("place", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))))
    place = F.pmod(F.xxhash64("vec_id", "code"), F.lit(SPREAD)).cast("int").alias("place")
    return (
        coded.select("*", place)
        .join(totals, ["label", "place"])
        .select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
    )


def oracle() -> str:
    """DuckDB SQL for ``encode`` over ``embeddings`` with a length that ``PARTS`` divides."""
    rounds = []
    for k in range(ROUNDS + 1):
        rounds.append(f"""
    pair{k} as materialized (
      select p.vec_id, p.row, p.part, b.entry,
             list_sum(list_transform(list_zip(p.xs, b.xs), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::bigint as d
      from parts p join book{k} b using (part)),
    near{k} as materialized (
      select row, vec_id, part, min(d) as d, arg_min(entry, d * {ENTRIES} + entry) as entry
      from pair{k} group by row, vec_id, part)""")
        if k < ROUNDS:
            rounds.append(f"""
    sums{k} as (
      select n.part, n.entry, c.pos, sum(c.x)::bigint as s, count(*) as n
      from near{k} n join cells c using (row, part) group by n.part, n.entry, c.pos),
    means{k} as (
      select part, entry, list((s - ((s % n) + n) % n) // n order by pos) as xs from sums{k} group by part, entry),
    book{k + 1} as materialized (
      select part, entry, coalesce(m.xs, b.xs) as xs from book{k} b left join means{k} m using (part, entry))""")
    return f"""
    with kept as materialized (
      select vec_id, label, row_number() over (order by vec_id) - 1 as row,
             list_transform(embedding, lambda x: floor(x::double * {SCALE})::bigint) as v
      from embeddings
      where embedding is not null
        and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = len(embedding)),
    parts as materialized (
      select row, vec_id, part, v[part * (len(v) // {PARTS}) + 1 : (part + 1) * (len(v) // {PARTS})] as xs
      from kept, generate_series(0, {PARTS - 1}) g(part)),
    cells as materialized (
      select row, part, unnest(xs) as x, unnest(generate_series(1, len(xs))) as pos from parts),
    book0 as materialized (select part, row as entry, xs from parts where row < {ENTRIES}),
    {",".join(rounds)},
    digest as (
      select sha256(string_agg(array_to_string(xs, ','), ',' order by part, entry)) as codebooks_sha256
      from book{ROUNDS}),
    coded as (
      select row, vec_id, string_agg(printf('%02x', entry::int), '' order by part) as code, sum(d)::bigint as error
      from near{ROUNDS} group by row, vec_id)
    select c.vec_id, code, error, (sum(error) over (partition by label))::bigint as label_error, codebooks_sha256
    from coded c join kept using (row), digest
    """
