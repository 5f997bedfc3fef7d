"""Near-duplicate documents by SetSketch registers, banded, estimated and verified."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txsieve.llm.components import connected_components
from txsieve.session import materialize, ship_package

SHINGLE = 5
#: A character of a word: any but the ASCII white space.
WORD = r"[^\x20\x09-\x0D]"
#: Documents are linked from this similarity on: 100 * intersection >= 75 * union.
PERCENT = 75
#: Registers that make a band, and bands. A pair at the threshold shares no band
#: with probability (1 - 0.75**3)**24 = 2e-6, more similar ones with less.
BAND = 3
BANDS = 24
REGISTERS = BAND * BANDS
#: Base of the exponential spacing and largest register value.
BASE = 1.001
TOP = 65534
#: Pairs are dropped unverified only if the threshold is this much less likely (log) than the best estimate.
DOUBT = 12.5
#: Buckets up to this size are compared pair by pair; larger ones by hubs, then by the pairs that remain possible.
SMALL = 16
HUB_ROUNDS = 2
#: Ratio of the sizes of a size class.
SIZE_CLASS = 1.03
#: Bits of the bitmap of a set in a large bucket.
BITMAP = 2048

_MULTIPLIERS = np.random.default_rng(12).integers(1, 2**31, REGISTERS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_STARTS = np.random.default_rng(13).integers(0, 2**32, REGISTERS, dtype=np.uint32)


def tokens(text: bytes) -> list[bytes]:
    """Lower-cased (A-Z) words; white space is the ASCII white space."""
    return text.lower().split()


def shingles(text: bytes) -> set[tuple[bytes, ...]]:
    """Distinct five-word shingles; a shorter text is one shingle, a text without words none."""
    words = tokens(text)
    if len(words) < SHINGLE:
        return {tuple(words)} if words else set()
    return set(zip(*[words[i:] for i in range(SHINGLE)], strict=False))


class ShingleHasher:
    """64-bit hashes of the distinct shingles of a text; word hashes are kept in a bounded cache."""

    def __init__(self, limit: int = 200_000) -> None:
        self.limit, self.cache = limit, {}

    def __call__(self, text: bytes) -> np.ndarray:
        words = tokens(text)
        if not words:
            return np.zeros(0, np.uint64)
        cache, hashed = self.cache, []
        for word in words:
            h = cache.get(word)
            if h is None:
                if len(cache) >= self.limit:
                    cache.clear()
                h = cache[word] = xxhash.xxh3_64_intdigest(word)
            hashed.append(h)
        w = np.array(hashed, dtype=np.uint64)
        if len(w) < SHINGLE:
            w = np.concatenate([w, np.full(SHINGLE - len(w), len(w), np.uint64)])
        n = len(w) - SHINGLE + 1
        h = w[:n].copy()
        for i in range(1, SHINGLE):
            h *= np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
            h += w[i : n + i]
        h *= np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(32)
        return np.unique(h)


def registers(hashes: np.ndarray) -> np.ndarray:
    """SetSketch registers of a set of hashes.

    Register i is floor(1 - log_b of the smallest exponential variate of the set),
    cut to 0 and ``TOP``. Variates fall with a uniform hash, so one minimum per
    register is taken before the logarithm. The sketch of a union is the maximum.
    """
    low = hashes.astype(np.uint32) ^ (hashes >> np.uint64(32)).astype(np.uint32)
    least = np.full(REGISTERS, 2**32 - 1, np.uint32)
    for at in range(0, len(low), 2048):
        mixed = low[None, at : at + 2048] * _MULTIPLIERS[:, None] + _STARTS[:, None]
        mixed ^= mixed >> np.uint32(15)
        mixed *= np.uint32(0x2C1B3C6D)
        mixed ^= mixed >> np.uint32(13)
        least = np.minimum(least, mixed.min(axis=1))
    variate = -np.log1p(-(least.astype(np.float64) + 0.5) / 2.0**32)
    # spacing starts at variates of about 10, of sets of one shingle
    return np.clip(np.floor(1 - np.log(variate / 10.0) / np.log(BASE)), 0, TOP).astype("<u2")


def likely(first: np.ndarray, second: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """True where sets with these registers (rows) and sizes may be ``PERCENT`` similar.

    The counts of registers that are larger, smaller and equal have a joint
    likelihood for each similarity J (SetSketch paper, with known sizes). A pair is
    out only if no J from the threshold on comes within ``DOUBT`` of the best one.
    """
    larger = (first > second).sum(axis=1)[:, None]
    smaller = (first < second).sum(axis=1)[:, None]
    equal = first.shape[1] - larger - smaller
    u = (n / (n + m))[:, None]
    v = 1 - u
    j = np.concatenate([np.linspace(0, 0.74, 38), np.linspace(PERCENT / 100, 1, 26)])[None]
    j = np.minimum(j, np.minimum(u / v, v / u))  # no larger similarity is possible

    def p(x: np.ndarray) -> np.ndarray:
        return -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE)

    above, below = p(u - v * j), p(v - u * j)
    tiny = 1e-9
    fit = (
        larger * np.log(np.maximum(above, tiny))
        + smaller * np.log(np.maximum(below, tiny))
        + equal * np.log(np.maximum(1 - above - below, tiny))
    )
    enough = j >= PERCENT / 100 - 1e-12
    best = np.where(enough, fit, -np.inf).max(axis=1)
    return best >= fit.max(axis=1) - DOUBT


def sketch(docs: DataFrame) -> DataFrame:
    """``doc_id, node, n_shingles, registers`` per row; ``node`` is the same for equal texts."""
    ship_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = ShingleHasher()
        for batch in batches:
            sizes, sketches = [], []
            for value in batch.column(2):
                text = value.as_buffer().to_pybytes() if value.is_valid else b""
                hashes = hasher(text)
                sizes.append(len(hashes))
                sketches.append(registers(hashes).tobytes() if len(hashes) else b"")
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(sketches, pa.binary())],
                names=["doc_id", "node", "n_shingles", "registers"],
            )

    keyed = docs.select("doc_id", node_of(F.col("text")).alias("node"), "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return keyed.mapInArrow(run, f"doc_id {kind}, node binary, n_shingles long, registers binary")


def node_of(text: Column) -> Column:
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))


def bands(nodes: DataFrame) -> DataFrame:
    """``key, node, n``: one row per band of each node."""
    width = 2 * BAND
    keys = F.transform(
        F.sequence(F.lit(0), F.lit(BANDS - 1)),
        lambda b: F.xxhash64(b, F.substring(F.col("registers"), b * width + 1, F.lit(width))),
    )
    return nodes.select(F.explode(keys).alias("key"), "node", F.col("n_shingles").alias("n"))


def small_pairs(members: DataFrame, buckets: DataFrame) -> DataFrame:
    """``a, b``: every pair of the buckets of up to ``SMALL`` members."""
    two = buckets.where("size = 2").select(F.col("first.node").alias("a"), F.col("last.node").alias("b"))
    few = buckets.where(F.col("size").between(3, SMALL)).select("key")
    pairs = (
        members.join(few, "key")
        .groupBy("key")
        .agg(F.sort_array(F.collect_list("node")).alias("each"))
        .select(F.posexplode("each").alias("i", "a"), "each")
        .select("a", F.explode(F.slice("each", F.col("i") + 2, F.lit(SMALL))).alias("b"))
    )
    return two.union(pairs).distinct()


def lonely_shingles(nodes: DataFrame, texts: DataFrame) -> DataFrame:
    """``node, own``: how many shingles of each node no other node of ``nodes`` has."""
    ship_package(nodes.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = ShingleHasher()
        for batch in batches:
            for node, text in zip(batch.column(0), batch.column(1), strict=True):
                hashes = hasher(text.as_buffer().to_pybytes()).view(np.int64)
                names = pa.array([node.as_py()] * len(hashes), pa.binary())
                yield pa.RecordBatch.from_arrays([names, pa.array(hashes)], names=["node", "shingle"])

    found = texts.join(nodes.select("node"), "node", "left_semi").select("node", "text")
    return (
        found.mapInArrow(run, "node binary, shingle long")
        .groupBy("shingle")
        .agg(F.count(F.lit(1)).alias("times"), F.min("node").alias("node"))
        .where("times = 1")
        .groupBy("node")
        .agg(F.count(F.lit(1)).alias("own"))
    )


def bitmaps(nodes: DataFrame, texts: DataFrame) -> DataFrame:
    """``node, bits``: one bit per hash value of its shingles modulo ``BITMAP``, as an array of longs."""
    ship_package(nodes.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = ShingleHasher()
        for batch in batches:
            rows = []
            for text in batch.column(1):
                bits = np.zeros(BITMAP, np.uint8)
                bits[hasher(text.as_buffer().to_pybytes()) % np.uint64(BITMAP)] = 1
                rows.append(np.packbits(bits).view("<i8").tolist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(rows, pa.list_(pa.int64()))], names=["node", "bits"]
            )

    found = texts.join(nodes.select("node"), "node", "left_semi").select("node", "text")
    return found.mapInArrow(run, "node binary, bits array<long>")


def close_bitmaps(x: str, y: str) -> Column:
    """True unless the bitmaps prove that the sets differ too much.

    Each bit that is set in one of them stands for a shingle that the other set lacks, and
    linked sets of n and m shingles differ in (n + m) / 7 of them at most.
    """
    apart = F.aggregate(
        F.zip_with(f"bits_{x}", f"bits_{y}", lambda a, b: F.bit_count(a.bitwiseXOR(b))),
        F.lit(0),
        lambda total, n: total + n,
    )
    return 7 * apart <= F.col(f"n_{x}") + F.col(f"n_{y}")


def possible(x: str, y: str) -> Column:
    """True where two sets can be linked, by their sizes and by what others can share with them."""
    least = 75 * (F.col(f"n_{x}") + F.col(f"n_{y}"))
    return (175 * F.col(f"shared_{x}") >= least) & (175 * F.col(f"shared_{y}") >= least)


def hub_pairs(members: DataFrame, hubs: DataFrame) -> DataFrame:
    """``a, b``: the hub of each bucket with every member that it can be linked with."""
    return (
        members.select(
            "key", F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("shared").alias("shared_b"), "label"
        )
        .join(
            hubs.select(
                "key",
                F.col("hub.node").alias("a"),
                F.col("hub.n").alias("n_a"),
                F.col("hub.shared").alias("shared_a"),
                F.col("hub.label").alias("hub_label"),
            ),
            "key",
        )
        .where((F.col("label") != F.col("hub_label")) & possible("a", "b"))
        .select("a", "b")
        .distinct()
    )


def rest_pairs(members: DataFrame, hubs: DataFrame) -> DataFrame:
    """``a, b``: all pairs of a bucket that may still connect components.

    One side is outside the component of the bucket's first hub. Sizes are classed, and a
    set meets only the classes that it can be linked with: most sets of a group of
    near copies have shingles of their own, which rules out all of similar size. Bitmaps
    of the shingles rule out nearly all of the other pairs.
    """
    outside = (
        members.join(hubs.select("key", F.col("hub.label").alias("hub_label")), "key")
        .where(F.col("label") != F.col("hub_label"))
        .select(
            "key",
            F.col("node").alias("a"),
            F.col("n").alias("n_a"),
            F.col("shared").alias("shared_a"),
            F.col("label").alias("label_a"),
            F.col("bits").alias("bits_a"),
        )
    )
    classed = lambda n: F.floor(F.log(n) / F.lit(float(np.log(SIZE_CLASS)))).cast("int")
    least = F.greatest(F.lit(1.0), F.col("n_a") * 0.75)
    most = F.least(F.col("n_a") / 0.75, F.col("shared_a") * 175 / 75 - F.col("n_a"))
    ranged = outside.where(most >= least).withColumn(
        "class", F.explode(F.sequence(classed(least) - 1, classed(most) + 1))
    )
    others = members.select(
        "key",
        F.col("node").alias("b"),
        F.col("n").alias("n_b"),
        F.col("shared").alias("shared_b"),
        F.col("label").alias("label_b"),
        F.col("bits").alias("bits_b"),
        classed(F.col("n").cast("double")).alias("class"),
    )
    # All conditions are part of the join, which so puts out only pairs that pass.
    return (
        ranged.join(others, ["key", "class"])
        .where((F.col("label_a") != F.col("label_b")) & possible("a", "b") & close_bitmaps("a", "b"))
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct()
    )


def estimated(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs whose registers allow a link."""
    ship_package(pairs.sparkSession)
    side = nodes.select("node", F.col("n_shingles").alias("n"), "registers")
    both = pairs.join(
        side.select(F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("registers").alias("r_a")), "a"
    ).join(side.select(F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("registers").alias("r_b")), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            get = lambda name: batch.column(batch.schema.get_field_index(name))
            first, second = (
                np.frombuffer(b"".join(get(x).to_pylist()), "<u2").reshape(-1, REGISTERS) for x in ("r_a", "r_b")
            )
            ok = likely(first, second, get("n_a").to_numpy(), get("n_b").to_numpy())
            yield pa.RecordBatch.from_arrays([get("a"), get("b")], names=["a", "b"]).filter(pa.array(ok))

    return both.mapInArrow(run, "a binary, b binary")


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """``a, b`` of the pairs that are similar enough by their whole texts."""
    ship_package(pairs.sparkSession)
    both = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a").join(
        texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, sets = [None, None], [set(), set()]
        for batch in batches:
            get = lambda name: batch.column(batch.schema.get_field_index(name))
            linked = []
            for row in zip(get("a").to_pylist(), get("b").to_pylist(), get("text_a"), get("text_b"), strict=True):
                for side in (0, 1):
                    if row[side] != last[side]:
                        last[side], sets[side] = row[side], shingles(row[2 + side].as_buffer().to_pybytes())
                shared = len(sets[0] & sets[1])
                linked.append(100 * shared >= PERCENT * (len(sets[0]) + len(sets[1]) - shared))
            yield pa.RecordBatch.from_arrays([get("a"), get("b")], names=["a", "b"]).filter(pa.array(linked, pa.bool_()))

    return both.mapInArrow(run, "a binary, b binary")


def find_links(nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """``a, b``: links that connect what all links would connect.

    Small buckets give every pair. A large bucket is first compared with hubs, the
    members with the least shingles of their own, as a group of near copies
    mostly hangs together through its original. What hubs leave apart is compared
    pair by pair where sizes and shared shingles allow a link at all.
    """
    members = bands(nodes)
    me = F.struct("node", "n")
    buckets = materialize(
        members.groupBy("key")
        .agg(F.count(F.lit(1)).alias("size"), F.min(me).alias("first"), F.max(me).alias("last"))
        .where("size > 1"),
        "buckets",
    )
    pairs = materialize(estimated(small_pairs(members, buckets), nodes), "pairs")
    wide = materialize(
        members.join(buckets.where(F.col("size") > SMALL).select("key"), "key"), "wide"
    )
    in_wide = wide.select("node").distinct()
    texts = texts_of(pairs.select(F.col("a").alias("node")).union(pairs.select("b")).union(in_wide), nodes, docs)
    links = materialize(verified(pairs, texts), "links")
    if not wide.head(1):
        return links
    own = lonely_shingles(in_wide, texts)
    members = materialize(
        wide.join(bitmaps(in_wide, texts), "node")
        .join(own, "node", "left")
        .withColumn("shared", F.col("n") - F.coalesce("own", F.lit(0)))
        .where(4 * F.col("shared") >= 3 * F.col("n"))
        .drop("own"),
        "members",
    )
    first_hubs = None
    for _ in range(HUB_ROUNDS):
        labelled = materialize(with_labels(members, links), "labelled")
        central = F.struct(
            (F.lit(1.0) - F.col("shared") / F.col("n")).alias("alone"), "node", "n", "shared", "label"
        )
        if first_hubs is None:
            candidates = labelled
        else:
            done = first_hubs.select("key", F.col("hub.node").alias("node")).join(
                labelled.select("key", "node", F.col("label").alias("done")), ["key", "node"]
            )
            candidates = labelled.join(done.select("key", "done"), "key").where("label != done")
        hubs = candidates.groupBy("key").agg(F.min(central).alias("hub"))
        hubs = materialize(hubs, "hubs")
        first_hubs = hubs if first_hubs is None else first_hubs
        found = materialize(verified(hub_pairs(labelled, hubs), texts), "links")
        links = links.union(found)
    labelled = materialize(with_labels(members, links), "labelled")
    hubs = first_hubs.select("key", F.col("hub.node").alias("node")).join(
        labelled, ["key", "node"]
    ).select("key", F.struct("label").alias("hub"))
    rest = materialize(estimated(rest_pairs(labelled, hubs), nodes), "pairs")
    return links.union(materialize(verified(rest, texts), "links"))


def with_labels(members: DataFrame, links: DataFrame) -> DataFrame:
    labels = connected_components(links)
    return members.drop("label").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs (doc_id, text)``.

    Equal texts are one node of the graph. Nodes that share a band of registers are
    candidates; the joint likelihood of their registers drops what is clearly
    below the threshold, whole shingle sets decide about the others. Rows without
    words are linked with nothing; NULL text is such a row. Rows with NULL id take
    the component of their text, whose id is the smallest that isn't NULL; they are
    kept only if there is none. Repeated rows get equal rows. Other columns are ignored.
    """
    sketched, of_node = grouped(docs)
    smallest = of_node.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    components = of_node.join(smallest, "label").select("node", "component_id")
    return (
        sketched.select("doc_id", "node", "n_shingles")
        .join(components, "node", "left")
        .withColumn("component_id", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")))
        .select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))
    )


def grouped(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Sketches of all rows, and ``node, doc_id, label`` of the texts with words.

    ``doc_id`` is the smallest of the text; ``label`` tells components apart even if they share an id or have none.
    """
    docs = docs.select("doc_id", "text")
    sketched = materialize(sketch(docs), "sketches")
    nodes = materialize(
        sketched.where("n_shingles > 0")
        .groupBy("node")
        .agg(
            F.any_value("n_shingles").alias("n_shingles"),
            F.any_value("registers").alias("registers"),
            F.min("doc_id").alias("doc_id"),
        ),
        "nodes",
    )
    labels = connected_components(find_links(nodes, docs))
    of_node = nodes.select("node", "doc_id").join(labels, "node", "left").withColumn(
        "label", F.coalesce("label", "node")
    )
    return sketched, of_node


def texts_of(wanted: DataFrame, nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """``node, text`` of the nodes in ``wanted``, each read from its document with the smallest id."""
    used = (
        wanted.distinct()
        .join(nodes.select("node", "doc_id"), "node")
        .select(F.col("node").alias("wanted"), F.col("doc_id").alias("at"))
    )
    found = docs.withColumn("node", node_of(F.col("text"))).join(
        used, F.col("doc_id").eqNullSafe(F.col("at")) & (F.col("node") == F.col("wanted"))
    )
    return materialize(found.groupBy("node").agg(F.first("text").alias("text")), "texts")


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of each group of near copies: that with the smallest id, then the smallest text node.

    NULL comes after all ids. Groups are told apart by their texts, so rows that share an id, or have none,
    each stand for their own group. Rows without words all stay.
    """
    of_node = grouped(docs)[1]
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "node"))
    kept = of_node.groupBy("label").agg(first.alias("first")).select(
        F.col("first.node").alias("kept_node"), F.col("first.doc_id").alias("kept_id")
    )
    has_words = F.coalesce(F.col("text"), F.lit("")).rlike(WORD)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    with_words = (
        docs.where(has_words)
        .select(row, "doc_id", node_of(F.col("text")).alias("node"))
        .join(kept, (F.col("node") == F.col("kept_node")) & F.col("doc_id").eqNullSafe(F.col("kept_id")))
        .groupBy("node")
        .agg(F.first("row").alias("row"))
        .select("row.*")
    )
    return with_words.union(docs.where(~has_words))
