"""Language identification with a byte convolutional network."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txsieve.session import materialize, ship_package

#: Bytes of a window, the network's input; shorter texts are padded with zeros.
WINDOW = 256
#: Bytes that a filter sees, and filters of each width.
WIDTHS = (2, 3, 4)
FILTERS = 16
#: Bound of the training sample: labelled rows per language, and windows of each row.
TRAIN_ROWS = 400
TRAIN_WINDOWS = 4
#: With more languages each gets as much less, one row at least; every one is learned.
FULL_LANGUAGES = 200
EPOCHS = 10
BATCH = 64
SEED = 7
#: Windows that are put through the network at a time.
CHUNK = 64
UNKNOWN = "und"
MIN_SCORE = 0.5


@dataclass(frozen=True)
class ByteNetwork:
    """Filters of several widths over one-hot bytes, max pooling, one softmax layer."""

    languages: list[str]
    filters: list[np.ndarray]  # per width: (width, 256, FILTERS)
    bias: np.ndarray
    weights: np.ndarray  # (features, languages)
    offset: np.ndarray

    def pairs(self) -> list[list[np.ndarray]]:
        """Per width the responses to pairs of bytes, so that a filter needs half the look-ups."""
        tables = []
        for f in self.filters:
            parts = []
            for j in range(0, len(f) - 1, 2):
                parts.append(np.ascontiguousarray((f[j][:, None] + f[j + 1][None]).reshape(-1, f.shape[2])))
            if len(f) % 2:
                parts.append(np.ascontiguousarray(f[-1]))
            tables.append(parts)
        return tables

    def pooled(self, windows: np.ndarray, tables: list[list[np.ndarray]]) -> np.ndarray:
        """Largest response of each filter in each row of ``windows`` (n x WINDOW bytes)."""
        n, length = windows.shape
        # positions lead, so that look-ups and maxima run over contiguous rows
        single = np.ascontiguousarray(windows.T).astype(np.intp)
        pair = single[:-1] * 256 + single[1:]
        out = []
        for f, parts in zip(self.filters, tables, strict=True):
            span = length - len(f) + 1
            total = None
            for k, part in enumerate(parts):
                at = pair if len(part) > 256 else single
                got = np.take(part, at[2 * k : 2 * k + span].reshape(-1), axis=0, mode="clip")
                total = got if total is None else np.add(total, got, out=total)
            out.append(_largest(total.reshape(span, n * FILTERS)).reshape(n, FILTERS))
        return np.maximum(np.concatenate(out, axis=1) + self.bias, 0)

    def probabilities(self, windows: np.ndarray, tables: list[list[np.ndarray]]) -> np.ndarray:
        return softmax(self.pooled(windows, tables) @ self.weights + self.offset)


def _largest(rows: np.ndarray) -> np.ndarray:
    """Column maxima, by halving; overwrites ``rows``."""
    n = len(rows)
    while n > 1:
        half = n // 2
        np.maximum(rows[:half], rows[n - half : n], out=rows[:half])
        n -= half
    return rows[0]


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def windows_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All windows of the texts, the text each belongs to, and its bytes without padding.

    Windows follow each other without gap or overlap and cover each text whole.
    """
    lengths = np.array([len(t) for t in texts], dtype=np.int64)
    counts = np.maximum(1, -(-lengths // WINDOW))
    flat = np.frombuffer(b"".join(t + b"\0" * (c * WINDOW - len(t)) for t, c in zip(texts, counts.tolist(), strict=True)), np.uint8)
    owner = np.repeat(np.arange(len(texts)), counts)
    used = np.full(len(owner), WINDOW, dtype=np.int64)
    last = np.cumsum(counts) - 1
    used[last] = lengths - (counts - 1) * WINDOW
    return flat.reshape(-1, WINDOW), owner, used


def train_network(texts: list[bytes], labels: list[str]) -> ByteNetwork:
    """Fits the network by stochastic gradient descent (Adam); the same rows give the same network.

    Besides whole windows it sees shortened ones, so that short texts are known too.
    """
    random = np.random.default_rng(SEED)
    languages = sorted(set(labels))
    index = {x: i for i, x in enumerate(languages)}
    rows, owner, used = windows_of(texts)
    truth = np.array([index[x] for x in labels])[owner]
    short = rows.copy()
    keep = random.integers(8, WINDOW, len(short))
    short[np.arange(WINDOW)[None] >= keep[:, None]] = 0
    x = np.concatenate([rows[used > 0], short[used > 0]])
    y = np.concatenate([truth[used > 0], truth[used > 0]])
    features = FILTERS * len(WIDTHS)
    parameters = [
        *[random.normal(0, 0.3, (w, 256, FILTERS)).astype(np.float32) for w in WIDTHS],
        np.zeros(features, np.float32),
        random.normal(0, 0.2, (features, len(languages))).astype(np.float32),
        np.zeros(len(languages), np.float32),
    ]
    for p in parameters[: len(WIDTHS)]:
        p[:, 0] = 0  # padding
    first = [np.zeros_like(p) for p in parameters]
    second = [np.zeros_like(p) for p in parameters]
    step = 0
    for epoch in range(EPOCHS):
        rate = 0.01 * (1 - epoch / EPOCHS)
        order = random.permutation(len(x))
        for at in range(0, len(order), BATCH):
            chosen = order[at : at + BATCH]
            gradients = _gradients(parameters, x[chosen], y[chosen])
            step += 1
            for p, g, m, v in zip(parameters, gradients, first, second, strict=True):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-6)
    k = len(WIDTHS)
    return ByteNetwork(languages, parameters[:k], parameters[k], parameters[k + 1], parameters[k + 2])


def _gradients(parameters: list[np.ndarray], x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
    k, n = len(WIDTHS), len(x)
    bias, weights, offset = parameters[k:]
    rows, columns = np.arange(n)[:, None], np.arange(FILTERS)[None]
    pooled, where = [], []
    for f in parameters[:k]:
        span = WINDOW - len(f) + 1
        total = f[0][x[:, :span]]
        for j in range(1, len(f)):
            total += f[j][x[:, j : j + span]]
        best = total.argmax(axis=1)
        where.append(best)
        pooled.append(total[rows, best, columns])
    raw = np.concatenate(pooled, axis=1) + bias
    hidden = np.maximum(raw, 0)
    slope = softmax(hidden @ weights + offset)
    slope[np.arange(n), y] -= 1
    slope /= n
    back = (slope @ weights.T) * (raw > 0)
    gradients = []
    for i, f in enumerate(parameters[:k]):
        g = np.zeros_like(f)
        part = back[:, i * FILTERS : (i + 1) * FILTERS]
        for j in range(len(f)):
            np.add.at(g[j], (x[rows, where[i] + j], columns), part)
        g[:, 0] = 0
        gradients.append(g)
    return [*gradients, back.sum(axis=0), hidden.T @ slope, slope.sum(axis=0)]


def held_out() -> Column:
    """True for documents that are never learned from; NULL ids count as ``''``."""
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(4)) == 2


def training_sample(docs: DataFrame) -> list[tuple[str, bytes]]:
    """At most ``TRAIN_ROWS`` rows of each language, fewer where there are more than ``FULL_LANGUAGES``,
    and a few windows of each row.

    Rows are chosen by a hash of id and text below a share that follows from exact
    counts, then the smallest hashes of each language, windows spread over the whole text, so no
    order or size matters, nor whether ids are NULL or repeated.
    """
    chosen = F.xxhash64(F.lit(SEED), "doc_id", "text").alias("order")
    step = F.floor(F.octet_length("text") / TRAIN_WINDOWS).cast("int")
    pieces = F.transform(
        F.sequence(F.lit(0), F.lit(TRAIN_WINDOWS - 1)),
        lambda i: F.substring(F.col("text").cast("binary"), i * step + 1, F.lit(WINDOW)),
    )
    labelled = docs.where(~held_out() & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    counted = labelled.select("lang", chosen).groupBy("lang")
    counts = materialize(counted.agg(F.count(F.lit(1)).alias("rows"), F.min("order").alias("least")), "languages")
    languages = counts.count()
    if not languages:
        return []
    rows = max(1, min(TRAIN_ROWS, TRAIN_ROWS * FULL_LANGUAGES // languages))
    # about a tenth more than needed and some to spare, of which the smallest hashes are taken
    share = F.least(F.lit(1.0), (1.1 * rows + 20) / F.col("rows")).alias("share")
    found = (
        labelled.select("lang", chosen, pieces.alias("pieces"))
        .join(counts.select("lang", "least", share), "lang")
        .where((F.pmod("order", F.lit(2**31)) < F.col("share") * 2**31) | (F.col("order") == F.col("least")))
        .groupBy("lang", "order")  # equal rows are one
        .agg(F.min("pieces").alias("pieces"))
        .withColumn("place", F.row_number().over(Window.partitionBy("lang").orderBy("order")))
        .where(F.col("place") <= rows)
        .collect()
    )
    return sorted({(row["lang"], bytes(piece)) for row in found for piece in row["pieces"] if piece})


def fit(docs: DataFrame) -> ByteNetwork | None:
    sample = training_sample(docs)
    return train_network([b for _, b in sample], [x for x, _ in sample]) if sample else None


def classify(docs: DataFrame, network: ByteNetwork | None) -> DataFrame:
    """Adds ``lang_pred`` and ``score`` to ``docs``; only the text decides.

    The mean of the window probabilities, weighted by the bytes of each window,
    is the score. NULL texts, texts without a letter, and all texts when no
    language was learned are ``und`` with score 0.
    """
    ship_package(docs.sparkSession)
    columns = [F.col(f"`{c}`") for c in docs.columns]
    letters = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    source = docs.select(F.struct(*columns).alias("row"), F.col("text"), letters.alias("letters"))
    if network is None:
        return source.select("row.*", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = network.pairs()
        for batch in batches:
            texts = batch.column(1).cast(pa.binary()) if batch.num_rows else batch.column(1)
            names, scores = [], []
            for at in range(0, batch.num_rows, 256):
                part = [x if x is not None else b"" for x in texts[at : at + 256].to_pylist()]
                n, s = _decide(network, tables, part)
                names += n
                scores += s
            known = batch.column(2).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([n if k else UNKNOWN for n, k in zip(names, known, strict=True)], pa.string()),
                    pa.array([s if k else 0.0 for s, k in zip(scores, known, strict=True)], pa.float64()),
                ],
                names=["row", "lang_pred", "score"],
            )

    schema = f"row {source.schema['row'].dataType.simpleString()}, lang_pred string, score double"
    return source.mapInArrow(predict, schema).select("row.*", "lang_pred", "score")


def _decide(network: ByteNetwork, tables: list[list[np.ndarray]], texts: list[bytes]) -> tuple[list[str], list[float]]:
    """The windows of ``texts`` go through the network ``CHUNK`` at a time, so a long text needs no more memory."""
    windows, owner, used = windows_of(texts)
    total = np.zeros((len(texts), len(network.languages)))
    weight = np.maximum(used, 1)
    for at in range(0, len(windows), CHUNK):
        p = network.probabilities(windows[at : at + CHUNK], tables) * weight[at : at + CHUNK, None]
        np.add.at(total, owner[at : at + CHUNK], p)
    total /= np.bincount(owner, weight, len(texts))[:, None]
    best = total.argmax(axis=1)
    scores = np.minimum(1.0, total[np.arange(len(texts)), best])
    return [network.languages[i] for i in best], scores.tolist()


def identify(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` for every row of ``docs`` (``doc_id, text, lang``).

    Learns from labelled rows that are not held out. Repeated rows are judged
    alike; a NULL id counts as '' where rows are held out. An empty table gives an empty
    result. Other columns are ignored.
    """
    used = docs.select("doc_id", "text", "lang")
    network = fit(used)
    return classify(used.select("doc_id", "text", held_out().alias("held_out")), network).select(
        "doc_id", "held_out", "lang_pred", "score"
    )


def keep_identified(docs: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose language is identified with a score of ``MIN_SCORE`` or more.

    If nothing could be learned, there is no verdict and every row stays. Rows with NULL text, or without a letter,
    are not identified; repeated rows and rows with NULL ids are each judged by their text. An empty table gives an empty result.
    """
    network = fit(docs.select("doc_id", "text", "lang"))
    if network is None:
        return docs
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    judged = classify(docs.select(row, F.col("text")), network)
    return judged.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= MIN_SCORE)).select("row.*")
