"""Alignment of two tokenizers' tokens by pointer jumping."""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txsieve.llm.tokens import CACHE, LONGEST, TextEncoder, encoder, pack_ids, plain_pieces
from txsieve.session import materialize, ship_package

A_FILE = "byte_bpe_50k.json"
B_FILE = "piece_bpe_32k.model"
#: Characters that are aligned at once, and of a segment that a longer text is cut into.
BATCH = 1 << 20
SEGMENT = 1 << 18
#: Documents that leave a task together, and links they hold together.
ROWS = 2048
LINKS = 1 << 20
#: Pairs of ids whose counts travel to every task, 17 bytes each: those with the largest counts. The others are joined.
COMMON = 1 << 20
#: Counts are told apart by steps of 2 ** (1 / STEPS) when COMMON is applied.
STEPS = 8
_SPACE = "▁"


def letters() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for."""
    return {letter: byte for byte, letter in enumerate(TextEncoder._letters())}


class Vocabularies:
    """Both tokenizers with the bytes of their tokens."""

    def __init__(self) -> None:
        self.a = encoder(A_FILE, special=False)
        self.b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(B_FILE))
        byte_of, size = letters(), self.a.tokenizer.get_vocab_size()
        entries = [self.a.tokenizer.id_to_token(i) for i in range(size)]
        self.a_bytes = [bytes(byte_of[c] for c in e) if all(c in byte_of for c in e) else e.encode() for e in entries]
        self.b_bytes = [self._piece(i) for i in range(self.b.get_piece_size())]
        self.a_lengths, self.a_text, self.a_starts = self._flat(self.a_bytes)
        self.b_lengths, self.b_text, self.b_starts = self._flat(self.b_bytes)
        numbers = max(len(self.a_bytes), len(self.b_bytes))
        #: Each id with each mark that may follow it: the next token, the other side, the next group.
        self.written = [b"%d%c" % (i, mark) for i in range(numbers) for mark in b",|;"]
        self.new: dict[str, tuple[bytes, bytes]] = {}
        self.old: dict[str, tuple[bytes, bytes]] = {}

    def _piece(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace(_SPACE, " ").encode()

    @staticmethod
    def _flat(entries: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        lengths = np.array([len(x) for x in entries])
        return lengths, np.frombuffer(b"".join(entries), np.uint8), np.cumsum(lengths) - lengths

    def spells(self, ids: np.ndarray, side: str, raw: np.ndarray) -> np.ndarray:
        """Which bytes of ``raw`` the tokens, as long as ``raw`` together, spell."""
        lengths, text, starts = (getattr(self, f"{side}_{x}") for x in ("lengths", "text", "starts"))
        n = lengths[ids]
        return text[np.repeat(starts[ids] - np.cumsum(n) + n, n) + np.arange(len(raw))] == raw

    def encode(self, segments: list[str]) -> list[tuple[bytes, bytes]]:
        """Ids of a space and each segment, of A and of B, which adds the space itself.

        A token of B holds a space at its front only, and a line end is a token of its own, so pieces are
        cut as for A. What isn't remembered of a batch is encoded at once.
        """
        cuts = [plain_pieces(" " + s) for s in segments]
        known = {"": (b"", b"")}
        missing = []
        for piece in set(itertools.chain.from_iterable(c for c in cuts if c)) - {""}:
            found = self.new.get(piece)
            if found is None:
                found = self.old.get(piece)
                if found is None:
                    missing.append(piece)
                    continue
                self.new[piece] = found
            known[piece] = found
        # B adds a space to what begins with a line end, too
        for piece, b in zip(missing, self.b.encode([p.removeprefix(" ") for p in missing]) if missing else [], strict=True):
            known[piece] = self.a.pieces[piece], pack_ids(b if piece[0] == " " else b[1:])
        self.new.update((p, known[p]) for p in missing if len(p) <= LONGEST)
        if len(self.new) > CACHE // 2:
            self.old, self.new = self.new, {}
        result = []
        for segment, cut in zip(segments, cuts, strict=True):
            if cut:
                found = [known[p] for p in cut]
                result.append((b"".join([f[0] for f in found]), b"".join([f[1] for f in found])))
            else:
                result.append((self.a.packed(" " + segment), pack_ids(self.b.encode(segment))))
        return result


_vocabularies: list[Vocabularies] = []


def vocabularies() -> Vocabularies:
    """Those of this worker process, kept from task to task."""
    if not _vocabularies:
        _vocabularies.append(Vocabularies())
    return _vocabularies[0]


def segments(text: str) -> Iterator[str]:
    """``text`` in pieces that begin after a space between two characters that aren't white space.

    No token of either tokenizer goes over the front of such a space, and both read
    a piece as if the space stood before it. A text without such spaces stays whole.
    """
    while len(text) > SEGMENT:
        at = text.find(" ", SEGMENT)
        while at > 0 and (text[at - 1].isspace() or text[at + 1 : at + 2].isspace() or at + 1 == len(text)):
            at = text.find(" ", at + 1)
        if at < 0:
            break
        yield text[:at]
        text = text[at + 1 :]
    yield text


def below(ends: np.ndarray) -> np.ndarray:
    """How many of the ascending ``ends`` lie below each number up to the last end and one more."""
    return np.cumsum(np.bincount(ends + 1))


def terminals(a_ends: np.ndarray, b_ends: np.ndarray) -> np.ndarray:
    """The terminal token of the component of each token, first those of A, then those of B.

    Each token points to the farthest-right token that overlaps it: the one of the other side that holds its last
    byte. Where both end there, A's points to B's, which points to itself. Doubling the steps until nothing changes
    takes every token to the last one of its component.
    """
    n = len(a_ends)
    of_a = n + below(b_ends)[a_ends]
    holder = below(a_ends)[b_ends]
    own = n + np.arange(len(b_ends))
    next_ = np.concatenate([of_a, np.where(a_ends[holder] > b_ends, holder, own)])
    while True:
        further = next_[next_]
        if (further == next_).all():
            return next_
        next_ = further


def overlaps(a_ends: np.ndarray, b_ends: np.ndarray, a_lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of all overlapping tokens: of A ascending, and of B."""
    ended = below(b_ends)
    first = ended[a_ends - a_lengths + 1]
    n = ended[a_ends] - first + 1
    a = np.repeat(np.arange(len(a_ends)), n)
    return a, np.arange(len(a)) - np.repeat(np.cumsum(n) - n, n) + first[a]


class Document:
    """What is known of a document whose segments are being aligned."""

    def __init__(self, values: tuple) -> None:
        self.values, self.fits = values, True
        self.digest, self.n_a, self.n_b, self.n_groups, self.n_links = hashlib.sha256(), 0, 0, 0, 0
        self.pairs: list[tuple[np.ndarray, np.ndarray]] = []

    def row(self) -> tuple:
        if not self.fits or not self.n_a:
            return (*self.values, 0, 0, 0, 0, "", np.empty(0, np.int64), np.empty(0, np.int64))
        keys, times = self.pairs[0]
        if len(self.pairs) > 1:
            keys, inverse = np.unique(np.concatenate([k for k, _ in self.pairs]), return_inverse=True)
            times = np.bincount(inverse, np.concatenate([t for _, t in self.pairs])).astype(np.int64)
        return (*self.values, self.n_a, self.n_b, self.n_groups, self.n_links, self.digest.hexdigest(), keys, times)


class Aligner:
    """Aligns segments of many documents at once."""

    def __init__(self) -> None:
        self.v = vocabularies()
        self.held: list[tuple[Document, str]] = []
        self.size = 0

    def add(self, document: Document, text: str) -> None:
        for segment in segments(text):
            self.held.append((document, segment))
            self.size += len(segment)
            if self.size >= BATCH:
                self.align()

    def align(self) -> None:
        """All that is held. The documents' bytes follow each other, so their ends are ends of groups too."""
        if not self.held:
            return
        v, raws = self.v, [b" " + s.encode() for _, s in self.held]
        sizes = np.array([len(r) for r in raws])
        ids = [[np.frombuffer(x, "<u4").astype(np.int64) for x in pair] for pair in v.encode([s for _, s in self.held])]
        spelled = [v.a_lengths[a].sum() == n and v.b_lengths[b].sum() == n for (a, b), n in zip(ids, sizes, strict=True)]
        chosen = np.flatnonzero(spelled)
        if len(chosen):
            raw = np.frombuffer(b"".join([raws[k] for k in chosen]), np.uint8)
            a, b = (np.concatenate([ids[k][side] for k in chosen]) for side in (0, 1))
            same = v.spells(a, "a", raw) & v.spells(b, "b", raw)
            starts = np.cumsum(sizes[chosen]) - sizes[chosen]
            chosen = chosen[np.logical_and.reduceat(same, starts)]
        chosen = set(chosen.tolist())
        for k, (document, _) in enumerate(self.held):
            document.fits &= k in chosen
        parts = [(self.held[k][0], *ids[k]) for k in sorted(chosen) if self.held[k][0].fits]
        self.held, self.size = [], 0
        if parts:
            self._count(*map(list, zip(*parts, strict=True)))

    def _count(self, documents: list[Document], a_parts: list[np.ndarray], b_parts: list[np.ndarray]) -> None:
        a_ids, b_ids = np.concatenate(a_parts), np.concatenate(b_parts)
        a_lengths = self.v.a_lengths[a_ids]
        a_ends, b_ends = np.cumsum(a_lengths), np.cumsum(self.v.b_lengths[b_ids])
        n, last = len(a_ids), terminals(a_ends, b_ends)
        # a terminal is the last B token of its group, so terminals ascend with the groups
        terminal = np.zeros(len(b_ids), bool)
        terminal[last - n] = True
        group = (np.cumsum(terminal) - terminal)[last - n]
        a_of, b_of = (np.repeat(np.arange(len(documents)), [len(p) for p in parts]) for parts in (a_parts, b_parts))

        # tokens in the order they are written: groups, A before B
        of_group = [np.cumsum(np.bincount(g)) for g in (group[:n], group[n:])]
        order = np.empty(len(group), np.int64)
        order[np.arange(n) + np.concatenate([[0], of_group[1]])[group[:n]]] = np.arange(n)
        order[np.arange(len(b_ids)) + of_group[0][group[n:]]] = np.arange(n, len(group))
        side, at = order >= n, group[order]
        mark = np.ones(len(order), np.int64)  # the other side follows
        mark[:-1][(at[1:] == at[:-1]) & (side[1:] == side[:-1])] = 0
        mark[side & (mark == 1)] = 2
        written = list(map(self.v.written.__getitem__, (np.concatenate([a_ids, b_ids])[order] * 3 + mark).tolist()))
        ends = np.cumsum(np.bincount(np.concatenate([a_of, b_of]), minlength=len(documents))).tolist()

        a, b = overlaps(a_ends, b_ends, a_lengths)
        of = a_of[a]
        keys, times = np.unique(of << 32 | a_ids[a] << 16 | b_ids[b], return_counts=True)
        cuts = np.searchsorted(keys >> 32, np.arange(1, len(documents)))
        groups = np.bincount(b_of[terminal], minlength=len(documents)).tolist()
        links = np.bincount(of, minlength=len(documents)).tolist()
        start = 0
        for k, (document, key, time) in enumerate(
            zip(documents, np.split(keys & 0xFFFFFFFF, cuts), np.split(times, cuts), strict=True)
        ):
            text = b"".join(written[start : ends[k]])[:-1]
            start = ends[k]
            document.digest.update(b";" + text if document.n_a else text)
            document.n_a += len(a_parts[k])
            document.n_b += len(b_parts[k])
            document.n_groups += groups[k]
            document.n_links += links[k]
            document.pairs.append((key, time))


_COLUMNS = ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "keys", "times"]


def _lists(parts: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *[len(p) for p in parts]])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(parts), pa.int64()))


def aligned(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs (row, doc_id, text)``: counts, digest, and each linked pair of ids with its links.

    A pair is one number: A's id times 65,536 plus B's. A task holds a batch of text and
    a bounded number of rows besides its longest document.
    """
    ship_package(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, waiting, held = Aligner(), [], 0
        id_type = pa.int64()

        def flushed() -> pa.RecordBatch:
            aligner.align()
            columns = list(zip(*[d.row() for d in waiting], strict=True))
            types = [pa.int64(), id_type, *[pa.int64()] * 4, pa.string()]
            arrays = [pa.array(c, t) for c, t in zip(columns[:-2], types, strict=True)]
            return pa.RecordBatch.from_arrays([*arrays, *map(_lists, columns[-2:])], names=_COLUMNS)

        for batch in batches:
            id_type = batch.schema.field(1).type
            for row, doc_id, text in zip(*batch.columns, strict=True):
                document = Document((row.as_py(), doc_id.as_py()))
                waiting.append(document)
                content = text.as_py()
                if content:
                    held += len(content)
                    aligner.add(document, content)
                if len(waiting) >= ROWS or held >= LINKS:
                    yield flushed()
                    waiting, held = [], 0
        if waiting:
            yield flushed()

    schema = (
        f"row long, doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
        "keys array<long>, times array<long>"
    )
    return docs.select("row", "doc_id", "text").mapInArrow(run, schema)


def pair_counts(found: DataFrame) -> DataFrame:
    """``key, n, best``: how many rows of ``found`` hold the pair, and whether no pair of its A id is in more."""
    counts = materialize(found.select(F.explode("keys").alias("key")).groupBy("key").agg(F.count("*").alias("n")), "pairs")
    a = F.shiftright("key", 16).alias("a")
    # one row per id of A's vocabulary at most
    most = F.broadcast(counts.groupBy(a).agg(F.max("n").alias("most")))
    return counts.withColumn("a", a).join(most, "a").select("key", "n", (F.col("n") == F.col("most")).alias("best"))


def common_pairs(counts: DataFrame) -> tuple[pa.Table, int]:
    """The pairs from the least count on from which at most ``COMMON`` pairs are left, and that count."""
    step = F.ceil(F.log2("n") * STEPS).cast("int").alias("step")
    steps = sorted(counts.groupBy(step).agg(F.count("*"), F.min("n")).collect(), reverse=True)
    taken, least = 0, None
    for _, pairs, smallest in steps:
        taken += pairs
        if taken > COMMON:
            break
        least = smallest
    if least is None:
        return pa.table({"key": pa.array([], pa.int64()), "n": pa.array([], pa.int64()), "best": pa.array([], pa.bool_())}), 1 << 62
    return counts.where(F.col("n") >= least).toArrow().combine_chunks(), least


def align(docs: DataFrame) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` for every row of ``docs (doc_id, text)``.

    A reads the text behind a space, B puts it there itself; groups end where tokens of both end,
    links are all overlapping tokens. A pair of ids counts the rows of the table that
    hold it linked; ``n_best`` counts links with the highest count of their A id, ``count_sum`` adds up the counts
    of all links. NULL and empty texts, and texts that the tokens of either side don't
    spell byte for byte, have no tokens: zeros and an empty digest. Rows count one by one, also
    with equal or NULL ids. An empty table gives an empty result. Other columns are ignored.
    """
    spark = docs.sparkSession
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    found = materialize(aligned(rows), "aligned")
    counts = materialize(pair_counts(found), "counts")
    table, least = common_pairs(counts)
    by_key = np.argsort(table.column("key").to_numpy())
    columns = [table.column(c).to_numpy()[by_key] for c in ("key", "n", "best")]
    known = spark.sparkContext.broadcast(columns)

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, n, best = known.value
        for batch in batches:
            if not batch.num_rows:
                continue
            lengths = batch.column("keys").value_lengths().to_numpy(zero_copy_only=False)
            own, times = (batch.column(c).flatten().to_numpy() for c in ("keys", "times"))
            row = np.repeat(np.arange(batch.num_rows), lengths)
            place = np.minimum(np.searchsorted(keys, own), max(0, len(keys) - 1))
            hit = keys[place] == own if len(keys) else np.zeros(len(own), bool)
            sums = np.zeros((2, batch.num_rows), np.int64)
            for total, weight in zip(sums, (best, n), strict=True):
                np.add.at(total, row[hit], times[hit] * weight[place[hit]])
            rest = np.concatenate([[0], np.cumsum(np.bincount(row[~hit], minlength=batch.num_rows))])
            left = [pa.ListArray.from_arrays(pa.array(rest, pa.int32()), pa.array(x[~hit])) for x in (own, times)]
            columns = [batch.column("row"), pa.array(sums[0]), pa.array(sums[1]), *left]
            yield pa.RecordBatch.from_arrays(columns, ["row", "n_best", "count_sum", "keys", "times"])

    schema = "row long, n_best long, count_sum long, keys array<long>, times array<long>"
    looked = materialize(found.select("row", "keys", "times").mapInArrow(look_up, schema), "looked")
    # rare pairs: no key has more rows than the count below which they lie
    link = F.explode(F.arrays_zip("keys", "times")).alias("link")
    rare = looked.select("row", link).select("row", F.col("link.keys").alias("key"), F.col("link.times").alias("times"))
    summed = (
        rare.join(counts.where(F.col("n") < least), "key")
        .groupBy("row")
        .agg(
            F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
            F.sum(F.col("times") * F.col("n")).alias("count_sum"),
        )
    )
    sums = looked.select("row", "n_best", "count_sum").union(summed).groupBy("row").agg(
        F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum")
    )
    return found.drop("keys", "times").join(sums, "row").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"
    )
