"""Packing of token ids into sequences of several lengths."""

from __future__ import annotations

from bisect import bisect_right, insort
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txsieve.llm.tokens import encoder
from txsieve.session import ship_package

TOKENIZER = "word_bpe_49k.json"
END = 1
#: Context sizes, each a power of two; a document goes to the smallest that holds it.
TIERS = (256, 512, 1024, 2048)
LONGEST = TIERS[-1]
#: The last tokens of a task fill powers of two down to this; the rest is padded.
SHORTEST_TAIL = 64
#: Tokens that wait in a task before they are packed.
POOL = 128 * LONGEST
#: Tokens of a step group; all its sequences have the same length.
STEP = 16 * LONGEST
FLUSH_PIECES = 4096
_COLUMNS = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset", "sequence_tokens", "step_group"]


class Packer:
    """Packs the documents of one task as they come.

    Whole windows of ``LONGEST`` tokens leave a long document at once. What
    remains waits in its tier. Windows of the longest tier are filled first: a
    long piece, then the largest shorter pieces that fit, at last a cut piece, so a
    window is full. What is left of the shorter tiers makes shorter windows likewise.
    Memory is bound by ``POOL`` and one document.
    """

    def __init__(self, task: int) -> None:
        self.base = task << 32
        self.sequences, self.groups = 0, 0
        self.open_groups: dict[int, tuple[int, int]] = {}
        # (length, arrival, document, start, ids, tokens of the document), ascending
        self.waiting: dict[int, list[tuple]] = {t: [] for t in TIERS}
        self.held, self.arrivals = 0, 0
        self.rows: list[tuple] = []

    def add(self, doc_id: object, packed: bytes) -> None:
        tokens, start = len(packed) // 4, 0
        while tokens - start >= LONGEST:
            piece = (LONGEST, 0, doc_id, start, packed[4 * start : 4 * (start + LONGEST)], tokens)
            self._close([piece], LONGEST)
            start += LONGEST
        if start < tokens:
            self._wait(doc_id, start, packed[4 * start :], tokens)
        if self.held >= POOL:
            self._pack()

    def finish(self) -> None:
        self._pack()
        rest = [p for t in reversed(TIERS) for p in reversed(self.waiting[t])]
        self.waiting, self.held = {t: [] for t in TIERS}, 0
        left = sum(p[0] for p in rest)
        size = LONGEST
        while left:
            while size > left and size > SHORTEST_TAIL:
                size //= 2
            taken, rest = self._take(rest, min(size, left))
            left -= min(size, left)
            filled = sum(p[0] for p in taken)
            self._close(taken, filled if filled & (filled - 1) == 0 else LONGEST)

    def _wait(self, doc_id: object, start: int, packed: bytes, tokens: int) -> None:
        n = len(packed) // 4
        self.arrivals += 1
        insort(
            self.waiting[next(t for t in TIERS if n <= t)],
            (n, self.arrivals, doc_id, start, packed, tokens),
            key=lambda p: p[:2],
        )
        self.held += n

    @staticmethod
    def _take(pieces: list[tuple], n: int) -> tuple[list[tuple], list[tuple]]:
        """The first ``n`` tokens of ``pieces`` and the rest, with a piece cut in two if need be."""
        taken, k = [], 0
        while n:
            length, arrival, doc_id, start, packed, tokens = pieces[k]
            if length <= n:
                taken.append(pieces[k])
                n -= length
                k += 1
            else:
                taken.append((n, arrival, doc_id, start, packed[: 4 * n], tokens))
                cut = (length - n, arrival, doc_id, start + n, packed[4 * n :], tokens)
                return taken, [cut, *pieces[k + 1 :]]
        return taken, pieces[k:]

    def _pack(self) -> None:
        for size in reversed(TIERS):
            own = self.waiting[size]
            while own and self.held >= size:
                chosen = [own.pop()]
                gap = size - chosen[0][0]
                self.held -= chosen[0][0]
                while gap:
                    piece = self._largest(gap) or self._cut(gap)
                    chosen.append(piece)
                    gap -= piece[0]
                self._close(chosen, size)

    def _largest(self, gap: int) -> tuple | None:
        for t in reversed(TIERS):
            fits = bisect_right(self.waiting[t], gap, key=lambda p: p[0])
            if fits:
                piece = self.waiting[t].pop(fits - 1)
                self.held -= piece[0]
                return piece
        return None

    def _cut(self, gap: int) -> tuple:
        """``gap`` tokens off the smallest waiting piece; all are longer."""
        source = next(self.waiting[t] for t in TIERS if self.waiting[t])
        length, arrival, doc_id, start, packed, tokens = source.pop(0)
        self.held -= length
        self._wait(doc_id, start + gap, packed[4 * gap :], tokens)
        return gap, arrival, doc_id, start, packed[: 4 * gap], tokens

    def _close(self, pieces: list[tuple], size: int) -> None:
        group, filled = self.open_groups.get(size, (None, STEP))
        if filled + size > STEP:
            group, filled = self.base + self.groups, 0
            self.groups += 1
        self.open_groups[size] = (group, filled + size)
        offset, sequence = 0, self.base + self.sequences
        self.sequences += 1
        for length, _, doc_id, start, packed, tokens in pieces:
            self.rows.append((doc_id, start, length, packed, tokens, sequence, offset, size, group))
            offset += length


def pack(docs: DataFrame) -> DataFrame:
    """One row per piece of a document of ``docs (doc_id, text)`` with its ids and its place.

    Columns: ``doc_id, start, length, ids`` (little-endian unsigned 32-bit),
    ``doc_tokens, sequence_id, offset, sequence_tokens`` (length with padding),
    ``step_group``. Every id lies in exactly one piece. Each task packs its own
    documents; nothing is shuffled, and a task adds at most one padded sequence.

    NULL text is an empty document, of the end id alone. Repeated rows are
    packed as often as they come; NULL ids stay NULL. An empty table gives an
    empty result. Other columns are ignored.
    """
    ship_package(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(TOKENIZER)
        end = END.to_bytes(4, "little")
        packer = Packer(TaskContext.get().partitionId())
        id_type = None

        def flushed() -> pa.RecordBatch:
            columns = list(zip(*packer.rows, strict=True)) or [()] * len(_COLUMNS)
            packer.rows = []
            types = [id_type, pa.int64(), pa.int64(), pa.binary(), *[pa.int64()] * 5]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=_COLUMNS)

        for batch in batches:
            id_type = batch.schema.field(0).type
            for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
                packer.add(doc_id.as_py(), encode.packed(text.as_py() or "") + end)
                if len(packer.rows) >= FLUSH_PIECES:
                    yield flushed()
        packer.finish()
        if packer.rows:
            yield flushed()

    schema = (
        f"doc_id {kind}, start long, length long, ids binary, doc_tokens long, sequence_id long, "
        "offset long, sequence_tokens long, step_group long"
    )
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def pack_digest(docs: DataFrame) -> DataFrame:
    """The pieces of ``pack`` with a checksum in place of their ids."""
    return pack(docs).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset",
        "sequence_tokens", "step_group",
    )
