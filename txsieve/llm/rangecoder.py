"""Files of token ids, compressed by an adaptive context-mixing range coder.

A block holds up to ``BLOCK`` ids and starts from a reset model, so blocks are coded
independently and a damaged one spoils no other. Its ids are cut into up to ``STREAMS``
equal runs, each coded into words of its own, which share the model of the block:
numpy codes the runs of many blocks in step, one array element each. The model learns
after 8, 16, 32, ... ids of every run, from all runs at once, and stands still between.

For each id there are three predictions: the id last seen after the same two ids (order
2), after the same id (order 1), and counts of all ids on top of a prior that falls with the
id (order 0). A first symbol says whether one of the two guesses is right; its probability mixes
counts of two contexts, none and the confidence and agreement of the guesses. If both
are wrong, the id follows by its order-0 count.

The coder is a carry-less range coder with 64-bit state and 16-bit output words.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txsieve.llm.tokens import encoder
from txsieve.session import ship_package

TOKENIZER = "byte_bpe_50k.json"
END = 2
#: Ids of a block, and the ids that there are.
BLOCK = 65536
IDS = 65536
#: Runs of a block that are coded in step, and the least ids worth a run.
STREAMS, LEAST_RUN = 128, 128
#: Blocks that are coded in step.
LANES = 48
#: Ids of a segment, the row of a file; a longer document makes a longer segment.
SEGMENT = 8 * BLOCK
#: Words in each of the two generations that a worker remembers.
WORDS = 500_000
#: Bytes of text that are encoded together.
CHUNK = 2**22
MAGIC = b"TXRD"

_KIND, _LITERAL = 12, 24  # bits of the probability of a kind, and of an id of order 0
_TOTAL = np.uint64(_KIND + _LITERAL)
_LITERAL_BITS = np.uint64(_LITERAL)
_SHIFT, _TOP = np.uint64(16), np.uint64(48)
_LEAST = np.uint64(2**48)
_REST = np.uint64(2**48 - 1)
_MIX1, _MIX2 = np.int32(0x1E3779B1), np.int32(0x05EBCA6B)
#: An id that was seen weighs this much more each time than the prior of the last ids.
_GAIN = 512
_PRIOR = (2**16 // (np.arange(IDS) + 64) + 1).astype(np.int32)
_CONTEXTS = 32
#: The decoder looks an id up by these leading bits of its place; where ids share them it searches.
_LEAD = 14
_EXACT = 2**_LITERAL - IDS
_FOLLOWING = np.arange(1, IDS + 1, dtype=np.int32)


def _boundaries(steps: int) -> list[int]:
    """Steps after which the model learns, up to ``steps``."""
    marks = [0]
    while marks[-1] < steps:
        marks.append(min(steps, max(8, 2 * marks[-1])))
    return marks


def _scaled(counts: np.ndarray) -> np.ndarray:
    """The end of each id, of 2 ** _LITERAL."""
    ends = counts * np.int32(_GAIN)
    ends += _PRIOR
    np.cumsum(ends, out=ends)
    scaled = (ends * (_EXACT / float(ends[-1]))).astype(np.int32)
    scaled += _FOLLOWING
    return scaled


_FRESH = _scaled(np.zeros(IDS, np.int32))


class _Model:
    """Tables of all blocks, one behind the other. They learn and freeze block by block, so that those of one stay at hand."""

    def __init__(self, blocks: int) -> None:
        self.counts = np.zeros((blocks, IDS), np.int32)
        self.first = np.zeros(blocks * IDS, np.int32)  # id * 4 + confidence
        self.second = np.zeros(blocks * IDS, np.int32)
        self.kinds = np.zeros((blocks, _CONTEXTS, 3), np.int32)
        self.bounds = np.zeros((blocks, _CONTEXTS, 4), np.int64)
        # the end of each id; the ids of a block lie after those of the blocks before
        self.ends = np.zeros((blocks, IDS), np.int32)
        self.lead = np.zeros((blocks << _LEAD) + 1, np.int32)
        self.lead[-1] = blocks * IDS - 1

    def freeze(self, block: int, fresh: np.ndarray | None = None) -> None:
        """Intervals of the kinds and of the ids by what the block has learned so far. ``fresh`` are the ends if that is nothing."""
        np.add(_scaled(self.counts[block]) if fresh is None else fresh, np.int32(block << _LITERAL), out=self.ends[block])
        kinds = self.kinds[block]
        every = kinds.sum(axis=0)
        every = 64 * every // max(1, every.sum())
        upto = np.cumsum(4 * kinds + every + [1, 1, 2], axis=1)
        share = upto * (4093 / upto[:, -1:].astype(np.float64))
        self.bounds[block, :, 1:] = share.astype(np.int64) + [1, 2, 3]

    def starts(self, block: int) -> None:
        """For the decoder: the first id of each lead of the block."""
        ends = self.ends[block] - np.int32((block << _LITERAL) + 1)
        ends >>= np.int32(_LITERAL - _LEAD)
        before = np.cumsum(np.bincount(ends, minlength=1 << _LEAD))
        at = block << _LEAD
        self.lead[at] = block * IDS
        self.lead[at + 1 : at + (1 << _LEAD)] = before[:-1] + block * IDS

    def guesses(self, base: np.ndarray | int, place: np.ndarray | int, previous: np.ndarray, earlier: np.ndarray) -> tuple[np.ndarray, ...]:
        """Places and entries of both orders, and the context of the kind. ``base`` and ``place`` are where a block's tables begin."""
        at1 = previous + base
        at2 = previous * _MIX2
        at2 += earlier * _MIX1
        at2 >>= 12
        at2 &= np.int32(IDS - 1)
        at2 += base
        e1, e2 = self.first.take(at1), self.second.take(at2)
        context = (e2 & 3) << 3
        context += (e1 & 3) << 1
        context += (e1 ^ e2) < 4
        context += place
        return at1, at2, e1, e2, context

    def find(self, sought: np.ndarray) -> np.ndarray:
        """The ids, with their blocks, whose intervals hold the places."""
        at = sought >> np.int32(_LITERAL - _LEAD)
        found, upto = self.lead.take(at), self.lead.take(at + 1)
        several = np.flatnonzero(found != upto)
        if len(several):
            place, here, end = sought[several], found[several], upto[several]
            ends = self.ends.reshape(-1)
            for _ in range(int((end - here).max()).bit_length()):
                middle = (here + end) >> 1
                behind = ends.take(middle, mode="clip") <= place
                here = np.where(behind, middle + 1, here)
                end = np.where(behind, end, middle)
            found[several] = np.minimum(here, len(ends) - 1)
        return found

    def learn(self, block: int, ids: np.ndarray, guesses: tuple[np.ndarray, ...], kind: np.ndarray) -> None:
        """Learns ``ids`` (runs x steps) of a block that were coded since the last time, with what was guessed."""
        at1, at2, e1, e2, context = guesses
        seen = np.bincount((context * 3 + kind).reshape(-1) - block * _CONTEXTS * 3, minlength=_CONTEXTS * 3)
        self.kinds[block] += seen.reshape(_CONTEXTS, 3).astype(np.int32)
        np.add.at(self.counts[block], ids.reshape(-1), np.int32(1))
        for table, at, entry in ((self.first, at1, e1), (self.second, at2, e2)):
            right = (entry >> 2) == ids
            table[at.reshape(-1)] = np.where(
                right, entry + ((entry & 3) < 3), np.where((entry & 3) > 0, entry - 1, (ids << 2))
            ).reshape(-1)


def _kind(ids: np.ndarray, e1: np.ndarray, e2: np.ndarray) -> np.ndarray:
    """0 and 1 for a right guess of order 2 and 1, else 2."""
    return np.where((e2 >> 2) == ids, 0, np.where((e1 >> 2) == ids, 1, 2)).astype(np.int32)


def _shape(n: int) -> tuple[int, int]:
    """Runs of a block of ``n`` ids and the ids of a run."""
    runs = max(1, min(STREAMS, n // LEAST_RUN))
    return runs, -(-n // runs)


def _lanes(sizes: list[int]) -> tuple[list[int], np.ndarray, np.ndarray]:
    """Order of the blocks, longest runs first; the block and the steps of each lane."""
    order = sorted(range(len(sizes)), key=lambda i: -_shape(sizes[i])[1])
    shapes = [_shape(sizes[i]) for i in order]
    runs = np.array([s[0] for s in shapes], np.int64)
    return order, np.repeat(np.arange(len(order)), runs), np.repeat(np.array([s[1] for s in shapes], np.int64), runs)


def _history(ids: np.ndarray, a: int, b: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ids of steps ``a`` to ``b``, and the one and two before; two columns lead."""
    return ids[:, a + 2 : b + 2], ids[:, a + 1 : b + 1], ids[:, a:b]


def _intervals(ids: np.ndarray, begin: np.ndarray, width: np.ndarray) -> None:
    """Puts begin and width of the ids of a block (runs x steps), of 2 ** (_KIND + _LITERAL), into arrays by step and run."""
    model = _Model(1)
    marks = _boundaries(ids.shape[1] - 2)
    for a, b in zip(marks, marks[1:], strict=False):
        model.freeze(0, None if a else _FRESH)
        x, previous, earlier = _history(ids, a, b)
        guesses = model.guesses(np.int32(0), np.int32(0), previous, earlier)
        kind = _kind(x, guesses[2], guesses[3])
        at = (guesses[4] << 2) + kind
        bounds, ends = model.bounds.reshape(-1), model.ends.reshape(-1)
        low = bounds.take(at)
        share = bounds.take(at + 1) - low
        start = np.where(x > 0, ends.take(x - 1, mode="wrap"), 0)
        literal = kind == 2
        begin[a:b] = ((low << _LITERAL) + np.where(literal, start, 0) * share).T
        width[a:b] = (np.where(literal, ends.take(x) - start, 1 << _LITERAL) * share).T
        if b < marks[-1]:
            model.learn(0, x, guesses, kind)


def encode_blocks(blocks: list[np.ndarray]) -> list[bytes]:
    """Coded bytes of each block: ids, words and checksum of the ids, the words of each run, then the words."""
    if not blocks:
        return []
    order, block, steps = _lanes([len(b) for b in blocks])
    lanes, most = len(block), int(steps[0])
    begin, width = np.empty((most, lanes), np.uint64), np.empty((most, lanes), np.uint64)
    at = 0
    for i in order:
        runs, length = _shape(len(blocks[i]))
        padded = np.zeros(runs * length, np.int32)
        padded[: len(blocks[i])] = blocks[i]
        ids = np.zeros((runs, length + 2), np.int32)
        ids[:, 2:] = padded.reshape(runs, length)
        _intervals(ids, begin[:, at : at + runs], width[:, at : at + runs])
        at += runs
    low = np.zeros(lanes, np.uint64)
    span = np.full(lanes, 2**64 - 1, np.uint64)
    # one word of each run after the other
    words = np.zeros((4 * most + 4) * lanes, np.uint16)
    place = np.arange(lanes)
    for t in range(most):
        n = int(np.searchsorted(-steps, -t, side="left"))
        unit = span[:n] >> _TOTAL
        low[:n] += begin[t, :n] * unit
        unit *= width[t, :n]
        span[:n] = unit
        out = np.flatnonzero(unit < _LEAST)
        while len(out):
            value, size = low[out], span[out]
            at = place[out]
            words[at] = value >> _TOP
            place[out] = at + lanes
            size = np.minimum(size, _LEAST - (value & _REST)) << _SHIFT
            low[out], span[out] = value << _SHIFT, size
            out = out[size < _LEAST]
    words[place] = (low + _REST) >> _TOP
    written = place // lanes + 1
    by_run = np.ascontiguousarray(words.reshape(-1, lanes)[: int(written.max())].T).astype("<u2", copy=False)
    coded: list[bytes] = [b""] * len(order)
    at = 0
    for i in order:
        runs, _ = _shape(len(blocks[i]))
        sizes = written[at : at + runs]
        data = b"".join([by_run[at + k, : sizes[k]].tobytes() for k in range(runs)])
        checksum = zlib.crc32(blocks[i].astype("<u4").tobytes())
        coded[i] = struct.pack("<III", len(blocks[i]), len(data) // 2, checksum) + sizes.astype("<u2").tobytes() + data
        at += runs
    return coded


def decode_blocks(coded: list[bytes]) -> list[np.ndarray]:
    """Ids of the blocks; a block whose checksum differs is an error."""
    if not coded:
        return []
    heads = [struct.unpack_from("<III", c) for c in coded]
    order, block, steps = _lanes([h[0] for h in heads])
    lanes, most = len(block), int(steps[0])
    sizes = [np.frombuffer(coded[i], "<u2", _shape(heads[i][0])[0], 12).astype(np.int64) for i in order]
    # all words in a row, each run behind the other; past its end a run reads what is there, which decides nothing
    data = [np.frombuffer(coded[i], "<u2", heads[i][1], 12 + 2 * len(s)) for i, s in zip(order, sizes, strict=True)]
    words = np.concatenate([*data, np.zeros(8, "<u2")])
    size = np.concatenate(sizes)
    if size.sum() + 8 != len(words):
        raise ValueError("a block of token ids is damaged")
    last = np.cumsum(size)
    read = last - size
    ids = np.zeros((most + 2, lanes), np.int32)
    model = _Model(len(order))
    bounds, ends = model.bounds.reshape(-1), model.ends.reshape(-1)
    base, place = (block * IDS).astype(np.int32), (block * _CONTEXTS).astype(np.int32)
    zeros = (block << _LITERAL).astype(np.int32)
    span = np.full(lanes, 2**64 - 1, np.uint64)
    low = np.zeros(lanes, np.uint64)
    ahead = np.zeros(lanes, np.uint64)  # how far the words lie above ``low``
    for _ in range(4):
        ahead = (ahead << _SHIFT) | np.where(read < last, words.take(read, mode="clip"), 0).astype(np.uint64)
        read += 1
    marks = _boundaries(most)
    firsts = np.searchsorted(block, np.arange(len(order) + 1))
    for a, b in zip(marks, marks[1:], strict=False):
        for k in range(len(order)):
            runs = slice(firsts[k], firsts[k + 1])
            if a and steps[runs.start] <= a:
                break
            if a:
                before = marks[marks.index(a) - 1]
                x, previous, earlier = _history(np.ascontiguousarray(ids[before : a + 2, runs].T), 0, a - before)
                guesses = model.guesses(np.int32(k * IDS), np.int32(k * _CONTEXTS), previous, earlier)
                model.learn(k, x, guesses, _kind(x, guesses[2], guesses[3]))
            model.freeze(k, None if a else _FRESH)
            model.starts(k)
        for t in range(a, b):
            n = int(np.searchsorted(-steps, -t, side="left"))
            _, _, e1, e2, at = model.guesses(base[:n], place[:n], ids[t + 1, :n], ids[t, :n])
            unit = span[:n] >> _TOTAL
            value = (ahead[:n] // unit).view(np.int64)
            at <<= 2
            share = value >> _LITERAL
            second = share >= bounds.take(at + 1)
            open_ = share >= bounds.take(at + 2)
            at += second
            at += open_
            start = bounds.take(at)
            part = bounds.take(at + 1) - start
            start <<= _LITERAL
            x = np.where(second, e1, e2) >> 2
            open_ = np.flatnonzero(open_)
            if len(open_):
                w, zero, begin = part[open_], zeros[open_], start[open_]
                # only damaged words lead beyond the last place
                sought = np.minimum((value[open_] - begin) / w, 2**_LITERAL - 1).astype(np.int32) + zero
                found = model.find(sought)
                here = found & np.int32(IDS - 1)
                x[open_] = here
                begins = np.where(here > 0, ends.take(found - 1, mode="clip"), zero)
                part <<= _LITERAL
                start[open_] = begin + (begins - zero) * w
                part[open_] = (ends.take(found) - begins) * w
            else:
                part <<= _LITERAL
            moved = start.view(np.uint64) * unit
            low[:n] += moved
            ahead[:n] -= moved
            unit *= part.view(np.uint64)
            span[:n] = unit
            out = np.flatnonzero(unit < _LEAST)
            while len(out):
                begins = low[out]
                size = np.minimum(span[out], _LEAST - (begins & _REST)) << _SHIFT
                low[out], span[out] = begins << _SHIFT, size
                r = read[out]
                # past its last word a run reads zeros
                word = words.take(r, mode="clip")
                word[r >= last[out]] = 0
                ahead[out] = (ahead[out] << _SHIFT) | word
                read[out] = r + 1
                out = out[size < _LEAST]
            ids[t + 2, :n] = x
    decoded: list[np.ndarray] = [np.zeros(0, np.uint32)] * len(order)
    for k, i in enumerate(order):
        length = _shape(heads[i][0])[1]
        found = ids[2 : length + 2, firsts[k] : firsts[k + 1]].T.reshape(-1)[: heads[i][0]].astype("<u4")
        if zlib.crc32(found.tobytes()) != heads[i][2]:
            raise ValueError("a block of token ids is damaged")
        decoded[i] = found
    return decoded


def cut(ids: np.ndarray) -> list[np.ndarray]:
    return [ids[at : at + BLOCK] for at in range(0, len(ids), BLOCK)]


def join_payload(blocks: list[bytes]) -> bytes:
    return MAGIC + struct.pack("<I", len(blocks)) + b"".join(blocks)


def split_payload(payload: bytes) -> list[bytes]:
    if payload[:4] != MAGIC:
        raise ValueError("not a segment of token ids")
    blocks, at = [], 8
    for _ in range(struct.unpack_from("<I", payload, 4)[0]):
        n, words = struct.unpack_from("<II", payload, at)
        size = 12 + 2 * _shape(n)[0] + 2 * words
        blocks.append(payload[at : at + size])
        at += size
    return blocks


def write_ids(docs: DataFrame, path: str) -> None:
    """Writes the ids of ``docs (doc_id, text)`` below ``path`` in ascending order of ``doc_id``.

    Files are written by Spark's writer, so lost tasks leave nothing behind. A file is a range
    of documents (``part`` numbers them in order); a row is a segment: its documents
    with their numbers of ids, the ids before it in the file, and the coded blocks.
    Each document ends with the id ``END``; NULL text is that id alone. NULL ids come
    first, repeated ids are ordered by text. An empty table gives files without segments.
    """
    ship_package(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(TOKENIZER, limit=WORDS)
        part = TaskContext.get().partitionId()
        segments: list[tuple[list, list[int], int, np.ndarray]] = []
        names: list = []
        counts: list[int] = []
        held: list[np.ndarray] = []
        tokens, before, waiting = 0, 0, 0

        def close() -> None:
            nonlocal names, counts, held, tokens, before, waiting
            segments.append((names, counts, before, np.concatenate(held)))
            before += tokens
            waiting += -(-tokens // BLOCK)
            names, counts, held, tokens = [], [], [], 0

        def coded() -> Iterator[pa.RecordBatch]:
            nonlocal segments, waiting
            cuts = [cut(s[3]) for s in segments]
            done = []
            flat = [b for c in cuts for b in c]
            for at in range(0, len(flat), LANES):
                done += encode_blocks(flat[at : at + LANES])
            at = 0
            for (ids, sizes, first, _), blocks in zip(segments, cuts, strict=True):
                payload = join_payload(done[at : at + len(blocks)])
                at += len(blocks)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([part], pa.int32()),
                        pa.array([first], pa.int64()),
                        pa.array([ids], pa.list_(id_type)),
                        pa.array([sizes], pa.list_(pa.int64())),
                        pa.array([payload], pa.binary()),
                    ],
                    names=["part", "first", "doc_ids", "doc_tokens", "payload"],
                )
            segments, waiting = [], 0

        for batch in batches:
            id_type = batch.schema.field(0).type
            doc_ids, texts = batch.column(0).to_pylist(), batch.column(1)
            upto = np.cumsum(pc.binary_length(texts).fill_null(0).to_numpy().astype(np.int64))
            first = 0
            while first < len(texts):
                done = int(upto[first - 1]) if first else 0
                last = max(first + 1, int(np.searchsorted(upto, done + CHUNK, side="right")))
                ids, sizes = encode.all_ids(texts[first:last])
                ids = np.insert(ids, np.cumsum(sizes), END)
                at = 0
                for doc_id, size in zip(doc_ids[first:last], (sizes + 1).tolist(), strict=True):
                    names.append(doc_id)
                    counts.append(size)
                    held.append(ids[at : at + size])
                    at += size
                    tokens += size
                    if tokens >= SEGMENT:
                        close()
                    if waiting >= LANES:
                        yield from coded()
                first = last
        if names:
            close()
        if segments:
            yield from coded()

    schema = f"part int, first long, doc_ids array<{kind}>, doc_tokens array<long>, payload binary"
    (
        docs.select("doc_id", "text")
        .repartitionByRange("doc_id")
        .sortWithinPartitions("doc_id", "text")
        .mapInArrow(run, schema)
        .write.parquet(path)
    )


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` of every document below ``path``; ``ids`` are little-endian unsigned 32-bit.

    The driver adds up one number per file. Tasks decode rows together up to
    ``LANES`` blocks, and check every block.
    """
    ship_package(spark)
    files = spark.read.parquet(path)
    kind = files.schema["doc_ids"].dataType.elementType.simpleString()
    sizes = (
        files.groupBy("part")
        .agg(F.sum(F.aggregate("doc_tokens", F.lit(0).cast("bigint"), lambda a, x: a + x)).alias("n"))
        .collect()
    )
    starts, total = {}, 0
    for row in sorted(sizes):
        starts[row["part"]] = total
        total += row["n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        waiting = 0

        def decoded() -> Iterator[pa.RecordBatch]:
            nonlocal rows, waiting
            flat = [b for r in rows for b in r[4]]
            done: list[np.ndarray] = []
            for at in range(0, len(flat), LANES):
                done += decode_blocks(flat[at : at + LANES])
            at = 0
            for part, first, ids, tokens, blocks in rows:
                packed = b"".join([b.tobytes() for b in done[at : at + len(blocks)]])
                at += len(blocks)
                ends = np.cumsum(np.array(tokens, np.int64))
                begins = ends - tokens
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids, id_type),
                        pa.array(begins + starts[part] + first),
                        pa.array(tokens, pa.int64()),
                        pa.array([packed[4 * a : 4 * b] for a, b in zip(begins.tolist(), ends.tolist(), strict=True)], pa.binary()),
                    ],
                    names=["doc_id", "start", "n_tokens", "ids"],
                )
            rows, waiting = [], 0

        for batch in batches:
            id_type = batch.schema.field(2).type.value_type
            for part, first, ids, tokens, payload in zip(*batch.columns, strict=True):
                blocks = split_payload(payload.as_py())
                rows.append((part.as_py(), first.as_py(), ids.as_py(), tokens.as_py(), blocks))
                waiting += len(blocks)
                if waiting >= LANES:
                    yield from decoded()
        if rows:
            yield from decoded()

    return files.select("part", "first", "doc_ids", "doc_tokens", "payload").mapInArrow(
        run, f"doc_id {kind}, start long, n_tokens long, ids binary"
    )
