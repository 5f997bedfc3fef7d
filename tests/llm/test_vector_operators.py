"""Vector codes, token alignment and near vectors against brute force."""

from __future__ import annotations

import hashlib
import math
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from txsieve.llm import alignment, productquant, vectorcodes

SCHEMA = "vec_id long, embedding array<float>, label int"
NAN, INF = math.nan, math.inf


def vectors(spark, rows):
    frame = spark.createDataFrame(rows, SCHEMA)
    clashing = ("row", "part", "entry", "code", "ball", "center", "list", "n", "place", "vector")
    return frame.withColumns({name: F.lit(7) for name in clashing})


def brute_codes(rows, width):
    """Codes by plain integer k-means."""
    kept = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    part = max(1, -(-width // 4))
    cells = []
    for _, v, _ in kept:
        padded = [math.floor(1024 * float(np.float32(x))) for x in v] + [0] * (4 * part - len(v))
        cells.append([padded[p * part : (p + 1) * part] for p in range(4)])
    order = sorted(range(len(kept)), key=lambda i: (kept[i][0] is None, kept[i][0] or 0, kept[i][1]))
    books = [[cells[i][p] for i in order[:256]] for p in range(4)]

    def assign(p, cell):
        return min((sum((x - y) ** 2 for x, y in zip(cell, e, strict=True)), k) for k, e in enumerate(books[p]))

    for _ in range(4):
        for p in range(4):
            members = {}
            for c in cells:
                members.setdefault(assign(p, c[p])[1], []).append(c[p])
            books[p] = [
                [sum(x) // len(members[k]) for x in zip(*members[k], strict=True)] if k in members else e
                for k, e in enumerate(books[p])
            ]
    found = [[assign(p, c[p]) for p in range(4)] for c in cells]
    errors = [sum(d for d, _ in f) for f in found]
    totals = Counter()
    for (_, _, label), e in zip(kept, errors, strict=True):
        totals[label] += e
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()

    def long(x):
        return x if x < 1 << 63 else None

    return sorted(
        (
            (r[0], "".join(f"{k:02x}" for _, k in f), long(e), long(totals[r[2]]) if long(e) is not None else None, digest)
            for r, f, e in zip(kept, found, errors, strict=True)
        ),
        key=repr,
    )


@pytest.mark.parametrize("largest", [1.0, 3e4, 1e30])
def test_vector_codes(spark, largest):
    rng = random.Random(3)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(12)], rng.choice([1, 2, None])) for i in range(300)]
    rows += [(500 + i, list(rows[i % 3][1]), 4) for i in range(40)]
    rows += [(600, [largest] * 12, 5), (601, [-largest] * 12, 5), (602, [0.5], 6), (603, [], 6), (None, [0.25] * 12, 7)]
    rows += [(604, None, 1), (605, [NAN] * 12, 1), (606, [None] * 12, 1), (607, [INF] * 12, 1), (3, rows[3][1], 1)]
    rows = [(i, v if v is None else [None if x is None else float(np.float32(x)) for x in v], k) for i, v, k in rows]
    found = vectorcodes.encode(vectors(spark, rows).repartition(3)).collect()
    assert sorted((tuple(r) for r in found), key=repr) == brute_codes(rows, 12)
    empty = vectorcodes.encode(vectors(spark, rows).where("false"))
    assert empty.count() == 0 and empty.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]


def test_transform_and_nearest():
    rng = np.random.default_rng(5)
    for width in (1, 2, 3, 5, 16, 19):
        rows, entries = (rng.integers(-2000, 2000, (n, width)) for n in (300, 60))
        entries[7] = entries[3]
        size = vectorcodes.padded_size(width)
        a, b = vectorcodes.transformed(rows), vectorcodes.transformed(entries)
        want = ((rows[:, None] - entries) ** 2).sum(2)
        assert (((a[:, None] - b) ** 2).sum(2) == size * want).all()
        entry, error = vectorcodes.nearest(a, b)
        assert (entry == want.argmin(1)).all() and (error == want.min(1)).all()
    changes = (np.diff(vectorcodes.transformed(np.eye(8, dtype=np.int64)), axis=0) != 0).sum(0)
    assert changes.tolist() == list(range(8))


def brute_links(rows):
    usable = [r[1] is not None and len(r[1]) and all(x is not None and math.isfinite(x) for x in r[1]) and any(r[1]) for r in rows]
    width = max((len(r[1]) for r, u in zip(rows, usable, strict=True) if u), default=1)
    units = np.zeros((len(rows), width))
    for i, (r, u) in enumerate(zip(rows, usable, strict=True)):
        if u:
            units[i, : len(r[1])] = np.array(r[1], np.float32)
            units[i] /= np.linalg.norm(units[i])
    linked = units @ units.T >= 0.9
    n = linked.sum(1) - linked.diagonal()
    label = np.arange(len(rows))
    while True:
        least = np.array([min([label[i], *label[linked[i]]]) for i in range(len(rows))])
        if (least == label).all():
            break
        label = least
    ids = {}
    for i, g in enumerate(label):
        ids.setdefault(g, []).append(rows[i][0])
    result = []
    for i, g in enumerate(label):
        component = min((x for x in ids[g] if x is not None), default=None)
        result.append((rows[i][0], int(n[i]), component, rows[i][0] == component))
    return sorted(result, key=repr)


def test_near_vectors(spark, monkeypatch):
    monkeypatch.setattr(productquant, "CHUNK", 64)  # many balls of one group
    rng = np.random.default_rng(11)
    rows = []

    def add(v):
        rows.append((len(rows) + 10, [float(np.float32(x)) for x in v], int(rng.integers(5))))

    for base in rng.normal(size=(4, 16)):
        base /= np.linalg.norm(base)
        for spread, copies in ((0.0, 40), (0.02, 150), (0.06, 100), (0.11, 60)):
            for _ in range(copies):
                add((base + spread * rng.normal(size=16)) * rng.uniform(0.1, 10))
    for v in rng.normal(size=(400, 16)):
        add(v)
    path = [np.cos(0.42 * k) * np.eye(16)[0] + np.sin(0.42 * k) * np.eye(16)[1] for k in range(6)]
    for v in path:  # a chain of links
        add(v)
    add(np.full(16, 1e-30))
    add(np.full(16, 3e38))
    rows += [(1, None, 1), (2, [0.0] * 16, 1), (3, [NAN] * 16, 1), (4, [None] * 16, 1), (5, [], 1), (6, [1.0], 1)]
    rows += [(None, list(rows[0][1]), 1), (None, [-x for x in rows[700][1]], 1), (12, list(rows[2][1]), 1)]
    found = productquant.near_vectors(vectors(spark, rows).repartition(4)).collect()
    got, want = sorted((tuple(r) for r in found), key=repr), brute_links(rows)
    assert [g[0] for g in got] == [w[0] for w in want]
    lost = [(g, w) for g, w in zip(got, want, strict=True) if g != w]
    assert all(g[1] <= w[1] for g, w in lost)  # nothing linked below the threshold
    assert sum(g[1] for g in got) >= 0.995 * sum(w[1] for w in want)
    assert len(lost) <= 0.01 * len(rows)
    empty = productquant.near_vectors(vectors(spark, rows).where("false"))
    assert empty.count() == 0 and empty.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert productquant.near_vectors(vectors(spark, rows[-9:-4])).count() == 5


def test_lookup_bound_loses_nothing():
    rng = np.random.default_rng(2)
    base = productquant.unit(rng.normal(size=(600, 10)))
    other = rng.normal(size=base.shape)
    other -= (other * base).sum(1, keepdims=True) * base
    angle = productquant.ANGLE
    partner = np.cos(angle) * base + np.sin(angle) * productquant.unit(other)
    index = productquant.Index(base, 8)
    home = index.scores(base).argmax(1)
    decoded = index.decoded(index.codes(base, home), home)
    along = (base * decoded).sum(1)
    across = np.sqrt((decoded * decoded).sum(1) - along**2)
    estimate = index.scores(partner)[np.arange(600), home]
    for m in range(index.subspaces):
        estimate = estimate + index.tables(partner)[m][np.arange(600), index.codes(base, home)[:, m]]
    assert (estimate >= along * np.cos(angle) - across * np.sin(angle) - 1e-4).all()


ODD = [
    "", " ", "a", "  a  b ", "it's a test", "Ünï cödé", "日本 語 text", "<|endoftext|> hi </s> <0x41>", "x\ty\n\nz", "😀 ok",
    "▁ mark", "é o", "tokenization tokenization", "the the the the", "　wide", "a b", "<s>", "İ ß ǅ",
]


def brute_alignment(texts):
    a_tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a_tok.encode_special_tokens = True
    b_tok = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte = {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in plain)}
    documents, counts = [], Counter()
    for text in texts:
        raw = b" " + (text or "").encode()
        a = [(i, bytes(byte[c] for c in a_tok.id_to_token(i))) for i in a_tok.encode(" " + (text or ""), add_special_tokens=False).ids]
        b = []
        for i in b_tok.encode(text or ""):
            piece = b_tok.id_to_piece(i)
            b.append((i, bytes([int(piece[3:5], 16)]) if b_tok.is_byte(i) else piece.replace("▁", " ").encode()))
        if not text or b"".join(x for _, x in a) != raw or b"".join(x for _, x in b) != raw:
            documents.append(None)
            continue
        sides = []
        for tokens in (a, b):
            at, spans = 0, []
            for i, x in tokens:
                spans.append((at, at + len(x), i))
                at += len(x)
            sides.append(spans)
        cuts = sorted({e for _, e, _ in sides[0]} & {e for _, e, _ in sides[1]})
        groups, start = [], 0
        for cut in cuts:
            groups.append("|".join(",".join(str(i) for s, e, i in side if start <= s and e <= cut) for side in sides))
            start = cut
        links = [(i, j) for s, e, i in sides[0] for t, f, j in sides[1] if s < f and t < e]
        counts.update(set(links))
        documents.append((len(a), len(b), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    most = {}
    for (i, _), n in counts.items():
        most[i] = max(n, most.get(i, 0))
    rows = []
    for d in documents:
        if d is None:
            rows.append((0, 0, 0, 0, 0, 0, ""))
            continue
        links = d[3]
        best = sum(counts[x] == most[x[0]] for x in links)
        rows.append((*d[:3], len(links), best, sum(counts[x] for x in links), d[4]))
    return rows


@pytest.mark.parametrize("common", [1 << 20, 60, 0])
def test_alignment(spark, monkeypatch, common):
    monkeypatch.setattr(alignment, "COMMON", common)
    rng = random.Random(9)
    words = ["the", "tokenization", "Wörter", "x.", "ab\ncd", "12,345", "naïve", "日本語", " ", "</s>", "hyperparameters"]
    texts = [*ODD, None, "same text", "same text"]
    texts += [" ".join(rng.choices(words, k=rng.randrange(1, 60))) for _ in range(150)]
    texts.append(" ".join(rng.choices(words, k=1500)))
    ids = [None if i % 50 == 0 else i // 2 for i in range(len(texts))]
    docs = spark.createDataFrame(list(zip(ids, texts, strict=True)), "doc_id long, text string")
    docs = docs.withColumns({name: F.lit(7) for name in ("row", "keys", "key", "n", "best", "times", "n_a")})
    found = sorted((tuple(r) for r in alignment.align(docs.repartition(3)).collect()), key=repr)
    want = sorted(((i, *r) for i, r in zip(ids, brute_alignment(texts), strict=True)), key=repr)
    assert found == want
    assert alignment.align(docs.where("false")).count() == 0


def test_long_texts_are_cut_where_nothing_changes(monkeypatch):
    rng = random.Random(4)
    words = ["the", "tokenization", "Wörter", "", "ab\ncd", "\t", "日本語", "</s>"]
    texts = [" ".join(rng.choices(words, k=400)) for _ in range(20)] + ["x" * 5000, " " * 3000, "a " * 900 + " "]

    def rows():
        aligner, documents = alignment.Aligner(), [alignment.Document(()) for _ in texts]
        for document, text in zip(documents, texts, strict=True):
            aligner.add(document, text)
        aligner.align()
        return [[x.tolist() if isinstance(x, np.ndarray) else x for x in d.row()] for d in documents]

    whole = rows()
    monkeypatch.setattr(alignment, "SEGMENT", 50)
    monkeypatch.setattr(alignment, "BATCH", 300)
    assert rows() == whole
    assert len(list(alignment.segments(texts[0]))) > 10
