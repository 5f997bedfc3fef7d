"""Near-dedup, language id, HTML, packing and token files against brute force, round trips and held-out rows."""

from __future__ import annotations

import os
import random
import time
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from txsieve.llm import html, langid, packing, rangecoder, setsketch
from txsieve.llm.components import connected_components
from txsieve.llm.tokens import TextEncoder

SCHEMA = "doc_id long, text string, lang string, source string"
ODD = [
    "", " ", "  a", "a  b", "a \n b", "a\nb", "\n\na", "a\n", "it's I'm don't", "Ünï cödé ÉÈ", "日本 語 text", "é a ́b",
    "<|endoftext|> hi <|startoftext|>", "a,b c. d.. e.", "İstanbul ß ǅ", "12 34ab  ", "\t\ta b\r\n c", "x \u0085 y",
    "a\x1cb c\x1c d", "_a _b a_ ª º", "😀 ok",
]


def documents(spark, *rows):
    frame = spark.createDataFrame([(i, t, None, "s") for i, t in rows], SCHEMA)
    clashing = ("node", "n", "kept", "label", "n_shingles", "ids", "start", "row", "letters", "part")
    return frame.withColumns({name: F.lit(7) for name in clashing})


def edited(words, share, rng):
    return [f"e{rng.random():.6f}" if rng.random() < share else w for w in words]


def brute_components(rows):
    sets = [setsketch.shingles((t or "").encode()) for _, t in rows]
    label = list(range(len(rows)))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                label[find(i)] = find(j)
    least = defaultdict(lambda: 1 << 60)
    for i, (doc_id, _) in enumerate(rows):
        least[find(i)] = min(least[find(i)], doc_id)
    return {doc_id: least[find(i)] for i, (doc_id, _) in enumerate(rows)}, {r[0]: len(s) for r, s in zip(rows, sets, strict=True)}


def test_near_duplicates_equal_brute_force(spark):
    rng = random.Random(3)
    rows = [(1, None), (2, ""), (3, " \n"), (4, "one two"), (5, "ONE  two"), (6, "one two three")]
    base = [f"w{rng.randrange(900)}" for _ in range(150)]
    for i in range(160):  # a group that passes the limit of small buckets, at all degrees of likeness
        rows.append((100 + i, " ".join(edited(base, rng.choice([0, 0.005, 0.01, 0.02, 0.04, 0.08]), rng))))
    for i in range(40):
        rows.append((400 + i, " ".join(f"w{rng.randrange(900)}" for _ in range(rng.randrange(5, 200)))))
    for i in range(20):
        rows.append((500 + i, rows[20][1] if i % 2 else " ".join(base[: 150 - 3 * i])))
    want, sizes = brute_components(rows)
    found = setsketch.near_duplicates(documents(spark, *rows)).collect()
    assert len(found) == len(rows)
    assert {r["doc_id"]: r["component_id"] for r in found} == want
    assert {r["doc_id"]: r["n_shingles"] for r in found} == sizes
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in found)


def test_near_duplicates_of_odd_tables(spark):
    text = " ".join(f"t{i}" for i in range(60))
    rows = [(1, text), (1, text), (None, text), (None, "alone with no id at all"), (2, text.upper()), (3, "x " * 50_000)]
    docs = documents(spark, *rows)
    found = sorted((r["doc_id"] or 0, r["component_id"] or 0, r["kept"]) for r in setsketch.near_duplicates(docs).collect())
    assert found == [(0, 0, True), (0, 1, False), (1, 1, True), (1, 1, True), (2, 1, False), (3, 3, True)]
    kept = setsketch.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] or 0) for r in kept.collect()) == [0, 1, 3]
    assert setsketch.near_duplicates(docs.where("false")).count() == 0


def test_sketches_merge_and_estimate():
    rng = np.random.default_rng(1)
    a, b = (rng.integers(0, 2**63, 500).astype(np.uint64) for _ in range(2))
    merged = np.maximum(setsketch.registers(a), setsketch.registers(b))
    assert (merged == setsketch.registers(np.concatenate([a, b]))).all()
    for shared, expected in ((480, True), (430, True), (150, False), (0, False)):
        other = np.concatenate([a[:shared], b[: 500 - shared]])
        r = [setsketch.registers(x)[None] for x in (a, other)]
        assert setsketch.likely(*r, np.array([500]), np.array([500]))[0] == expected


def test_components_of_a_path(spark):
    links = spark.createDataFrame([(f"{i:03d}", f"{i + 1:03d}") for i in range(60) if i != 30], "a string, b string")
    found = {r["node"]: r["label"] for r in connected_components(links).collect()}
    assert {found[f"{i:03d}"] for i in range(31)} == {"000"} and {found[f"{i:03d}"] for i in range(31, 61)} == {"031"}


@pytest.mark.parametrize("special", [True, False])
@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_encoder_equals_the_library(name, special):
    reference = Tokenizer.from_file(public_tokenizers.path(name))
    reference.encode_special_tokens = not special
    rng = random.Random(1)
    parts = ["a", "B", "é", " ", " ", "\n", "\t", ".", "'s", "1", "日", "́", " ###", "ß", "İ", "\x1c", "　", "😀", "the"]
    texts = ODD + ["".join(rng.choices(parts, k=rng.randrange(1, 30))) for _ in range(1500)]
    texts += [t.replace("a", x) for t in texts[:200] for x in ("<|endoftext|>", " <|STARTOFTEXT|> ")]
    encode = TextEncoder(name, limit=50, special=special)
    assert all(encode.ids(t).tolist() == reference.encode(t, add_special_tokens=False).ids for t in texts)


@pytest.fixture(scope="module")
def mixed_rows():
    rng = random.Random(5)
    rows = [(i, t) for i, t in enumerate(ODD)] + [(90, None), (91, "same"), (91, "same"), (None, "no id")]
    for i in range(300):
        rows.append((100 + i, " ".join(rng.choice(["the", "tion", "Wörter", "x.", "ab\ncd"]) for _ in range(rng.randrange(1, 600)))))
    return [*rows, (999, "long words and more " * 4000)]


def all_ids(name, rows, end):
    reference = Tokenizer.from_file(public_tokenizers.path(name))
    return [(i, [*reference.encode(t or "", add_special_tokens=False).ids, end]) for i, t in rows]


def checksum(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_packing(spark, mixed_rows):
    docs = documents(spark, *mixed_rows).repartition(3)
    pieces = packing.pack_digest(docs).collect()
    wanted = defaultdict(list)
    for i, ids in all_ids(packing.TOKENIZER, mixed_rows, packing.END):
        wanted[i].append(ids)
    by_document, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_document[p["doc_id"]].append(p)
        by_sequence[p["sequence_id"]].append(p)
    assert by_document.keys() == wanted.keys()
    for i, each in by_document.items():
        ids = wanted[i][0]
        covered = sum(p["length"] for p in each)
        assert covered == sum(map(len, wanted[i]))
        for p in each:
            assert p["doc_tokens"] == len(ids)
            assert p["ids_crc32"] == checksum(ids[p["start"] : p["start"] + p["length"]])
    padding = 0
    for each in by_sequence.values():
        each.sort(key=lambda p: p["offset"])
        at = 0
        for p in each:
            assert p["offset"] == at
            at += p["length"]
        size = each[0]["sequence_tokens"]
        assert size == (at if at & (at - 1) == 0 else 2048) and at <= 2048
        padding += size - at
    assert padding <= 3 * 2048  # at most one padded sequence per task
    steps = defaultdict(set)
    for each in by_sequence.values():
        steps[each[0]["step_group"]].add(each[0]["sequence_tokens"])
    assert all(len(sizes) == 1 for sizes in steps.values())
    assert packing.pack(docs.where("false")).count() == 0


def test_token_files(spark, mixed_rows, tmp_path):
    docs = documents(spark, *mixed_rows).repartition(4)
    path = str(tmp_path / "ids")
    rangecoder.write_ids(docs, path)
    found = sorted(rangecoder.read_ids(spark, path).collect(), key=lambda r: r["start"])
    wanted = all_ids(rangecoder.TOKENIZER, sorted(mixed_rows, key=lambda r: -1 if r[0] is None else r[0]), rangecoder.END)
    at = 0
    for r, (i, ids) in zip(found, wanted, strict=True):
        assert (r["doc_id"], r["start"], r["n_tokens"]) == (i, at, len(ids))
        assert np.frombuffer(r["ids"], "<u4").tolist() == ids
        at += len(ids)
    empty = str(tmp_path / "empty")
    rangecoder.write_ids(docs.where("false"), empty)
    assert rangecoder.read_ids(spark, empty).count() == 0


def test_range_coder_blocks():
    rng = np.random.default_rng(2)
    blocks = [rng.integers(0, 65536, n).astype(np.uint32) for n in (1, 2, 5, 2048, 700)]
    blocks += [np.zeros(2048, np.uint32), (rng.zipf(1.4, 2048) % 50000).astype(np.uint32), np.arange(0, 65536, 32, dtype=np.uint32)]
    coded = rangecoder.encode_blocks(blocks)
    decoded = rangecoder.decode_blocks(coded)
    assert all((a == b).all() and len(a) == len(b) for a, b in zip(blocks, decoded, strict=True))
    assert len(coded[5]) < 200 and len(coded[6]) < 2048 * 2
    alone = [rangecoder.encode_blocks([b])[0] for b in blocks]
    assert alone == coded  # blocks do not depend on each other
    broken = bytearray(coded[4])
    broken[40] ^= 1
    with pytest.raises(ValueError, match="damaged"):
        rangecoder.decode_blocks([bytes(broken)])


def test_all_ids_are_those_of_the_library():
    encode = TextEncoder(rangecoder.TOKENIZER, limit=100)
    rng = random.Random(4)
    odd = [c for c in map(chr, range(0x3100)) if c.isspace() or not c.isalnum()] + list("aZ09é日ßŕΩя")
    texts = [*ODD, None, *[pattern.replace("{}", c) for c in odd for pattern in ("a{} b", "é{}\nY.", "b {}c", "a'{}s {}", "1{}2")]]
    some = [" ", " ", "\n", "'s", ".", "ab", "Cd", "12", "é", "\u00a0", "\u3000", "<|endoftext|>"]
    texts += ["".join(rng.choices(some, k=rng.randrange(12))) for _ in range(2000)]
    for at in range(0, len(texts), 500):
        part = texts[at : at + 500]
        ids, counts = encode.all_ids(pa.array(part, pa.string()).slice(3))
        wanted = [encode.tokenizer.encode(t or "", add_special_tokens=False).ids for t in part[3:]]
        assert counts.tolist() == [len(w) for w in wanted]
        assert ids.tolist() == [i for w in wanted for i in w]
    assert len(encode.pieces) <= 100 and len(encode.pieces.old) <= 100
    assert [len(x) for x in encode.all_ids(pa.array([], pa.string()))] == [0, 0]


def test_words_of_a_batch_are_encoded_together(monkeypatch):
    encode = TextEncoder(rangecoder.TOKENIZER)
    calls = []
    monkeypatch.setattr(encode, "encode_piece", lambda piece: calls.append(piece))
    rng = random.Random(5)
    words = ["".join(rng.choices("abcdeé", k=6)) for _ in range(3000)]
    ids, _ = encode.all_ids(pa.array([" ".join(words), "\n".join(words) + "."]))
    wanted = [encode.tokenizer.encode(t, add_special_tokens=False).ids for t in (" ".join(words), "\n".join(words) + ".")]
    assert ids.tolist() == wanted[0] + wanted[1] and not calls


def test_range_coder_packs_better_than_deflate(sf_dir):
    texts = pq.read_table(f"{os.path.dirname(sf_dir)}/sf0.01/documents.parquet").column("text").to_pylist()
    encode = TextEncoder(rangecoder.TOKENIZER)
    ids = np.concatenate([encode.ids(t or "") for t in texts])
    blocks = rangecoder.cut(ids)
    coded = rangecoder.encode_blocks(blocks)
    deflated = sum(len(zlib.compress(b.astype("<u2").tobytes(), 6)) for b in blocks)
    assert sum(map(len, coded)) < 0.95 * deflated
    payload = rangecoder.join_payload(coded)
    assert rangecoder.split_payload(payload) == coded
    back = rangecoder.decode_blocks(coded)
    assert all(np.array_equal(a, b) for a, b in zip(blocks, back, strict=True))


def test_damaged_blocks_are_found():
    rng = np.random.default_rng(8)
    coded = rangecoder.encode_blocks([(rng.zipf(1.3, 3000) % 50000).astype(np.uint32)])[0]
    for at in rng.integers(8, len(coded) - 2, 60):
        broken = bytearray(coded)
        broken[at] ^= 1 << rng.integers(8)
        with pytest.raises(ValueError, match="damaged"):
            rangecoder.decode_blocks([bytes(broken)])


def language_rows(rng, count):
    alphabets = {"aa": "abcde", "bb": "fghij", "cc": "абвгд"}
    rows = []
    for i in range(count):
        lang = rng.choice(list(alphabets))
        words = ["".join(rng.choices(alphabets[lang], k=rng.randrange(2, 8))) for _ in range(rng.randrange(3, 200))]
        rows.append((i, " ".join(words), lang, "s"))
    return rows


def test_language_id(spark):
    rows = language_rows(random.Random(1), 600)
    rows += [(9000, None, "aa", "s"), (9001, "12 !?", "bb", None), (9002, "", None, "s"), (None, "abc abd abe", None, None)]
    docs = spark.createDataFrame(rows, SCHEMA).withColumns({n: F.lit(1) for n in ("letters", "score", "row", "held_out")})
    found = {r["doc_id"]: r for r in langid.identify(docs).collect()}
    assert len(found) == len(rows)
    truth = {r[0]: r[2] for r in rows}
    for i, r in found.items():
        assert r["held_out"] == (zlib.crc32(str("" if i is None else i).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1
    judged = [i for i in range(600) if found[i]["held_out"]]
    assert np.mean([found[i]["lang_pred"] == truth[i] for i in judged]) > 0.98
    assert all(found[i]["lang_pred"] == "und" for i in (9000, 9001, 9002))
    kept = langid.keep_identified(docs)
    assert kept.columns == docs.columns
    assert {9000, 9001, 9002}.isdisjoint(r["doc_id"] for r in kept.collect()) and kept.count() > 590
    # held-out labels are never learned: other ones change nothing
    renamed = docs.withColumn("lang", F.when(langid.held_out(), F.lit("zz")).otherwise(F.col("lang")))
    assert {r["lang_pred"] for r in langid.identify(renamed).collect()} <= {"aa", "bb", "cc", "und"}


def test_language_id_without_usable_ids(spark):
    rows = language_rows(random.Random(2), 900)
    for ids in (lambda i: None, lambda i: i % 3):
        docs = spark.createDataFrame([(ids(r[0]), *r[1:]) for r in rows], SCHEMA)
        found = langid.identify(docs).withColumn("place", F.lit(1)).collect()
        assert len(found) == 900 and {r["lang_pred"] for r in found} == {"aa", "bb", "cc"}
    copies = spark.createDataFrame([(None, "only one text", "dd", "s")] * 3000 + rows[:300], SCHEMA)
    assert "dd" in {name for name, _ in langid.training_sample(copies)}
    many = [(i, f"text number {i} of its kind", f"l{i % 250}", "s") for i in range(2000)]
    assert len({name for name, _ in langid.training_sample(spark.createDataFrame(many, SCHEMA))}) == 250


def test_language_id_without_labels(spark):
    docs = spark.createDataFrame([(1, "abc", None, "s")], SCHEMA)
    assert langid.identify(docs).first()["lang_pred"] == "und"
    assert langid.keep_identified(docs).count() == 1
    assert langid.identify(docs.where("false")).count() == 0


PAGE = """<!DOCTYPE html><html><head><title>T</title><script>var t="</p>";</script></head><body>
<header class="site-header"><h1>Site</h1></header><nav>menu <a href=x>a</a></nav>
<div id="cookie-notice">We use cookies</div><div class="wrap"><main><article class="post-{n}">
<header><h1>Real &amp; title</h1><span>by X</span></header><p>First  para <a href=1>link</a> text {n} that is long enough.</p>
<p>Second&nbsp;para<br>with <b>break</p><ul><li>one item</li><li>two item</ul><div class="ad-box">Buy!</div>
<form><input>Name</form><aside>side</aside><pre>code
 x</pre></article><section id="comments"><p>A comment that is quite long indeed, and more, longer than the article itself,
 so that it would win without its name. A comment that is quite long indeed, and more.</p></section></main>
<div class="sidebar"><ul><li><a href=q>L1</a><li><a href=q>L2</a><li><a href=q>L3</a></ul></div></div><footer>foot</footer></body></html>"""


def test_html(spark):
    rows = [(i, f"http://Host.example/{i}", PAGE.replace("{n}", str(i))) for i in range(5)]
    rows += [
        (10, None, None),
        (11, "not an address", "plain &lt;text&gt;"),
        (12, "http://other.example", ""),
        (13, "http://other.example", "<p>a<p>b"),
        (14, "http://other.example", "<script>never closed"),
        (15, "http://other.example", "x < y & z"),
        (15, "http://other.example", "x < y & z"),
        (16, "http://other.example", "<div>" * 3000 + "deep"),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns(
        {n: F.lit(1) for n in ("host", "path", "text", "votes")}
    )
    found = html.main_text(pages).collect()
    assert len(found) == len(rows)
    text = {r["page_id"]: r["text"] for r in found}
    for i in range(5):
        assert text[i].split("\n\n") == [
            "Real & title", f"First para link text {i} that is long enough.", "Second para with break", "one item", "two item", "code x",
        ]
    assert [text[i] for i in (10, 11, 12, 13, 14, 15, 16)] == ["", "plain <text>", "", "a\n\nb", "", "x < y & z", "deep"]
    assert all(r["n_chars"] == len(r["text"]) for r in found)
    assert html.main_text(pages.where("false")).count() == 0


def test_hosts_agree_on_a_path(spark):
    """A page with a long notice of its own is read by the path of its host."""
    article = "<html><body><div class='entry-{i}'><p>{a}</p></div><div class='box'><p>{b}</p></div></body></html>"
    long, short = "word " * 60, "note " * 10
    rows = [(i, "http://h.example/", article.format(i=i, a=long, b=short)) for i in range(9)]
    rows.append((9, "http://h.example/", article.format(i=9, a="word " * 12, b="note " * 22)))
    found = {r["page_id"]: r["text"] for r in html.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert found[0] == long.strip()
    assert found[9] == ("word " * 12).strip()


def read_pages(spark, *pages):
    rows = [(i, "http://h.example/", page) for i, page in enumerate(pages)]
    found = html.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    return [r["text"] for r in sorted(found, key=lambda r: r["page_id"])]


def test_html_templates_of_a_host(spark):
    """Pages of a second template, and articles in two containers, keep all of their text."""
    first = "<body><div class='entry'><p>" + "word " * 60 + "</p></div><div class='box'><p>note</p></div></body>"
    second = "<body><div class='entry'><p>" + "teaser " * 9 + "</p></div><div class='story'><p>" + "story " * 15 + "</p></div></body>"
    swapped = "<body><div class='entry'><p>" + "teaser " * 12 + "</p></div><div class='box'><p>" + "story " * 80 + "</p></div></body>"
    found = read_pages(spark, *[first] * 6, second, swapped)
    assert found[:6] == [("word " * 60).strip()] * 6
    assert found[6].split("\n\n") == [("teaser " * 9).strip(), ("story " * 15).strip()]
    assert ("story " * 80).strip() in found[7]


def test_html_keeps_what_is_beside_the_body(spark):
    body = "<div class='body'><p>" + "text " * 90 + "</p><p>end</p></div>"
    text = [("text " * 90).strip(), "end"]
    for before, lead in (
        ("<article><h1>Title</h1><p>lead</p>{}</article>", ["Title", "lead"]),
        ("<article><div class='head'>Title</div><div class='lead'><p>lead</p></div>{}</article>", ["Title", "lead"]),
        ("<div class='post'><div class='top'><h1>Title</h1></div>{}</div>", ["Title"]),
        ("<div class='post'>loose lead {}</div>", ["loose lead"]),
        ("<main><div class='lead'>lead</div>{}</main>", ["lead"]),
    ):
        page = "<html><body>" + before.replace("{}", body) + "</body></html>"
        assert read_pages(spark, page, page)[0].split("\n\n") == lead + text


def test_html_names_of_layouts(spark):
    """A class of the whole layout takes no text with it; the same words on minor elements do."""
    text = ["Title", *(("text " * n).strip() for n in (30, 40, 50))]
    paragraphs = "".join(f"<p>{x}</p>" for x in text[1:])
    article = f"<h1>Title</h1>{paragraphs}"
    side = "<div class='sidebar'><p>side text</p></div>"
    for wrapper in (
        f"<div class='content has-sidebar'>{article}</div>{side}",
        f"<div id='page' class='site no-sidebar'><div class='post'>{article}</div></div>",
        f"<div class='elementor-widget-wrap'>{article}</div>",
        f"<section class='with-navigation'>{article}</section>",
        f"<div class='post no-comments'>{article}</div>",
        f"<div class='comments-open'>{article}</div>",
        f"<div class='page-sidebar-right'><div class='text'>{article}</div>{side}</div>",
        f"<div class='header-layout'>{article}</div>",
        f"<main><div class='with-header'>{article}</div></main>",
        "<h1 class='widget'>Title</h1>" + "".join(f"<div class='elementor-widget'><p>{x}</p></div>" for x in text[1:]),
    ):
        page = f"<html><body>{wrapper}</body></html>"
        assert read_pages(spark, page, page)[0].split("\n\n") == text, wrapper
    # nothing but what is named noise
    assert read_pages(spark, "<div class='comment-list'><p>all there is</p></div>") == ["all there is"]
    # replies longer than the article are none of it
    replies = "<div class='comments'><p>" + "reply " * 200 + "</p></div>"
    assert read_pages(spark, f"<body><div class='post'>{article}</div>{replies}</body>")[0].split("\n\n") == text


def test_one_row_of_each_text_group(spark):
    """Which texts stay, with ids that are NULL or shared by different texts."""
    one, two = (" ".join(f"{c}{i}" for i in range(60)) for c in "tu")
    rows = [(1, one), (None, one + " more"), (None, "alone with no id at all"), (None, two), (None, two)]
    rows += [(5, "first text of five"), (5, "second text of five"), (5, one + " x"), (7, None), (None, None), (None, ""), (None, " "), (8, ""), (8, "")]
    docs = documents(spark, *rows)
    kept = setsketch.keep_one(docs.repartition(4))
    assert kept.columns == docs.columns
    expected = [
        (1, one), (None, "alone with no id at all"), (None, two), (5, "first text of five"), (5, "second text of five"),
        (7, None), (None, None), (None, ""), (None, " "), (8, ""), (8, ""),
    ]
    assert sorted(map(repr, expected)) == sorted(repr((r["doc_id"], r["text"])) for r in kept.collect())


def test_html_attributes_and_unknown_elements():
    def text(page):
        return html.extract(page, None)

    assert text("<p data-x=it's>It isn't lost, is it.</p><p>More.</p>") == "It isn't lost, is it.\n\nMore."
    assert text('<p title="5" tall">One.</p><p>Two.</p>') == "One.\n\nTwo."
    assert text('<p title="a > b">One.</p>') == "One."
    paragraphs = "".join(f"<p>Paragraph {i} of the story, long enough to count.</p>" for i in range(5))
    assert text(f'<story-body class="widget-content">{paragraphs}</story-body>').count("Paragraph") == 5
    assert text('<p>A <span class="search-hit">word</span> stays.</p>') == "A word stays."
    noise = '<p>A <span class="ad">x <span>y</span> z</span>word stays.</p>'
    assert text(noise) == "A word stays."
    assert text("<p>An <x-term>odd</x-term> word stays in its paragraph.</p>") == "An odd word stays in its paragraph."


@pytest.mark.parametrize(
    "page",
    ["<a " * 350_000, "<a x='" * 200_000, '<a x=">" ' * 120_000, "<div>" * 200_000, "<p><b>x" * 100_000, "<span hidden>" * 80_000,
     "<li><ul>" * 100_000 + "</li>" * 1000, "<!-- " * 200_000, "".join(f"<div><p>text {i}</p>" for i in range(4000))],
)
def test_html_takes_time_in_proportion(page):
    start = time.process_time()
    html.extract(page, None)
    assert time.process_time() - start < 30
