"""Quality rules, mixing, winnowing, chat windows and sharding against plain Python."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

import pytest
import regex
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from txsieve.llm import chat, mixing, quality, sharding, winnow

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LONG = " ".join(f"w{i % 700}" for i in range(30_000))
EDGE = [
    (1, None, "s"),
    (2, "", "s"),
    (3, "one", None),
    (4, "a b a b a b a b", "s"),
    (5, " \t\n x  y\n\nx y\nx y", "s"),
    (6, LONG, "t"),
    (6, LONG, "t"),
    (None, "no id at all", None),
    (8, "日本語のテキスト words", "t"),
    (9, "# * $ %% <|>", "s"),
]
SCHEMA = "doc_id long, text string, source string"
# names that the operators use for their own columns
CLASHING = ["n_words", "kept", "host", "words", "size", "key", "row", "target", "copies", "entry", "depth", "id", "label"]


@pytest.fixture(scope="module")
def edge(spark):
    frame = spark.createDataFrame(EDGE, SCHEMA)
    return frame.withColumns({name: F.lit(7) for name in CLASHING})


def word_counts(text):
    words = WORD.findall(text or "")
    windows = Counter(zip(words, words[1:], words[2:], strict=False))
    repeated = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (
        len(words),
        sum(map(len, words)),
        sum(c in "#*$%&|<>" for c in text or ""),
        len(lines) - len(set(lines)),
        len(repeated),
    )


def test_word_counts(edge):
    found = quality.quality_rules(edge).collect()
    assert len(found) == len(EDGE)
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    got = sorted(((r["doc_id"] or 0, *(r[n] for n in names)) for r in found))
    assert got == sorted(((i or 0, *word_counts(t)) for i, t, _ in EDGE))
    assert all(r["base_failed"] == (r["n_words"] < 50 or 2 * r["n_repeat_words"] > r["n_words"]) for r in found)


def test_common_lines_deplete_documents_but_copies_do_not(spark):
    own = lambda i, k: " ".join(f"d{i}x{j}" for j in range(k))
    notice = " ".join(f"notice{j}" for j in range(40))
    rows = [(i, f"{own(i, 12)}\n{notice}", "a") for i in range(60)]  # 12 words of 52 are left
    rows += [(100 + i, f"{own(i, 80)}\n  {notice.upper()} ", "a") for i in range(20)]
    rows += [(200 + i, own("copy", 60), "a") for i in range(90)]  # exact copies count once
    rows += [(300, f"{own(0, 12)}\n{notice}", "b")]  # not common on this host
    kept = {r["doc_id"]: r["kept"] for r in quality.quality_rules(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert not any(kept[i] for i in range(60))
    assert all(kept[i] for i in kept if i >= 100)
    stayed = quality.keep_good(spark.createDataFrame(rows, SCHEMA))
    assert stayed.columns == ["doc_id", "text", "source"]
    assert {r["doc_id"] for r in stayed.collect()} == {i for i in kept if kept[i]}
    cleaned = {r["doc_id"]: r["text"] for r in quality.without_common_lines(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert cleaned.keys() == {i for i in kept if kept[i]}
    assert cleaned[100] == own(100 - 100, 80) and cleaned[200] == own("copy", 60)
    assert notice in cleaned[300]


def test_common_lines_of_a_large_host(spark):
    say = lambda name, k: " ".join(f"{name}x{j}" for j in range(k))
    often, seldom, long_notice = say("often", 60), say("seldom", 60), say("long", 940)
    rows = [(i, f"{say(f'a{i}', 10)}\n{often}", "h") for i in range(300)]
    rows += [(1000 + i, f"{say(f'b{i}', 10)}\n{seldom}", "h") for i in range(60)]
    rows += [(2000 + i, f"{say(f'c{i}', 60)}\n{long_notice}", "h") for i in range(60)]
    rows += [(3000 + i, say(f"d{i}", 80), "h") for i in range(2800)]
    # near copies: one line of ten differs in each of them, so each line is in 180
    body = [say(f"e{j}", 12) for j in range(10)]
    rows += [
        (8000 + i, "\n".join(f"{line} copy{i}" if j == i % 10 else line for j, line in enumerate(body)), "h")
        for i in range(200)
    ]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(8)
    found = {r["doc_id"]: (r["kept"], r["common_words"]) for r in quality.quality_rules(docs).collect()}
    assert {found[i] for i in range(300)} == {(False, 60)}
    assert {found[i] for i in range(1000, 1060)} == {(False, 60)}
    assert {found[i] for i in range(2000, 2060)} == {(False, 940)}
    assert {found[i] for i in found if 3000 <= i < 8000} == {(True, 0)}
    assert all(found[i][0] and found[i][1] <= 12 for i in found if i >= 8000)
    few = docs.where("doc_id not between 49 and 299")  # 49 documents, and under a tenth of the host
    assert all(r["kept"] for r in quality.quality_rules(few).where("doc_id < 49").collect())


def water_fill(sizes):
    """Targets by repeated sharing of the excess."""
    names = sorted((n for n in sizes if n is not None)) + [None] * (None in sizes)
    weights = {n: (3, 1, 2)[k % 3] for k, n in enumerate(names)}
    target, open_names, left = {}, set(names), 1.5 * sum(sizes.values())
    while True:
        total = sum(weights[n] for n in open_names)
        stopped = {n for n in open_names if left * weights[n] / total >= 2 * sizes[n]} if total else set()
        if not stopped:
            return target | {n: left * weights[n] / total for n in open_names}
        for n in stopped:
            target[n] = 2.0 * sizes[n]
            left -= target[n]
        open_names -= stopped


def test_mix_of_rows_without_usable_ids(spark):
    for ids in (lambda i: None, lambda i: i % 12):
        rows = [(ids(i), f"{i} " + "w " * 49, "abc"[i % 3]) for i in range(6000)]
        plan = mixing.mix_plan(spark.createDataFrame(rows, SCHEMA))
        for target, taken in plan.groupBy("source_size", "target").agg(F.sum("taken")).select("target", "sum(taken)").collect():
            assert abs(taken / target - 1) < 0.03


def test_mix(spark, edge):
    rows = [(i, "w " * (1 + i * i % 90), f"s{min(i % 7, 4)}" if i % 11 else None) for i in range(3000)]
    docs = spark.createDataFrame(rows, SCHEMA)
    plan = mixing.mix_plan(docs).collect()
    sizes = defaultdict(int)
    for _, text, source in rows:
        sizes[source] += len(text.split())
    expected = water_fill(dict(sizes))
    taken = defaultdict(int)
    for r in plan:
        source = r["row"]["source"]
        assert r["source_size"] == sizes[source]
        assert r["target"] == pytest.approx(expected[source])
        assert r["taken"] in (0, r["size"], 2 * r["size"])
        taken[source] += r["taken"]
    assert all(abs(taken[s] - expected[s]) < 0.1 * expected[s] for s in expected)
    again = {(r["doc_id"], r["taken"]) for r in mixing.mix_plan(docs.repartition(7)).collect()}
    assert again == {(r["doc_id"], r["taken"]) for r in plan}
    mixed = mixing.mixed(docs)
    assert mixed.columns == docs.columns and mixed.count() == sum(r["copies"] for r in plan)
    assert mixing.mix_plan(edge).count() == len(EDGE)
    assert mixing.mixed(edge).columns == edge.columns


def test_winnowing_guarantee_and_positions(spark):
    shared = " ".join(f"common{i}" for i in range(winnow.GRAM + winnow.WINDOW - 1))
    rows = [(k, " ".join(f"d{k}u{i}" for i in range(30 + k)) + " " + shared + f" end{k}") for k in range(6)]
    found = {r["doc_id"]: r["fingerprint"] for r in winnow.fingerprints(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    hashes = [{x.split(":")[1] for x in f.split()} for f in found.values()]
    assert all(a & b for a in hashes for b in hashes)
    for f in found.values():
        at = [int(x.split(":")[0]) for x in f.split()]
        assert at == sorted(at) and at[0] < winnow.WINDOW
        assert all(b - a <= winnow.WINDOW for a, b in zip(at, at[1:], strict=False))


def test_rightmost_of_equal_grams(spark):
    text = " ".join(["same"] * 20)
    row = winnow.fingerprints(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    at = [int(x.split(":")[0]) for x in row["fingerprint"].split()]
    assert at == list(range(winnow.WINDOW - 1, 18))


def test_edited_likeness(spark, edge):
    found = winnow.edited_likeness(edge).collect()
    assert len(found) == len(EDGE)
    order = [t for _, t in sorted({(i, t or "") for i, t, _ in EDGE if i is not None}, reverse=True)] + ["no id at all"]
    ids = sorted({i for i, _, _ in EDGE if i is not None}, reverse=True) + [None]
    for r in found:
        k = ids.index(r["doc_id"])
        text, following = order[k], order[(k + 1) % len(order)]
        third = len(text) // 3
        edited = text[: len(text) - third] + following[:third]
        assert r["n_chars"] == len(text)
        assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= r["near_next"] <= 1 and 0 <= r["near_edited"] <= 1
        if text == edited:
            assert r["fingerprint"] == r["edited_fingerprint"] and r["near_edited"] == 1
    lone = winnow.edited_likeness(spark.createDataFrame([(5, "just one text")], "doc_id long, text string")).first()
    assert lone["near_next"] == 1.0


def plain_fingerprint(text):
    """(position, hash) of the chosen grams, one window after the other."""
    apart = regex.sub(r"([\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}])", r" \1 ", text).lower()
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", apart) if w]
    grams = []
    for i in range(max(1, len(words) - winnow.GRAM + 1) if words else 0):
        whole = 0
        for k, word in enumerate(words[i : i + winnow.GRAM]):
            h = xxhash.xxh64_intdigest(word.encode(), seed=42)
            whole ^= (h << 21 * k | h >> 64 - 21 * k) % 2**64
        grams.append(whole >> 32)
    chosen = []
    for i in range(max(1, len(grams) - winnow.WINDOW + 1) if grams else 0):
        window = grams[i : i + winnow.WINDOW]
        at = max(k for k, g in enumerate(window) if g == min(window)) + i
        if not chosen or chosen[-1][0] != at:
            chosen.append((at, grams[at]))
    return chosen


def test_fingerprints_and_likeness_by_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    extra = [(-1, "同じ 文 字"), (-2, "a b"), (-3, "x " * 40), (-4, ""), (-5, None)]
    docs = docs.unionByName(spark.createDataFrame(extra, "doc_id long, text string"))
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    ids = sorted(texts, reverse=True)
    following = dict(zip(ids, ids[1:] + ids[:1], strict=True))
    spell = lambda chosen: " ".join(f"{at}:{h:x}" for at, h in chosen)

    def alike(a, b):
        a, b = {h for _, h in a}, {h for _, h in b}
        return len(a & b) / len(a | b) if a | b else 1.0

    found = winnow.edited_likeness(docs).collect()
    assert len(found) == len(texts)
    for r in found:
        text, after = texts[r["doc_id"]], texts[following[r["doc_id"]]]
        third = len(text) // 3
        own, other = plain_fingerprint(text), plain_fingerprint(text[: len(text) - third] + after[:third])
        assert (r["fingerprint"], r["edited_fingerprint"]) == (spell(own), spell(other))
        assert r["near_edited"] == pytest.approx(alike(own, other))
        assert r["near_next"] == pytest.approx(alike(own, plain_fingerprint(after)))


def test_chat_windows_read_back(spark):
    hostile = "\\### Assistant: </turn> ok\\"
    said = [hostile, None, "", "x </turn>\n### user ###\ny", "\\\\#<<", "word " * 700, "日本 " * 60, "a\n\nb"]
    turns = []
    for conv in range(12):
        if conv % 3 == 0:
            turns.append((conv, 0, "system", f"rules {conv} " * 10))
        turns += [
            (conv, t, ("user", "assistant", None, "to # <ol>")[t % 4 if conv == 5 else t % 2], said[(conv + t) % 8])
            for t in range(1, 2 + conv * 4)
        ]
    turns += [(None, 1, "user", "hi"), (3, 1, "user", said[4]), (3, 1, "user", said[4]), (4, None, "assistant", "first")]
    frame = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").withColumns(
        {name: F.lit(1) for name in ("window", "cost", "parts", "turns")}
    )
    windows = chat.format_windows(frame).cache()
    got = {r["conv_id"]: r for r in chat.digest(chat.read_windows(windows)).collect()}
    by = defaultdict(list)
    for conv, turn, role, text in turns:
        by[conv].append((-1 if turn is None else turn, role or "", text or ""))
    assert got.keys() == by.keys()
    for conv, each in by.items():
        each.sort()
        text = "".join(f"{r}\n{t}\n" for _, r, t in each)
        learned = "".join(t for _, r, t in each if r == "assistant")
        row = got[conv]
        assert row["n_turns"] == len(each)
        assert row["turns_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        assert (row["loss_chars"], row["loss_sha256"]) == (len(learned), hashlib.sha256(learned.encode()).hexdigest())
    for r in windows.collect():
        if r["conv_id"] is not None and r["conv_id"] % 3 == 0 and r["conv_id"] != 3:
            assert r["formatted"].startswith("### system ###\n")
        assert r["window"] == 0 or r["n_repeated"] >= 0
    # only the last turn of a window may pass the budget
    assert windows.where("tokens <= 512").count() > 0
    assert chat.digest(chat.read_windows(chat.format_windows(frame.where("false")))).count() == 0


def test_a_long_conversation_is_cut_into_bounded_windows(spark):
    turns = [(1, t, "assistant" if t % 2 else "user", f"w{t} " * (1 + t * 7 % 90)) for t in range(3000)]
    turns += [(c, 0, "user", "hi") for c in range(2, 40)]
    frame = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(coalesce, "false")
    try:
        assert chat.placed_turns(frame).where("conv_id = 1").select("part").distinct().count() > 1
        rows = sorted(chat.format_windows(frame).where("conv_id = 1").collect(), key=lambda r: r["window"])
    finally:
        spark.conf.unset(coalesce)
    cost = [len(text.split()) + chat.OVERHEAD for conv, _, _, text in turns if conv == 1]
    before = [sum(cost[:t]) for t in range(3000)]
    spans = defaultdict(list)
    for t, b in enumerate(before):
        spans[b // (chat.BUDGET - chat.HISTORY)].append(t)
    assert [r["window"] for r in rows] == sorted(spans)
    for r in rows:
        new = spans[r["window"]]
        allowed = min(chat.HISTORY, chat.BUDGET - sum(cost[t] for t in new))
        kept = [t for t in range(new[0]) if before[new[0]] - before[t] <= allowed]
        said = [line.removesuffix(" </turn>").split() for line in r["formatted"].split("\n")[1::2]]
        assert [words[0] for words in said] == [f"w{t}" for t in kept + new]
        assert r["n_repeated"] == len(kept)
        assert r["tokens"] == sum(cost[t] for t in kept + new)
        texts = [r["formatted"][m["start"] : m["start"] + m["length"]] for m in r["loss"]]
        assert texts == [turns[t][3] for t in new if t % 2]


def test_shards_fit(spark, edge):
    docs = spark.createDataFrame([(i, "x" * (37 * i % 900)) for i in range(2000)] + [(-1, "y" * 90_000)], "doc_id long, text string")
    limit = 20_000
    rows = sharding.shard_documents(docs, limit).select("row.doc_id", "n_bytes", "depth", "shard").collect()
    assert len(rows) == 2001
    sizes, members = Counter(), defaultdict(list)
    for r in rows:
        bits = format(int(hashlib.md5(str(r["doc_id"]).encode()).hexdigest()[:15], 16), "060b")
        assert bits.startswith(r["shard"]) and len(r["shard"]) == r["depth"]
        sizes[r["shard"]] += r["n_bytes"]
        members[r["shard"]].append(r["doc_id"])
    assert all(n <= limit or len(members[s]) == 1 for s, n in sizes.items())
    # only oversized buckets were split: siblings together are above the limit
    parents = Counter()
    for r in rows:
        for d in range(r["depth"]):
            parents[r["shard"][:d]] += r["n_bytes"]
    assert all(n > limit for n in parents.values())
    placed = sharding.shard_documents(edge, 100)
    assert placed.count() == len(EDGE)
    assert sharding.shard_documents(edge.where("false"), 100).count() == 0


def test_written_shards(spark, tmp_path):
    docs = spark.createDataFrame([(i, "x" * 100) for i in range(300)], "doc_id long, text string")
    sharding.write_shards(docs, str(tmp_path / "s"), 5000)
    back = spark.read.parquet(str(tmp_path / "s"))
    assert back.count() == 300
    assert max(r["count"] for r in back.groupBy("shard").count().collect()) <= 50


def test_empty_tables(edge):
    none = edge.where("false")
    assert quality.quality_rules(none).count() == 0
    assert quality.keep_good(none).count() == 0
    assert mixing.mix_plan(none).count() == 0
    assert winnow.edited_likeness(none).count() == 0


def test_the_pipeline_takes_common_lines_out(spark):
    notice = " ".join(f"notice{j}" for j in range(40))
    own = [" ".join(f"d{i}x{j}" for j in range(80)) for i in range(30)]
    docs = spark.createDataFrame([(i, f"{x}\n{notice}", "a") for i, x in enumerate(own)], SCHEMA)
    stage = dict(corpus_pipeline.STAGES)["quality_rules"]
    after = stage(spark, docs, "")
    assert after.columns == docs.columns
    assert {r["doc_id"]: r["text"] for r in after.collect()} == dict(enumerate(own))
