"""Mixing, search, token counts, sharding, packing, languages and the pipeline."""

import base64
import itertools
import math
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from adpulse.llm import langid, mixing, packing, queries, sharding, token_counts, topk

from .test_text_operators import frame, words

SF = "/root/testdata/sf0.001"
ODD = ["", "<|startoftext|> hi <|endoftext|>", "ΑΣ ΣΑΣ. x", "don't we'll 'S 123", "  a b\x1cc", "日本語 text ñandú ÇA ÿ÷x", "áb", "123 4%%% x.,., ..",
       "<|EndOfText|>", "ªº µ", "İstanbul ŒUVRE", "x" * 5000, "a\tb\n\nc", "a b\u0085c", "\n", " ", "ends\n", "\nstarts", "a \nb", "a\r\nb"]


def test_mixing_matches_brute_force(spark):
    rnd = random.Random(4)
    rows = [(i, words(rnd, rnd.randint(0, 40)), rnd.choice(["b", "a", "a", "a", "é", "", None])) for i in range(120)]
    rows += [(500, None, "a"), (501, None, "empty"), (None, "x y", "b"), rows[5], rows[5]]
    got = mixing.mix(frame(spark, rows)).collect()
    size = defaultdict(int)
    for _, t, s in rows:
        size[s] += len((t or "").split())
    order = sorted((s for s in size if s is not None)) + [None]
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(order)}
    target, open_, left = {}, set(order), 1.5 * sum(size.values())
    while open_:       # share, stop those above, share the rest anew
        level = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if weight[s] * level > 2 * size[s]}
        if not over:
            target |= {s: weight[s] * level for s in open_}
            break
        target |= {s: 2 * size[s] for s in over}
        left -= sum(2 * size[s] for s in over)
        open_ -= over
    by = {(r.doc_id, r.size): r for r in got}
    taken = defaultdict(int)
    for i, t, s in rows:
        r = by[i, len((t or "").split())]
        assert r.source_size == size[s] and r.target == pytest.approx(target[s])
        assert 0 <= r.taken <= 2 * r.size
    source = {(i, len((t or "").split())): s for i, t, s in rows}
    for r in got:      # equal rows may be taken differently
        taken[source[r.doc_id, r.size]] += r.taken
    assert all(abs(taken[s] - target[s]) <= 1 for s in order)
    assert len(got) == len(rows) and mixing.mix(frame(spark, [])).count() == 0
    again = mixing.mix(frame(spark, rows, 7)).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))
    mixed = mixing.mixed_documents(frame(spark, rows))
    assert mixed.columns == frame(spark, []).columns and mixed.count() > 0


def test_topk_matches_brute_force(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", 50)
    monkeypatch.setattr(topk, "CHUNK", 4)
    rng = np.random.default_rng(3)
    near = rng.normal(size=(6, 8))
    rows = [(i, [float(x) for x in near[i % 6] + 0.1 * rng.normal(size=8)]) for i in range(300)]
    rows += [(i, [1.0] * 8) for i in range(300, 420)] + [(420, None), (421, [1.0, None]), (422, [float("nan")] * 8),
                                                        (423, [float("inf")] * 8), (440, [0.5] * 3), (441, []), rows[20], (None, [1.0] * 8)]
    got = defaultdict(list)
    for r in topk.search(spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, score int")).collect():
        got[r.query_id].append((r["rank"], r.vec_id, r.score))
    good = {i: [int(np.floor(64 * x)) for x in v] for i, v in rows
            if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)}
    for q in (i for i in good if i % 20 == 0):
        best = sorted((-sum(a * b for a, b in zip(good[q], v)), i) for i, v in good.items() if i != q)[:20]
        assert sorted(got[q]) == [(k + 1, i, -s) for k, (s, i) in enumerate(best)]
    assert set(got) == {i for i in good if i % 20 == 0}
    few = spark.createDataFrame([(0, [1.0]), (20, [2.0])], "vec_id long, embedding array<double>")
    assert topk.search(few).count() == 2
    assert topk.search(few.limit(0)).count() == 0


def test_token_counts_equal_the_tokenizer(spark):
    path = queries.tokenizer("word_bpe_49k.json")
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    rows = docs + [(10_000 + i, t) for i, t in enumerate(ODD)] + [(20_000, None), (None, "a"), docs[0]]
    got = {(r.doc_id, r.n_bytes): r for r in token_counts.count_tokens(frame(spark, [(i, t, "s") for i, t in rows]), path).collect()}
    t = Tokenizer.from_file(path)
    for i, text in rows:
        r = got[i, len((text or "").encode())]
        n = len(t.encode(text, add_special_tokens=False).ids) if text else 0
        assert (r.n_tokens, r.over_limit) == (n, n > 2048), text
    assert token_counts.count_tokens(frame(spark, []), path).count() == 0


def test_encoder_equals_the_tokenizer(spark):
    e = packing.Encoder(**queries.byte_tokenizer())
    texts = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()] + ODD + ["<|endoftext|>", "a <|endof", "'s 't\n'll"]
    for _ in range(2):   # the second time from the cache
        assert e.encode_all(texts) == [np.array(e.tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]


def least_capacity(sizes, shards):
    low, high = max(sizes), sum(sizes)
    while low < high:
        mid, n, at = (low + high) // 2, 1, 0
        for s in sizes:
            n, at = (n + 1, s) if at + s > mid else (n, at + s)
        low, high = (low, mid) if n <= shards else (mid + 1, high)
    return low


@pytest.mark.parametrize("copies", [0, 300])
def test_sharding_is_minimax_and_gapless(spark, copies):
    rnd = random.Random(copies)
    rows = [(i, words(rnd, rnd.randint(0, 60)), "s") for i in range(600)] + [(1000 + i, "the same text " * 9, "s") for i in range(copies)]
    rows += [(5000, None, "s"), (5001, "", "s"), (None, "é", "s"), rows[0], rows[0]]
    df = frame(spark, rows)
    got = sharding.shard(df).collect()
    assert len(got) == len(rows) and {r.law for r in got} == {"bytes"} and {r.grown_shard for r in got} == {None}
    by, slots, shard_of = defaultdict(int), defaultdict(list), defaultdict(set)
    for r in got:
        by[r.shard] += r.size
        slots[r.shard].append(r.slot)
        shard_of[r.text_crc32].add(r.shard)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(by) <= set(range(16))
    assert all(len(s) == 1 for s in shard_of.values())
    assert sorted((r.doc_id, r.size, r.text_crc32) for r in got if r.doc_id is not None) == sorted(
        (i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, _ in rows if i is not None)
    groups = df.selectExpr("xxhash64(coalesce(text, '')) as _key", "octet_length(coalesce(text, '')) + 1 as _size").groupBy("_key").sum("_size").withColumnRenamed("sum(_size)", "_size")
    capacity, _ = sharding.cut_keys(groups)
    assert capacity == least_capacity([r._size for r in groups.orderBy("_key").collect()], 16)
    assert max(by.values()) <= capacity
    if not copies:
        assert min(by.values()) > 0.8 * max(by.values())
    assert sharding.shard(frame(spark, [])).count() == 0


def check_pieces(got, texts, capacity=2048):
    t = Tokenizer.from_file(queries.tokenizer("byte_bpe_50k.json"))
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in got:
        by_doc[r.doc_id].append(r)
        by_seq[r.sequence_id].append((r.offset, r.length))
    assert set(by_doc) == set(texts)
    for i, text in texts.items():
        ids, at = [*(t.encode(text, add_special_tokens=False).ids if text else []), 1], 0
        for r in sorted(by_doc[i], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at:at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)
    for parts in by_seq.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= capacity
    assert set(by_seq) == set(range(len(by_seq)))
    return sum(r.length for r in got) / (capacity * max(1, len(by_seq)))


def test_packing_round_trip(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    docs |= {10_000 + i: t for i, t in enumerate(ODD)} | {20_000: None, None: "null id"}
    rows = [(i, t, "s") for i, t in docs.items()]
    got = packing.pack(frame(spark, rows), queries.byte_tokenizer()).collect()
    assert check_pieces(got, docs) > 0.9
    twice = packing.pack(frame(spark, [(1, "a b", "s")] * 3), queries.byte_tokenizer()).collect()
    assert sorted((r.offset, r.length) for r in twice) == [(0, 3), (3, 3), (6, 3)]
    assert packing.pack(frame(spark, []), queries.byte_tokenizer()).count() == 0


def test_patterns_hold_every_piece():
    rng = np.random.default_rng(1)
    for room in (16, 64):
        need = rng.integers(0, 50, room)
        made = packing.cut_patterns(need, room)
        assert (sum(n * m for n, m in made) == need).all()
        assert all((m * np.arange(1, room + 1)).sum() <= room for _, m in made)
        least = -(-(need * np.arange(1, room + 1)).sum() // room)
        assert sum(n for n, _ in made) <= 1.2 * least + 2


def vocabulary():
    with open(queries.tokenizer("byte_bpe_50k.tiktoken"), "rb") as f:
        found = {base64.b64decode(line.split()[0]) for line in f if line.strip()}
    return sorted({p for p in found if 0 not in p} | {bytes([b]) for b in range(1, 256)})


def test_forward_sums_all_segmentations():
    pieces = langid.Pieces(queries.tokenizer("byte_bpe_50k.tiktoken"))
    number = {p: i for i, p in enumerate(vocabulary())}
    assert pieces.n == len(number) and pieces.longest > 48
    prob = np.random.default_rng(0).random((pieces.n, 2)) / 100
    for word in ("then", "ñandú", "a", "misguidedly"):
        raw = b" " + word.encode()
        total = np.zeros(2)
        for cut in itertools.product([0, 1], repeat=len(raw) - 1):
            ends = [k + 1 for k, c in enumerate(cut) if c] + [len(raw)]
            parts = [raw[a:b] for a, b in zip([0, *ends], ends)]
            if all(p in number for p in parts):
                total += prob[[number[p] for p in parts]].prod(axis=0)
        assert np.allclose(langid.log_likelihoods(pieces, [word], prob)[0], np.log(total))


def log_sum_over_cuts(raw, number, log_prob):
    """The sum over all cuts, place by place, in logarithms."""
    longest = max(map(len, number))
    upto = [0.0]
    for end in range(1, len(raw) + 1):
        ways = [upto[a] + log_prob[number[raw[a:end]]] for a in range(max(0, end - longest), end) if raw[a:end] in number]
        upto.append(max(ways) + math.log(sum(math.exp(w - max(ways)) for w in ways)))
    return upto[-1]


LONG_WORDS = ["pneumonoultramicroscopicsilicovolcanoconiosis" * 2, "-" * 70, "吾輩は猫である。名前はまだ無い。どこで生れたかとんと見当がつかぬ。" * 3,
              "x" * 31, "x" * 32, "x" * 33, "internationalization" * 150, "short"]


def test_forward_over_words_of_any_length():
    pieces = langid.Pieces(queries.tokenizer("byte_bpe_50k.tiktoken"))
    number = {p: i for i, p in enumerate(vocabulary())}
    prob = np.random.default_rng(1).random((pieces.n, 1)) / 1e6
    got = langid.log_likelihoods(pieces, LONG_WORDS, prob)[:, 0]
    want = [log_sum_over_cuts(b" " + w.encode(), number, np.log(prob[:, 0])) for w in LONG_WORDS]
    assert np.allclose(got, want, rtol=1e-10)


def test_expected_pieces_cover_every_byte():
    """The expected pieces of a word, times their lengths, are as long as the word; and they
    are the derivative of the word's log likelihood by each piece's log probability."""
    pieces = langid.Pieces(queries.tokenizer("byte_bpe_50k.tiktoken"))
    length = np.array([len(p) for p in vocabulary()])
    prob = np.random.default_rng(2).random((pieces.n, 2)) / 1e4
    for word in LONG_WORDS:
        raw = b" " + word.encode()
        made = np.zeros((pieces.n, 2))
        langid._expected(list(langid._blocks(pieces, [raw])), np.array([len(raw)]), prob, np.array([[1.0, 2.0]]), made)
        assert np.allclose((made * length[:, None]).sum(axis=0), [len(raw), 2 * len(raw)])
        for i in np.argsort(-made[:, 0])[:3]:
            more = prob.copy()
            more[i] *= 1.000001
            rise = langid.log_likelihoods(pieces, [word], more)[0, 0] - langid.log_likelihoods(pieces, [word], prob)[0, 0]
            assert abs(rise / math.log(1.000001) - made[i, 0]) < 1e-3 * max(1, made[i, 0])


def test_language_id_on_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    odd = spark.createDataFrame([(9001, None), (9002, ""), (9003, "12 34 %%"), (None, "the and")], "doc_id long, text string")
    all_ = docs.select("doc_id", "text", "lang").unionByName(odd.selectExpr("doc_id", "text", "cast(null as string) as lang"))
    path = queries.tokenizer("byte_bpe_50k.tiktoken")
    got = langid.identify(all_, path).toPandas()
    lang = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    assert len(got) == docs.count() + 4
    assert all(h == (zlib.crc32(str(int(i)).encode()) % 4 == 2) for i, h in zip(got.doc_id, got.held_out) if i == i)
    held = got[got.held_out & got.doc_id.isin(list(lang))]
    assert (held.lang_pred == held.doc_id.map(lang)).mean() > 0.97
    assert set(got[got.doc_id.isin([9001, 9002, 9003])].lang_pred) == {"und"}
    assert got.score.between(0, 1).all()
    none = langid.identify(all_.withColumn("lang", all_.lang.cast("string").substr(100, 1)).where("false"), path)
    assert none.count() == 0


def test_language_id_learns_a_rare_language(spark):
    path = queries.tokenizer("byte_bpe_50k.tiktoken")
    docs = spark.range(0, 60_000, 1, 4).selectExpr(
        "id as doc_id", "if(id % 2400 = 7, 'zug um zug ' || id, 'step by step ' || id) as text", "if(id % 2400 = 7, 'de', 'en') as lang")
    langs, prob = langid.learn(docs, path, rows=10)
    assert langs == ["de", "en"]
    seen = [r.lang for r in langid.drawn_by_group(docs, "lang", F.struct("doc_id", "text"), F.lit(10)).collect()]
    assert 10 <= seen.count("de") <= 25 and 10 <= seen.count("en") < 60


def test_language_id_learns_repeated_rows_once(spark):
    path = queries.tokenizer("byte_bpe_50k.tiktoken")
    docs = spark.range(0, 9000, 1, 4).selectExpr("if(id < 8900, 1L, id) as doc_id", "if(id < 8900, 'the same', 'other ' || id) as text", "'en' as lang")
    drawn = langid.drawn_by_group(docs, "lang", F.struct("doc_id", "text"), F.lit(300)).collect()
    assert len(drawn) == len({r.doc_id for r in drawn}) == 101
    assert langid.learn(docs, path)[0] == ["en"]


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, seen = docs.columns, [docs.count()]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = {r.doc_id: r for r in docs.collect()}
        docs = stage(spark, docs, SF)
        rows = docs.collect()
        if k < 4:
            assert docs.columns == columns and all(r.doc_id in before for r in rows), name
            docs = spark.createDataFrame(rows, docs.schema)
        seen.append(len(rows))
    assert seen[1] <= seen[0] and seen[3] <= seen[2] <= seen[1]
    texts = defaultdict(list)
    for r in rows:
        texts[r.sequence_id].append(r.length)
    assert max(sum(v) for v in texts.values()) <= 2048


def test_every_operator_has_a_query():
    for n in range(1, 11):
        assert any(k.startswith(f"op{n}_") for k in queries.QUERIES)
