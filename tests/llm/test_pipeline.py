"""The pipeline's stages and its whole run against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from adpulse.llm import line_dedup, quality, queries

from .test_text_operators import brute_groups, brute_lines

WORD = re.compile(r"[^\x20\x09-\x0D]+")
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Names that the operators use themselves, and one with a dot.
CLASHING = ["_k1", "_k2", "_lines", "_gone", "_rest", "_row", "_n_lines", "_n_removed", "_doc", "_source", "_copy", "size", "kept",
            "group", "u", "_id.of"]
SCHEMA = ", ".join(["doc_id long", "text string", "lang string", "source string", "n_chars long"] + [f"`{c}` long" for c in CLASHING])
SF = "/root/testdata/sf0.001"


def prose(rnd, n):
    return " ".join("".join(rnd.choice("abcdefghijklm") for _ in range(rnd.randint(2, 8))) for _ in range(n))


def corpus():
    rnd = random.Random(7)
    boiler = [prose(rnd, 8) for _ in range(4)]
    rows = []

    def add(text, source):
        rows.append((len(rows) * 7 % 1009, text, source))

    for _ in range(70):                        # documents of their own, some with lines of many sites
        lines = [prose(rnd, rnd.randint(20, 40)) for _ in range(rnd.randint(3, 5))]
        add("\n".join(lines + rnd.sample(boiler, rnd.randint(0, 3))), rnd.choice("aaabcdefgh"))
    for _ in range(6):                         # exact and near copies
        base = prose(rnd, rnd.randint(80, 300)).split()
        for _ in range(rnd.randint(2, 7)):
            w = list(base)
            if rnd.random() < 0.6:
                w[rnd.randrange(len(w))] = "other"
            add(" ".join(w), rnd.choice("ab"))
    for text in (None, "", " \n\t", "too short", "again and again " * 40, "\n".join([boiler[0]] * 12), prose(rnd, 30_000)):
        add(text, rnd.choice(["a", "b", None]))
    whole = "\n".join(prose(rnd, 60) for _ in range(2))
    rows.extend((2000 + k, whole, s) for k, s in enumerate(["a", "b", "c", "d", "e", "f", None]))   # mirrored on many sites
    rows.append((None, prose(rnd, 90), None))
    rows.append((None, prose(rnd, 95), "a"))
    return rows + [rows[2], rows[2]]


def words_of(text):
    return WORD.findall(text or "")


def brute_quality(rows):
    """Without labels only the base rules speak."""
    def good(text):
        w = words_of(text)
        at = defaultdict(list)
        for i in range(len(w) - 2):
            at[tuple(w[i:i + 3])].append(i)
        again = {i + k for places in at.values() if len(places) > 1 for i in places for k in range(3)}
        return len(w) >= 50 and 100 * len(again) <= 50 * len(w)
    return [r for r in rows if good(r[1])]


def brute_clean(rows):
    out = []
    for (i, text, gone), (_, before, source) in zip(brute_lines(rows, line_dedup.MIN_SITES), rows, strict=True):
        full = sum(bool(x.strip(line_dedup.BLANKS)) for x in (before or "").split("\n"))
        if full == 0 or gone < full:
            out.append((i, text, source))
    return out


def brute_one_of_each(rows):
    rows = list(dict.fromkeys((i, t) for i, t, _ in rows))
    labels = defaultdict(list)
    for i, n, least in brute_groups([(i, t, None) for i, t in rows]):
        labels[i].append((n, least))
    return [(i, t) for i, t in rows if i is None or any(n == 0 or c == i for n, c in labels[i])]


def brute_copies(rows):
    """How often the mix takes each row."""
    size = defaultdict(int)
    for _, t, s in rows:
        size[s] += len(words_of(t))
    order = sorted(s for s in size if s is not None) + [None] * (None in size)
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(order)}
    target, open_, left = {}, set(order), 1.5 * sum(size.values())
    while open_:
        level = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if weight[s] * level > 2 * size[s]}
        if not over:
            target |= {s: weight[s] * level for s in open_}
            break
        target |= {s: 2 * size[s] for s in over}
        left -= sum(2 * size[s] for s in over)
        open_ -= over
    out = []
    for s in order:
        budget, before = math.floor(target[s] + 0.5), 0
        epochs = budget // size[s] if size[s] else 0
        key = lambda r: (hashlib.md5(f"mix:{'null' if r[0] is None else r[0]}".encode()).hexdigest(), len(words_of(r[1])))
        for r in sorted((r for r in rows if r[2] == s), key=key):
            n = len(words_of(r[1]))
            part = max(0, min(n, budget - epochs * size[s] - before))
            before += n
            out += [r] * (epochs + (part > 0 and 2 * part >= n))
    return out


def table_of(spark, rows):
    made = [(i, t, "en", s, None if t is None else len(t), *range(len(CLASHING))) for i, t, s in rows]
    return spark.createDataFrame(made, SCHEMA).repartition(3)


def plain(df):
    """doc_id, text and source of each row, after a check of all that passes through."""
    rows = df.collect()
    for r in rows:
        assert tuple(r[5:]) == tuple(range(len(CLASHING))) and r["lang"] == "en"
        assert r["n_chars"] == (None if r["text"] is None else len(r["text"]))
    return [(r["doc_id"], r["text"], r["source"]) for r in rows]


def alike(a, b):
    return Counter(a) == Counter(b)


@pytest.fixture(scope="module")
def unlabelled(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("sf"))
    table_of(spark, corpus()).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder


def test_every_stage_matches_brute_force(spark, unlabelled):
    rows, names = corpus(), [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality rules", "line dedup", "n-gram Jaccard join", "mixing sources to target weights", "packing"]
    quality_, lines, copies, mix, _ = (f for _, f in corpus_pipeline.STAGES)
    columns = COLUMNS + CLASHING

    got = quality_(spark, table_of(spark, rows), unlabelled)
    want = brute_quality(rows)
    assert got.columns == columns and alike(plain(got), want) and 80 < len(want) < len(rows) - 4

    rows, got = want, lines(spark, table_of(spark, want), unlabelled)
    want = brute_clean(rows)
    assert got.columns == columns and alike(plain(got), want)
    assert len(want) == len(rows) - 6 and sum(a[1] != b[1] for a, b in zip(rows, want)) > 20

    rows, got = want, copies(spark, table_of(spark, want), unlabelled)
    assert got.columns == columns
    have = plain(got)
    assert alike([r[:2] for r in have], brute_one_of_each(rows)) and len(have) < len(rows) - 5

    got = mix(spark, table_of(spark, have), unlabelled)
    assert got.columns == columns and alike(plain(got), brute_copies(have))


def test_whole_run_matches_brute_force(spark, unlabelled):
    rows = [r for r in corpus() if r[0] is not None]
    folder = unlabelled + "-ids"
    table_of(spark, rows).write.mode("overwrite").parquet(f"{folder}/documents.parquet")
    spark.read.parquet(f"{unlabelled}/labels.parquet").write.mode("overwrite").parquet(f"{folder}/labels.parquet")
    kept = brute_clean(brute_quality(rows))
    source = {r[0]: r[2] for r in kept}
    kept = brute_copies([(i, t, source[i]) for i, t in brute_one_of_each(kept)])
    times, text = Counter(r[0] for r in kept), {r[0]: r[1] for r in kept}
    tokens = Tokenizer.from_file(queries.tokenizer("byte_bpe_50k.json"))

    pieces, fill = defaultdict(list), defaultdict(list)
    for r in corpus_pipeline.run(spark, folder).collect():
        pieces[r.doc_id].append((r.start, r.length, r.ids_crc32, r.doc_tokens))
        fill[r.sequence_id].append((r.offset, r.length))
    assert set(pieces) == set(times)
    for i, found in pieces.items():
        ids, at = [*tokens.encode(text[i], add_special_tokens=False).ids, 1], 0
        for (start, length, crc, total), n in sorted(Counter(found).items()):
            assert (start, total, n) == (at, len(ids), times[i])
            assert crc == zlib.crc32(np.array(ids[at:at + length], "<u4").tobytes())
            at += length
        assert at == len(ids)
    for parts in fill.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048


def test_stages_on_empty_tables(spark, unlabelled):
    for name, stage in corpus_pipeline.STAGES:
        got = stage(spark, table_of(spark, []), unlabelled)
        assert got.count() == 0, name
        if name != "packing":
            assert got.columns == COLUMNS + CLASHING


def test_quality_does_not_depend_on_the_slices(spark, monkeypatch):
    rnd = random.Random(3)
    texts = ["", None, "", "x" * 700_000, "", " ".join(["word"] * 90_000), "\n", *[prose(rnd, rnd.randint(1, 400)) for _ in range(60)], ""]
    labelled = pd.DataFrame({"doc_id": range(60), "text": [t or "" for t in texts[:60]], "good": [i % 2 for i in range(60)]})
    made = []
    for size in (1 << 10, 1 << 18, 1 << 30):
        monkeypatch.setattr(quality, "SLICE_BYTES", size)
        fitted = quality._fit(labelled).iloc[0]
        model = {"weights": np.frombuffer(fitted.weights, np.int64), "slope": fitted.slope, "offset": fitted.offset}
        judged = quality._judge(model)(texts)
        made.append((fitted.weights, fitted.slope, {k: list(v) for k, v in judged.items()}))
        assert len(judged["kept"]) == len(texts) and quality._judge(model)([])["kept"].size == 0
    assert made[0] == made[1] == made[2]
    nothing = labelled.assign(text="")
    assert set(quality._fit(nothing).columns) == {"weights", "slope", "offset"}


def test_quality_stage_keeps_what_the_model_keeps(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    kept = {r.doc_id: r for r in corpus_pipeline.quality_stage(spark, docs, SF).collect()}
    judged = {r.doc_id: r.kept for r in quality.score(docs, quality.train(docs, labels)).collect()}
    assert set(kept) == {i for i, k in judged.items() if k} and 0 < len(kept) < len(judged)
    before = {r.doc_id: r for r in docs.where(F.col("doc_id").isin(list(kept))).collect()}
    assert kept == before
