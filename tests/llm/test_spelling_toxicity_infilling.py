"""Toxicity, spelling variants and the fill-in-middle transformation."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from adpulse.llm import fill_in_middle, queries, spelling, toxicity

from .test_text_operators import frame

SF = "/root/testdata/sf0.01"


# ---------------------------------------------------------------- toxicity


def test_chain_sums_all_taggings():
    rng = np.random.default_rng(5)
    odds, step, begin = rng.normal(size=9) * 2, rng.normal(size=(2, 2)), 0.7
    opens = np.array([1, 0, 0, 0, 1, 1, 0, 0, 0], bool)
    chain = toxicity.Chain(odds, opens, step, begin)
    toxic, pairs = np.zeros(9), np.zeros((2, 2))
    for a, b in ((0, 4), (4, 5), (5, 9)):
        total, marks, moves = 0.0, np.zeros(b - a), np.zeros((2, 2))
        for tags in itertools.product((0, 1), repeat=b - a):
            w = np.exp(begin * tags[0] + sum(odds[a + i] * t for i, t in enumerate(tags)) + sum(step[i, j] for i, j in itertools.pairwise(tags)))
            total += w
            marks += w * np.array(tags)
            for i, j in itertools.pairwise(tags):
                moves[i, j] += w
        toxic[a:b], pairs = marks / total, pairs + moves / total
    assert np.allclose(chain.toxic, toxic) and np.allclose(chain.pairs(opens), pairs)


def test_chain_is_the_same_across_blocks():
    """A chain of many blocks against plain recursion."""
    rng = np.random.default_rng(6)
    n = 5 * toxicity.BLOCK + 17
    odds, step = rng.normal(size=n) * 3, np.array([[0.0, -1.0], [0.5, 0.8]])
    opens = np.zeros(n, bool)
    opens[[0, 300]] = True
    m = [np.exp(np.where(opens[t], [[0, 0.2], [0, 0.2]], step) + np.array([0, odds[t]])) for t in range(n)]
    before, after, v = [], [None] * n, np.ones(2)
    for t in range(n):
        v = v @ m[t]
        v = v / v.sum()
        before.append(v)
    v = np.ones(2)
    for t in range(n - 1, -1, -1):
        after[t] = v
        v = m[t] @ v
        v = v / v.sum()
    p = np.array(before) * np.array(after)
    assert np.allclose(toxicity.Chain(odds, opens, step, 0.2).toxic, p[:, 1] / p.sum(axis=1))


def test_field_learns_from_labelled_words():
    """Tags that depend on the word before: only neighbours can tell them."""
    rnd = random.Random(1)
    texts, tags = [], []
    for _ in range(300):
        ws = [rnd.choice(["very", "not", "bad", "good", "day"]) for _ in range(12)]
        texts.append(ws)
        tags.append(np.array([w == "bad" and i > 0 and ws[i - 1] == "very" for i, w in enumerate(ws)]))
    model = toxicity.fit(texts[:250], tags[:250], steps=150)
    p, start, end = toxicity.Field(model).probabilities(texts[250:])
    assert ((p >= 0.5) == np.concatenate(tags[250:])).mean() > 0.99
    assert start[0] == 0 and end[-1] == len(p)


def test_toxicity_on_held_out_documents(spark):
    got = queries.op11(spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").where("held_out").collect()
    assert sum(r.predicted == r.toxic for r in got) / len(got) > 0.93
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert queries.op11(spark, SF).count() == docs.count()


def toxic_rows():
    rnd = random.Random(2)
    plain = ["".join(rnd.choice("aeinorst") for _ in range(rnd.randint(3, 7))) for _ in range(400)]
    rows, labels = [], []
    for i in range(400):
        ws = [rnd.choice(plain) for _ in range(40)]
        if i % 4 == 0:
            for _ in range(3):
                ws.insert(rnd.randrange(len(ws)), rnd.choice(["vileword", "Vilest", "VILEN"]))
        rows.append((i, " ".join(ws), "s"))
        labels.append((i, int(i % 4 == 0)))
    return rows, labels


def test_toxicity_spans_edges_and_clashing_names(spark):
    rows, labels = toxic_rows()
    odd = [(1001, None, "s"), (1002, "", "s"), (1003, " \n", "s"), (None, "so vileword!", "s"), (1004, "é vilen, " + "a b " * 300_000, "s"),
           (1005, "eine Vileword Vilest da", "s"), (1005, "eine Vileword Vilest da", "s")]
    docs = frame(spark, rows + odd).withColumn("spans", F.lit(1)).withColumn("toxic", F.lit(1)).withColumn("score", F.lit("x"))
    lab = spark.createDataFrame(labels + [(None, 1), (3, None), (1, 7), (0, 1)], "doc_id long, toxic int")
    model = toxicity.train(docs, lab)
    got = toxicity.score(docs, model).collect()
    assert len(got) == len(rows) + len(odd)
    text = {i: t for i, t, _ in rows}
    for r in got:
        if r.doc_id is not None and r.doc_id < 1000:
            assert r.predicted == int(r.doc_id % 4 == 0) and 0 <= r.score <= 1
            assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
            for s in r.spans:
                assert all(w.lower().startswith("vile") for w in text[r.doc_id][s.start:s.end].split())
    by = {r.doc_id: r for r in got}
    assert [tuple(s) for s in by[1005].spans] == [(5, 20)] and [tuple(s) for s in by[1004].spans] == [(2, 7)]
    assert not by[None].held_out and [tuple(s) for s in by[None].spans] == [(3, 11)]
    assert by[1001].score == by[1002].score == by[1003].score < 0.5 and by[1001].spans == []
    again = {r.doc_id: r.score for r in toxicity.score(docs.repartition(5), toxicity.train(docs.repartition(2), lab)).collect()}
    assert again == {r.doc_id: r.score for r in got}


def test_toxicity_without_labels_or_rows(spark):
    docs = frame(spark, [(1, "a", "s"), (2, None, "s")])
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert [r.score for r in toxicity.score(docs, toxicity.train(docs, none)).collect()] == [0.0, 0.0]
    one = spark.createDataFrame([(1, 1), (2, 1)], "doc_id long, toxic int")
    assert {r.predicted for r in toxicity.score(docs, toxicity.train(docs, one)).collect()} == {1}
    both = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, toxic int")     # nothing certain among so few
    assert {r.score for r in toxicity.score(docs, toxicity.train(docs, both)).collect()} <= {0.0, 0.5, 1.0}
    empty = frame(spark, [])
    assert toxicity.score(empty, toxicity.train(empty, one)).count() == 0


# ---------------------------------------------------------------- spelling variants


def brute_variants(rows):
    counts = Counter()
    for i, t, _ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 199 == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1:]
            if len(run) >= 6:
                counts[run] += 1
    voc = {w: n for w, n in counts.items() if n >= 5}

    def near(a, b):
        if a == b or abs(len(a) - len(b)) > 1:
            return False
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        return any(b[:k] + b[k + 1:] == a for k in range(len(b)))

    out, form = {}, {}
    for w, n in voc.items():
        ns = sorted(((-voc[v], v) for v in voc if near(w, v)))
        if ns and -ns[0][0] >= 5 * n:
            form[w] = ns[0][1]
        out[w] = (n, len(ns))

    def root(w):
        return root(form[w]) if w in form else w
    return {w: (form.get(w), root(w), n, k, voc[form[w]] if w in form else None) for w, (n, k) in out.items()}


def variant_rows():
    rnd = random.Random(8)
    stems = ["".join(rnd.choice("abcé÷z") for _ in range(rnd.randint(5, 9))) for _ in range(12)] + ["ÀÉÎÕÜÿ", "ßßßßßß"]
    words = list(stems)
    for w in stems * 4:
        k = rnd.randrange(len(w))
        words.append(rnd.choice([w[:k] + w[k + 1:], w[:k] + rnd.choice("abz÷") + w[k:], w[:k] + rnd.choice("abÿz") + w[k + 1:]]))
    bag = [w for w in words for _ in range(rnd.choice([2, 5, 6, 30, 160, 900]))] + ["chains"] * 2000 + ["chaint"] * 300 + ["chairt"] * 40 + ["cheirt"] * 6
    rnd.shuffle(bag)
    rows = [(i, " ".join(w.upper() if rnd.random() < 0.2 and w.isascii() else w for w in bag[k:k + 60]), "s")
            for i, k in enumerate(range(0, len(bag), 60))]
    return rows + [(None, "chains chains, no9chains_chains", "s"), (7001, None, "s"), (7002, "", "s"), rows[3], rows[3],
                   (7003, "longer" * 3000 + " " + "日本chains", "s")]


@pytest.mark.parametrize("bits", [1 << 28, 512])
def test_variants_match_brute_force(spark, monkeypatch, bits):
    """A small bound splits the vocabulary into many passes; the result stays."""
    monkeypatch.setattr(spelling, "MOST_BITS", bits)
    monkeypatch.setattr(spelling, "CHUNK", 8)
    rows = variant_rows()
    docs = frame(spark, rows).withColumn("word", F.lit("x")).withColumn("n", F.lit(1)).withColumn("form", F.lit(1)).withColumn("run", F.lit(1))
    got = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling.group(docs).collect()}
    want = brute_variants(rows)
    assert got == want
    assert got["cheirt"][:2] == ("chairt", "chains") and any(v[0] is None and v[3] for v in want.values())


def test_variants_of_an_empty_table(spark):
    assert spelling.group(frame(spark, [])).collect() == []
    assert spelling.group(frame(spark, [(1, None, "s"), (2, "short ones", "s")])).collect() == []


# ---------------------------------------------------------------- fill in the middle


def test_rank_index_is_exact():
    rng = np.random.default_rng(9)
    steps = [np.ones(5000, int), rng.integers(1, 12, 20_000), np.concatenate([np.ones(3000, int), [100_000], np.full(3000, 7)]),
             rng.integers(1, 3, 7), np.array([], int), rng.geometric(0.001, 3000)]
    for s in steps:
        offsets = np.append(0, np.cumsum(s)).astype(np.int64)
        index = fill_in_middle.RankIndex(offsets)
        assert index.residual.dtype == np.int8 and [index.offset(k) for k in range(len(offsets))] == offsets.tolist()
        assert max(abs(index.predict(k) - offsets[k]) for k in range(len(offsets))) <= 127
        assert len(index.first) < max(2, len(offsets) / 10) or s.size and s.max() > 1000
    assert len(fill_in_middle.RankIndex(np.arange(5001)).first) == 1


def brute_middle(i, t):
    w = re.findall("[A-Za-z]+|[^A-Za-z]", t or "")
    n, h = len(w), hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest()
    h = [int(h[k:k + 8], 16) for k in (0, 8, 16, 24)]
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(w[:a]), "".join(w[a:b]), "".join(w[b:])
    if not t or any(x in t for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, t or ""
    if h[3] % 100 < 20:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_fill_in_middle_matches_brute_force(spark):
    rnd = random.Random(10)
    odd = ["", None, "<P>", "a<S>b", "x <M", "<", "<P<S<M", "S>P>M>", "héé日本 \U0001F600x", "\n\r\x00  a", "word" * 50_000, "a b " * 100_000,
           " ", "ab", "Iİı ſK"]
    texts = odd * 6 + ["".join(rnd.choice("ab <PSM>\né") for _ in range(rnd.randint(1, 40))) for _ in range(300)]
    texts += [" ".join("x" * rnd.randint(1, 40) for _ in range(5000)) for _ in range(3)]
    rows = [(i, t, "s") for i, t in enumerate(texts)] + [(None, "no id here at all", "s"), (9005, "again", "s"), (9005, "again", "s")]
    docs = frame(spark, rows).withColumn("output", F.lit("x")).withColumn("form", F.lit(1)).withColumn("n", F.lit("y"))
    made = fill_in_middle.transform(docs)
    got = made.withColumn("restored", fill_in_middle.restore(F.col("output"), F.col("form"))).collect()
    want = Counter((i, *brute_middle(i, t), t or "") for i, t, _ in rows)
    assert Counter((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.restored) for r in got) == want
    assert {r.form for r in got} == {"plain", "psm", "spm"} and any(r.n_segments > 1 for r in got)
    digest = fill_in_middle.digest(made).where("doc_id = 9005").collect()
    assert [r.restored_sha256 for r in digest] == [hashlib.sha256(b"again").hexdigest()] * 2
    assert fill_in_middle.transform(frame(spark, [])).count() == 0
