"""Line dedup, repeated byte strings, near copies and quality rules against brute force."""

import hashlib
import random
import re

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

from adpulse.llm import graph, jaccard_join, line_dedup, quality, substring_dedup
from adpulse.llm.hashing import prefix_sums, range_hashes

DOCS = "doc_id long, text string, lang string, source string, n_chars long, size long, kept string"


def frame(spark, rows, parts=3):
    """(doc_id, text, source) rows, with extra columns whose names operators use."""
    return spark.createDataFrame([(i, t, "en", s, len(t or ""), 7, "x") for i, t, s in rows], DOCS).repartition(parts)


def words(rnd, n):
    return " ".join("".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(1, 7))) for _ in range(n))


def test_range_hashes_depend_on_the_bytes_only():
    buf = np.frombuffer(b"xxabcabcdabc", np.uint8)
    s = prefix_sums(buf)
    h = range_hashes(s, np.array([2, 5, 9, 5]), np.array([5, 8, 12, 9]))
    assert h[0] == h[1] == h[2] != h[3]


def thue_morse(n, a="a", b="b"):
    """Two words of 2**n letters that differ everywhere and in which equal powers of two weigh alike."""
    bits = [bin(i).count("1") % 2 for i in range(1 << n)]
    return "".join((a, b)[x] for x in bits), "".join((b, a)[x] for x in bits)


def test_words_of_one_form_hash_apart():
    for n in (10, 11, 12):
        x, y = thue_morse(n)
        buf = np.frombuffer((x + y + x).encode(), np.uint8)
        h = range_hashes(prefix_sums(buf), np.array([0, 1, 2]) << n, np.array([1, 2, 3]) << n)
        assert h[0] == h[2] != h[1]


def test_texts_of_one_form_are_not_taken_for_one_another(spark):
    x, y = thue_morse(11)
    rows = [(1, " ".join([x] * 3 + ["p"]), "s"), (2, " ".join([y] * 3 + ["p"]), "s"), (3, " ".join([x, "q", "w", y, "q", "w"] * 9), "s")]
    assert sorted(r.component_id for r in jaccard_join.join(frame(spark, rows)).collect()) == [1, 2, 3]
    got = {r.doc_id: r.n_repeat_words for r in quality.score(frame(spark, [(1, f"{x} u v {y} u v", "s")]), None).collect()}
    assert got == {1: 0}
    cut = [(1, "A" + x + "B"), (2, "C" + y + "D")]
    kept = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept))
            for r in substring_dedup.remove_repeats(frame(spark, [(i, t, "s") for i, t in cut])).collect()}
    assert kept == brute_repeats(cut)


# ------------------------------------------------------------------ line dedup

def brute_lines(rows, k):
    sites, first = {}, {}
    big = (1 << 63) - 1
    key = lambda i: big if i is None else i
    for i, t, s in rows:
        for at, line in enumerate((t or "").split("\n")) if t is not None else ():
            body = line.strip(line_dedup.BLANKS)
            if body:
                sites.setdefault(body, set()).add(s)
                first[body] = min(first.get(body, (big, big)), (key(i), at))
    out = []
    for i, t, s in rows:
        if t is None:
            out.append((i, None, 0))
            continue
        lines = t.split("\n")
        gone = [bool(b := x.strip(line_dedup.BLANKS)) and len(sites[b]) >= k and first[b] != (key(i), at) for at, x in enumerate(lines)]
        out.append((i, "\n".join(x for x, g in zip(lines, gone) if not g), sum(gone)))
    return out


def test_line_dedup_matches_brute_force(spark):
    rnd = random.Random(1)
    common = [words(rnd, 4) for _ in range(6)]
    rows = []
    for i in range(80):
        t = "\n".join(rnd.choice(common + ["", "  ", words(rnd, 3)]) for _ in range(rnd.randint(0, 9)))
        rows.append((i, t, rnd.choice(["a", "b", "c", "d", "e", "f", "g", "", None])))
    rows += [(100, None, "a"), (101, "", "b"), (None, common[0] + "\n" + common[1], None), rows[3], rows[3],
             (102, "\n".join(f"line {i}" for i in range(3000)) + "\n  " + common[2] + "\t", "c")]
    got = line_dedup.clean(frame(spark, rows))
    assert got.columns[:7] == [f.split()[0] for f in DOCS.split(", ")]
    have = sorted(((r.doc_id, r.text, r._n_removed) for r in got.collect()), key=repr)
    assert have == sorted(brute_lines(rows, line_dedup.MIN_SITES), key=repr)
    assert line_dedup.clean(frame(spark, [])).count() == 0


# ------------------------------------------------------------------ repeated byte strings

def brute_repeats(rows, n=100):
    seen, out = set(), {}
    for i, t in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        raw = (t or "").encode()
        gone = np.zeros(len(raw), bool)
        for a in range(len(raw) - n + 1):
            if raw[a:a + n] in seen:
                gone[a:a + n] = True
            seen.add(raw[a:a + n])
        spans = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        out[i] = (len(raw), int(gone.sum()), spans, bytes(np.frombuffer(raw, np.uint8)[~gone]))
    return out


@pytest.mark.parametrize("many", [1024, 2])
def test_substring_dedup_matches_brute_force(spark, monkeypatch, many):
    monkeypatch.setattr(substring_dedup, "MANY", many)
    rnd = random.Random(many)
    passages = ["".join(rnd.choice("abcdé \n") for _ in range(260)) for _ in range(4)]
    rows = []
    for i in range(40):
        t = ""
        for _ in range(rnd.randint(1, 5)):
            k, p = rnd.random(), rnd.choice(passages)
            if k < 0.5:
                a = rnd.randint(0, 120) * int(k > 0.25)
                t += p[a:a + rnd.randint(90, 260)]
            elif k < 0.6:
                t += rnd.choice(["a", "ab", "xyz\n"]) * rnd.randint(20, 200)
            else:
                t += "".join(rnd.choice("klmnop ") for _ in range(rnd.randint(1, 200)))
        rows.append((i, t))
    rows += [(50, None), (51, ""), (None, rows[0][1]), (52, "q" * 20_000)]
    got = {r.doc_id: r for r in substring_dedup.remove_repeats(frame(spark, [(i, t, "s") for i, t in rows])).collect()}
    want = brute_repeats(rows)
    assert {i: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for i, r in got.items()} == want
    d = substring_dedup.digest(spark.createDataFrame([(1, b"ab", 2, 0, 0)], "doc_id long, kept binary, n_bytes long, n_removed long, n_spans long")).first()
    assert d.kept_sha256 == hashlib.sha256(b"ab").hexdigest()


def test_substring_dedup_of_repeated_rows_and_empty_table(spark):
    t = words(random.Random(5), 60)
    rows = substring_dedup.remove_repeats(frame(spark, [(1, t, "a"), (1, t, "a"), (2, t, "a")])).collect()
    assert sorted((r.doc_id, r.n_removed) for r in rows) == [(1, 0), (1, 0), (2, len(t))]
    assert substring_dedup.remove_repeats(frame(spark, [])).count() == 0


def test_substring_dedup_tells_texts_without_id_apart(spark):
    """Two texts whose 64-bit hashes agree in the lower 32 bits; only one has a copy."""
    a, b = (hashlib.sha256(str(i).encode()).hexdigest() + hashlib.sha256(f"{i}a".encode()).hexdigest() for i in (59232, 82312))
    got = substring_dedup.remove_repeats(frame(spark, [(None, a, "s"), (None, b, "s"), (1, a, "s")])).collect()
    assert sorted((r.doc_id is None, bytes(r.kept).decode()) for r in got) == sorted([(True, ""), (True, b), (False, a)])


def test_windows_of_a_split_anchor_do_not_grow_with_the_copies():
    """A passage between different neighbours: what leaves a task does not hold it once a document."""
    rnd = random.Random(6)
    passage = bytes(rnd.choices(b"abcdefgh ", k=160))

    def dealt(n):
        rows = []
        for i in range(n):
            raw = b"%039d" % rnd.randrange(10**39) + bytes([i]) + passage + bytes([i]) + b"%039d" % rnd.randrange(10**39)
            rows.append((i, 0, raw, [{"edge": 2, "a": 0, "n": len(raw) - substring_dedup.LENGTH + 1, "h": 5}]))
        edges = pa.array([r[3] for r in rows], pa.list_(pa.struct([(k, pa.int64()) for k in ("edge", "a", "n", "h")])))
        batch = pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows]), pa.array([r[1] for r in rows]),
                                            pa.array([r[2] for r in rows], pa.binary()), edges], names=["doc", "t", "raw", "edges"])
        return pd.concat([b.to_pandas() for b in substring_dedup._cutting(4)(iter([batch]))])
    inside = 160 - substring_dedup.LENGTH + 1
    for n in (20, 200):
        rows = dealt(n)
        assert len(rows) <= 5
        first = np.frombuffer(b"".join(rows.raw[rows.bucket >= 4]), substring_dedup.WINDOW)
        assert len(first) == n * 80 + inside        # the windows that reach into a neighbour, and the passage's once
        found = pd.concat([substring_dedup._expand(part, 4) for _, part in rows.groupby("bucket")])
        assert sorted(zip(found.doc, found.a, found.n)) == [(i, 40, inside) for i in range(1, n)]


# ------------------------------------------------------------------ near copies

def brute_groups(rows):
    def shingles(t):
        w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
        return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) > 4 else {tuple(w)} if w else set()
    sets = [shingles(t) for _, t, _ in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    out = []
    for i, (d, _, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        out.append((d, len(sets[i]), d if not sets[i] else min(ids) if ids else None))
    return sorted(out, key=repr)


def near_rows():
    rnd = random.Random(9)
    rows, passage = [], words(rnd, 30)
    for g in range(12):
        base = words(rnd, rnd.randint(3, 120)).split()
        for _ in range(rnd.randint(1, 8)):
            w = list(base)
            for _ in range(rnd.randint(0, 4)):
                w[rnd.randrange(len(w))] = words(rnd, 1)
            t = " ".join(w)
            rows.append((len(rows) * 3 % 101, (passage + " " + t) if rnd.random() < 0.4 else t.upper() if rnd.random() < 0.2 else t, "s"))
    return rows + [(200, None, "s"), (201, "", "s"), (202, " \n\t", "s"), (203, "One two", "s"), (204, "one TWO", "s"), (205, "two one", "s"),
                   (None, rows[0][1], "s"), rows[1], rows[1], (206, words(rnd, 9000), "s")]


@pytest.mark.parametrize("sets,very", [(2048, 4096), (2, 2)])
def test_jaccard_join_matches_brute_force(spark, monkeypatch, sets, very):
    monkeypatch.setattr(jaccard_join, "CLUSTER_SETS", sets)
    monkeypatch.setattr(jaccard_join, "VERY_FREQUENT", very)
    rows = near_rows()
    got = jaccard_join.join(frame(spark, rows))
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got.collect()), key=repr) == brute_groups(rows)


def test_jaccard_join_broadcasts_few_rows_only(spark, monkeypatch):
    """Clusters of many parts and more keys than may be broadcast: what reaches the driver
    stays within its bound, and the groups are the same."""
    rows, sent, broadcast = near_rows(), [], jaccard_join.F.broadcast
    monkeypatch.setattr(jaccard_join.F, "broadcast", lambda df: sent.append(df.count()) or broadcast(df))
    monkeypatch.setattr(jaccard_join, "CLUSTER_SETS", 2)

    def groups(few, frequent):
        monkeypatch.setattr(jaccard_join, "FEW", few, raising=False)
        monkeypatch.setattr(jaccard_join, "FREQUENT", frequent)
        got = jaccard_join.join(frame(spark, rows))
        return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got.collect()), key=repr)

    assert groups(len(rows), 100_000) == brute_groups(rows)
    assert 0 < max(sent) <= len(rows)        # rows of sets, not of pairs of parts
    sent.clear()
    assert groups(5, 10) == brute_groups(rows)
    assert not sent


def test_keep_one_of_each_group(spark):
    rows = near_rows()
    kept = [r.doc_id for r in jaccard_join.keep_one(frame(spark, rows)).collect()]
    want = {c for d, n, c in brute_groups(rows) if n} | {200, 201, 202}
    assert sorted(kept) == sorted(want)
    assert jaccard_join.join(frame(spark, [])).count() == 0


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, j) for j in range(101, 160)] + [(7, 7)]
    got = {r.u: r.v for r in graph.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {i: 0 for i in range(1, 41)} | {j: 100 for j in range(101, 160)}


# ------------------------------------------------------------------ quality rules

def test_quality_base_rules_match_brute_force(spark):
    rnd = random.Random(2)
    rows = [(i, " ".join(rnd.choice([words(rnd, 3), "a b c", "x#*$%&|<>", "é ü\n", "l\nl\n", " "]) for _ in range(rnd.randint(1, 60))), "s") for i in range(40)]
    rows += [(90, None, "s"), (91, "", "s"), (92, "a b c " * 500, "s"), (None, "q", "s"), rows[0], rows[0]]
    got = sorted(((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed, r.kept)
                  for r in quality.score(frame(spark, rows), None).collect()), key=repr)
    want = []
    for i, t, _ in rows:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        lines, seen, dup = t.split("\n"), set(), 0
        for x in lines:
            if re.search(r"[^\x20\x09-\x0D]", x):
                dup += x in seen
                seen.add(x)
        grams = [tuple(w[k:k + 3]) for k in range(len(w) - 2)]
        again = {k + j for k, g in enumerate(grams) if grams.count(g) > 1 for j in range(3)}
        failed = len(w) < 50 or 100 * len(again) > 50 * len(w)
        want.append((i, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(again), failed, not failed))
    assert got == sorted(want, key=repr)
    assert quality.score(frame(spark, []), None).count() == 0


def test_quality_model_tells_held_out_labels(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    train = labels.where("doc_id % 2 = 0")
    model = quality.train(docs, train, rows=1500)
    test = docs.join(labels.where("doc_id % 2 = 1 and quality is not null").groupBy("doc_id").max("quality"), "doc_id")
    got = quality.score(test, model).join(test.select("doc_id", test["max(quality)"].alias("y")), "doc_id").where("not base_failed").toPandas()
    assert (got.kept[got.y == 1]).mean() > 0.99 and (got.kept[got.y == 0]).mean() < 0.4
    assert quality.train(docs, labels.where("quality = 1")) is None
    kept = quality.keep_good(test.select(docs.columns), model)
    assert kept.columns == docs.columns and kept.count() == int(quality.score(test, model).where("kept").count())


def test_quality_model_learns_a_rare_class(spark):
    rnd = random.Random(8)
    good, bad = words(rnd, 80), words(rnd, 80).upper()
    docs = spark.range(0, 30_000, 1, 4).selectExpr("id as doc_id", f"if(id % 2000 = 3, '{bad}', '{good}') || id as text")
    labels = docs.selectExpr("doc_id", "cast(doc_id % 2000 != 3 as int) as quality")
    model = quality.train(docs, labels.unionAll(labels), rows=200)
    got = {r.doc_id: r.probability for r in quality.score(docs.where("doc_id < 2010"), model).collect()}
    assert got[3] < 0.5 < got[4]
