"""Operators over pairs and whole corpora against brute force."""

import collections
import hashlib
import math
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from skiff.llm import ann, components, decontam, induced, lm, neardup, passages, substrings

from .conftest import word_list

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")


def shingle_counts(text):
    w = word_list(text)
    return collections.Counter([tuple(w[i : i + 5]) for i in range(len(w) - 4)] if len(w) >= 5 else [tuple(w)])


def roots(nodes, links):
    up = {n: n for n in nodes}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        x, y = find(a), find(b)
        up[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def near_classes(rows):
    counts = {}
    for i, t in rows:
        if i is not None:
            counts[i] = shingle_counts(t)
    ids, links = sorted(counts), []
    for x, a in enumerate(ids):
        for b in ids[x + 1 :]:
            both = sum((counts[a] & counts[b]).values())
            if both >= 0.8 * (sum(counts[a].values()) + sum(counts[b].values()) - both) - 1e-9:
                links.append((a, b))
    return roots(ids, links)


def test_near_classes(spark, docs, awkward, nothing):
    for frame in (docs, awkward):
        want = near_classes([(r.doc_id, r.text) for r in frame.collect()])
        assert {r.doc_id: r.class_id for r in neardup.classes(frame.select("doc_id", "text")).collect()} == want
    assert neardup.classes(nothing).count() == 0
    kept = neardup.keep_one(awkward)
    assert kept.columns == awkward.columns and {1, 4, 6, 7, None} <= {r.doc_id for r in kept.collect()}


def test_large_buckets_are_compared_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(neardup, "CHUNK", 4)
    base = [f"w{k}" for k in range(120)]
    rows = [(i, " ".join(base[:i] + [f"edit{i}"] + base[i:])) for i in range(1, 40)] + [(100 + i, " ".join(f"u{i}_{k}" for k in range(50))) for i in range(5)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: r.class_id for r in neardup.classes(frame).collect()} == near_classes(rows)


def test_components_of_a_chain(spark):
    links = spark.createDataFrame([(k, k + 1) for k in range(60)] + [(100, 101), (5, 5)], "a long, b long")
    got = {r.node: r.root for r in components.components(links).collect()}
    assert got == {**{k: 0 for k in range(61)}, 100: 100, 101: 100}


def removed(rows):
    first, out = {}, {}
    for i, t in sorted(rows):
        b = (t or "").encode()
        cover = bytearray(len(b))
        for k in range(len(b) - 49):
            if first.setdefault(b[k : k + 50], i) < i:
                cover[k : k + 50] = b"\1" * 50
        kept = bytes(x for x, c in zip(b, cover) if not c)
        runs = sum(1 for k in range(len(b)) if cover[k] and (k == 0 or not cover[k - 1]))
        out[i] = (len(b), sum(cover), runs, hashlib.sha256(kept).hexdigest())
    return out


def test_substrings(spark, docs, awkward, nothing):
    for frame in (docs, awkward.where("doc_id is not null").select("doc_id", "text")):
        want = removed([(r.doc_id, r.text) for r in frame.collect()])
        rows = substrings.repeated(frame).collect()
        assert len(rows) == frame.count()
        assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows} == want
    assert substrings.repeated(nothing).count() == 0
    assert substrings.repeated(awkward).count() == awkward.count()


@pytest.mark.parametrize("budget", [1 << 28, 16])
def test_induced_sorting(budget):
    rng = np.random.default_rng(3)
    for _ in range(40):
        parts = [bytes(rng.integers(97, 97 + rng.integers(1, 4), rng.integers(1, 90)).astype(np.uint8)) for _ in range(rng.integers(1, 6))]
        data = b"\0".join(parts) + b"\0"
        sa, lcp = induced.suffix_array(np.frombuffer(data, np.uint8), budget)
        assert sorted(sa.tolist()) == list(range(len(data)))
        padded = data + b"\0" * 60
        for x, y, n in zip(sa, sa[1:], lcp[1:]):
            a, b = padded[x : x + 50], padded[y : y + 50]
            assert a <= b and min(n, 50) == next((k for k in range(50) if a[k] != b[k]), 50)


def test_lm_base_and_model(spark, docs, awkward, nothing):
    for frame in (docs, awkward):
        texts = [(r.doc_id, r.text) for r in frame.collect()]
        split = lambda t: [x for x in re.split(rb"[\x20\x09-\x0d]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (t or "").encode())) if x] + [None]
        train = lambda i: i is None or zlib.crc32(str(i).encode()) % 5 != 1
        c = collections.Counter(x for i, t in texts if train(i) for x in split(t))
        n, v = sum(c.values()), len(c)
        rows = lm.score(frame.select("doc_id", "text")).collect()
        assert len(rows) == len(texts)
        want = sorted((i or 0, len(split(t)), sum(c[x] > 0 for x in split(t))) for i, t in texts)
        assert sorted((r.doc_id or 0, r.n_tokens, r.n_known) for r in rows) == want
        by = {i: sum(math.log10((c[x] + 0.5) / (n + 0.5 * (v + 1))) for x in split(t)) for i, t in texts}
        assert all(r.train_tokens == n and math.isclose(r.base_score, by[r.doc_id], rel_tol=1e-9) and r.score < 0 for r in rows)
        if frame is docs:  # the model explains held-out texts better than the base
            held = [r for r in rows if r.held_out]
            assert sum(r.score for r in held) > sum(r.base_score for r in held)
    assert lm.score(nothing).count() == 0


def test_lm_rare_contexts_count(spark):
    """Pairs seen five times in training: a held-out text of these pairs beats the same words in other pairs."""
    held = [k for k in range(10_000, 10_100) if zlib.crc32(str(k).encode()) % 5 == 1][:2]
    train = [k for k in range(2000) if zlib.crc32(str(k).encode()) % 5 != 1][:500]
    rows = [(k, " ".join(f"x{j % 100} y{j % 100}" for j in range(i, i + 1))) for i, k in enumerate(train)]
    rows += [(held[0], " ".join(f"x{j} y{j}" for j in range(100))), (held[1], " ".join(f"x{j} y{(j + 50) % 100}" for j in range(100)))]
    got = {r.doc_id: r for r in lm.score(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[held[0]].held_out and math.isclose(got[held[0]].base_score, got[held[1]].base_score)
    assert got[held[0]].score > got[held[1]].score + 50


def test_lm_of_split_restaurants(spark, docs):
    """Restaurants split over shards explain held-out texts about as well as whole ones."""
    def total(**more):
        rows = [r for r in lm.score(docs, **more).collect() if r.held_out]
        return sum(r.score for r in rows), sum(r.base_score for r in rows)

    whole, base = total()
    split, same = total(split=300)
    assert same == base and abs(split - whole) < 0.02 * abs(base - whole)


def test_passages(spark, docs, awkward, nothing):
    found = collections.defaultdict(set)
    for r in passages.passages(docs).collect():
        found[r.doc_id].add(r.source_id)
    texts = {r.doc_id: word_list(r.text) for r in docs.collect()}
    sh = {i: [tuple(w[k : k + 5]) for k in range(len(w) - 4)] for i, w in texts.items()}
    want = collections.defaultdict(set)
    for d in sorted(sh):
        for e in sorted(x for x in sh if x < d):
            other, sums = set(sh[e]), [0]
            for x in sh[d]:
                sums.append(sums[-1] + (x in other))
            if any(sums[k + 46] - sums[k] >= 41 for k in range(len(sh[d]) - 45)):
                want[d].add(e)
    assert set(found) == set(want) and all(found[d] <= want[d] for d in found)
    assert {r.doc_id for r in passages.passages(awkward).collect()} >= {2, 3}
    assert passages.passages(nothing).count() == 0


def test_passages_behind_a_smaller_text_that_shares_a_part(spark):
    """Copies in b and c of passages whose first half an unrelated smaller text has too."""
    n, rows = 200, [(k, " ".join(f"common{j}" for j in range(12)) + " " + " ".join(f"h{k}x{j}" for j in range(40))) for k in range(-300, 0)]
    for k in range(n):
        passage = [f"p{k}w{j}" for j in range(50)]
        around = lambda name: [f"{name}{k}v{j}" for j in range(30)]
        rows += [(k, " ".join(around("a") + passage[:27] + around("i"))),
                 (n + k, " ".join(around("b") + passage + around("j"))), (2 * n + k, " ".join(around("c") + passage + around("l")))]
    got = {(r.doc_id, r.source_id): r for r in passages.passages(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()}
    assert set(got) == {(2 * n + k, n + k) for k in range(n)}
    assert all(r.start_word <= 30 and r.end_word >= 80 and r.shared >= 41 for r in got.values())


def test_similar_links_connect_all_similar_windows():
    rng = np.random.default_rng(5)
    common = rng.integers(0, 1 << 24, 46)
    rows, doc = [], []
    for k in range(60):  # four texts, each in 15 documents, and a line that all share
        own = np.concatenate([common[:10], np.random.default_rng(100 + k % 4).integers(0, 1 << 24, 50)]) if k % 5 else rng.integers(0, 1 << 24, 60)
        own[:10] = common[:10]
        rows.append(own)
        doc.append(k)
    size = np.array([len(x) for x in rows])
    links = passages.similar_links(np.zeros(60, np.int64), np.array(doc), np.zeros(60, bool), size, np.concatenate(rows))
    for k, group in roots(range(60), links).items():
        assert group == (min(j for j in range(60) if j % 4 == k % 4 and j % 5) if k % 5 else k)
    assert len(links) == 48 - 4 and all(i > j for i, j in links)


def test_similar_links_of_copies_and_joined_windows():
    """Random groups with copies, repeated documents and joined windows, against all pairs."""
    for seed in range(12):
        rng = np.random.default_rng(seed)
        base = rng.integers(0, 1 << 24, (4, 60))
        rows, doc, group = [], np.sort(rng.integers(0, 25, 60)), np.repeat([0, 1], 30)
        for k in range(60):
            own = base[rng.integers(0, 4)].copy()
            own[rng.integers(0, 60, rng.choice([0, 0, 4, 12, 40]))] = rng.integers(0, 1 << 24)
            rows.append(own[: rng.integers(46, 61)])
        joined = (rng.random(60) < 0.3) & (group == 0)
        links = passages.similar_links(group, doc, joined, np.array([len(x) for x in rows]), np.concatenate(rows))
        star = [[(a, b) for a in np.flatnonzero(joined) for b in np.flatnonzero(joined)]]
        pairs = []
        for i in range(60):
            for j in range(i):
                sums = np.concatenate([[0], np.cumsum(np.isin(rows[i], rows[j]))])
                if group[i] == group[j] and doc[i] != doc[j] and (sums[46:] - sums[:-46] >= 41).any():
                    pairs.append((i, j))
        assert set(links) <= set(pairs) and roots(range(60), links + star[0]) == roots(range(60), pairs + star[0])


def test_candidates_of_passages():
    """The interval join, against plain counting."""
    rng = np.random.default_rng(8)
    n = 4000
    row, source, f = rng.integers(0, 40, n), rng.integers(0, 8, n), rng.integers(0, 6, n)
    l = rng.integers(0, 300, n)
    r = l + 45 + rng.integers(0, 30, n)
    some = rng.random(n) < rng.random(40)[row] * 0.7
    row, source, f, l, r = (x[some] for x in (row, source, f, l, r))
    want = set()
    for pair in set(zip(row.tolist(), source.tolist())):
        cover = np.zeros((6, 500), bool)
        for k in np.flatnonzero((row == pair[0]) & (source == pair[1])):
            cover[f[k], l[k] : r[k] + 1] = True
        sums = np.concatenate([[0], np.cumsum(cover.sum(0) >= 2)])
        if (sums[46:] - sums[:-46] >= 41).any():
            want.add(pair)
    keep = passages.candidates(row, source, f, l, r)
    pairs = list(zip(row.tolist(), source.tolist()))
    assert 0 < len(want) < len(set(pairs)) and [k for k in pairs if k in want] == [k for k, hit in zip(pairs, keep) if hit]


def test_only_candidates_borrow_shingles(spark, tmp_path, monkeypatch):
    """Texts that share a line by chance ask for nothing; a text with a copied passage asks its source."""
    own = lambda k, n: [f"t{k}v{j}" for j in range(n)]
    rows = [(100 * g + k, " ".join(own(100 * g + k, 50) + [f"line{g}x{j}" for j in range(5)] + own(-100 * g - k - 1, 50))) for g in range(12) for k in range(30)]
    rows += [(5000 + k, " ".join(own(5000 + k, 20) + [f"passage{j}" for j in range(70)])) for k in range(2)]
    monkeypatch.setattr(passages, "run_folder", lambda docs, label: f"{tmp_path}/{label}")
    got = passages.passages(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert [(r.doc_id, r.source_id) for r in got] == [(5001, 5000)] and got[0].start_word <= 20 and got[0].end_word == 90
    links = spark.read.parquet(f"{tmp_path}/passages/links").where("kind = 1").count()
    assert links > 1 and {r.source for r in spark.read.parquet(f"{tmp_path}/passages/lent").collect()} == {5000}


def test_leaks(spark, docs, awkward, nothing):
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    cut = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    many = lambda w: collections.Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4))
    planted = [(1000 + k, "lead in words here " + r.text + " and after") for k, r in enumerate(items.limit(5).collect())]
    frame = docs.unionByName(spark.createDataFrame(planted, "doc_id long, text string"))
    want = {}
    for r in items.collect():
        b = many(cut(r.text))
        m = sum(b.values())
        for d in frame.collect():
            w, best = cut(d.text), 0
            if not set(many(w)) & set(b):
                continue
            for k in range(max(1, len(w) - 4 - m + 1)):
                a = many(w[k : k + m + 4])
                both = sum((a & b).values())
                best = max(best, both / (sum(a.values()) + m - both))
            if best >= 0.8:
                want[d.doc_id, r.item_id] = best
    got = {(r.doc_id, r.item_id): r.similarity for r in decontam.leaks(frame, items).collect()}
    assert set(got) == set(want) and all(math.isclose(got[k], want[k]) for k in got)
    assert decontam.leaks(nothing, items).count() == 0
    assert decontam.leaks(docs, items.limit(0)).count() == 0
    named = awkward.withColumn("leak", F.col("score")).withColumn("first", F.col("score"))
    kept = decontam.drop_leaks(named, items)
    assert kept.columns == named.columns and kept.count() == named.count()


def test_windows_meet_items_through_their_fingerprints(spark, monkeypatch):
    """With the opposite fingerprints for the windows, no item is found."""
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    frame = spark.createDataFrame([(k, "lead in words here " + r.text + " and after") for k, r in enumerate(items.limit(5).collect())], "doc_id long, text string")
    assert decontam.leaks(frame, items).select("doc_id").distinct().count() == 5
    real = decontam._fingerprint
    monkeypatch.setattr(decontam, "_fingerprint", lambda array: F.bitwise_not(real(array)) if array == "win" else real(array))
    assert decontam.leaks(frame, items).count() == 0


def test_keep_one_of_rows_without_an_order(spark, awkward):
    odd = awkward.withColumn("first", F.create_map(F.lit("k"), F.col("score"))).withColumn("row", F.array(F.col("first")))
    kept = neardup.keep_one(odd)
    ids = [r.doc_id for r in kept.collect()]
    assert kept.columns == odd.columns and len(ids) == len(set(ids)) and None in ids and 8 not in ids


def test_neighbours(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(900, 16)).round(3)
    rows = [(k, x[k].tolist()) for k in range(900)] + [(1000 + k, x[0].tolist()) for k in range(300)]
    rows += [(2000, None), (2001, [0.0] * 16), (2002, [float("nan")] * 16), (2003, [None] * 16), (2004, [1.0]), (0, x[0].tolist())]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = collections.defaultdict(list)
    for r in ann.search(frame, F.col("vec_id") % 50 == 0).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.score, r.vec_id))
    good = {i: np.array(v) for i, v in rows if v and len(v) == 16 and all(e is not None and np.isfinite(e) for e in v) and any(v)}
    hit = total = 0
    for q in (i for i in good if i % 50 == 0):
        near = sorted((float(np.sqrt(((good[q] - v) ** 2).sum())), i) for i, v in good.items() if i != q)[:10]
        hit += len({i for _, i in near} & {i for _, i in got[q]})
        total += 10
        assert got[q] == sorted(got[q]) and len(got[q]) == 10
    assert hit / total >= 0.9 and not {2000, 2001, 2002, 2003, 2004} & set(got)
    assert ann.search(frame.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_vectors_of_an_odd_length_and_repeated_ids(spark):
    rng = np.random.default_rng(4)
    rows = [(k, rng.normal(size=8).round(3).tolist()) for k in range(200)]
    odd = [(500 + k, [1.0, 2.0, 3.0]) for k in range(40)] + [(0, [9.0] * 8), (600, [1.0])]
    for few in (rows + odd, odd + rows):
        got = collections.defaultdict(list)
        for r in ann.search(spark.createDataFrame(few, "vec_id long, embedding array<double>"), F.col("vec_id") % 100 == 0).collect():
            got[r.query_id].append((r.rank, r.vec_id))
        assert sorted(got) == [0, 100]
        assert all(sorted(r for r, _ in g) == list(range(1, 11)) and max(i for _, i in g) < 200 for g in got.values())


def test_pipeline(spark):
    from skiff.llm.queries import QUERIES

    out = corpus_pipeline.run(spark, SF).collect()
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = corpus_pipeline.quality_filter(spark, docs, SF)
    want = near_classes([(r.doc_id, r.text) for r in kept.collect()])
    firsts = {i for i, c in want.items() if i == c}
    leaked = {r.doc_id for r in decontam.leaks(kept.where(F.col("doc_id").isin(list(firsts))), spark.read.parquet(f"{SF}/benchmark.parquet")).collect()}
    assert {r.doc_id for r in out} == firsts - leaked
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "near_dedup", "decontaminate", "secrets", "encode"]
    assert sorted(QUERIES) == sorted(["op1_ann", "op2_toxicity", "op3_neardup", "op4_passages", "op5_secrets", "op6_quality", "op7_substrings", "op8_lm", "op9_decontamination", "op10_bpe",
                                      "op11_centroids", "op12_sentencepiece", "op13_alignment"])
