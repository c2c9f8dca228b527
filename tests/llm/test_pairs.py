from __future__ import annotations

import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from sentrylake.llm import ann, ngram_join, queries

WORDS = [a + b for a in "bcdfglmnprst" for b in ("ana", "ero", "ilu", "ost", "un")]


def text_of(r, n):
    return " ".join(r.choice(WORDS) for _ in range(n))


def changed(r, text, k):
    w = text.split()
    for _ in range(k):
        w[r.randrange(len(w))] = r.choice(WORDS)
    return " ".join(w)


def brute(rows):
    """doc_id -> (class, links) over all pairs of sets of word 5-grams."""
    sets = {}
    for d, t in rows:
        w = __import__("re").findall(r"\w+", (t or "").lower())
        sets[d] = {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    ids, links, parent = sorted(sets), defaultdict(int), {d: d for d in sets}

    def root(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            x, y = sets[a], sets[b]
            if (x == y) or (x | y and len(x & y) / len(x | y) >= 0.8):
                links[a] += 1
                links[b] += 1
                p, q = root(a), root(b)
                parent[max(p, q)] = min(p, q)
    return {d: (root(d), links[d]) for d in ids}


def corpus(seed=0):
    r, rows = random.Random(seed), []
    for _ in range(12):
        base = text_of(r, r.randint(6, 120))
        rows += [base] * r.randint(1, 4) + [changed(r, base, r.randint(0, 4)) for _ in range(r.randint(0, 12))]
    rows += [text_of(r, 40) for _ in range(30)] + ["", None, "one", "ONE!", "one two three four", "!!"]
    r.shuffle(rows)
    return list(enumerate(rows, 10))


def found(df):
    return {r["doc_id"]: (r["class_id"], r["n_links"]) for r in df.collect()}


@pytest.mark.parametrize("blocks, block, shingles, hub", [(8, 512, 1 << 20, 256), (1, 3, 1 << 20, 2), (2048, 2, 1 << 20, 256), (8, 512, 150, 3), (0, 512, 1 << 20, 256)])
def test_join_equals_all_pairs(spark, monkeypatch, blocks, block, shingles, hub):
    """Whether classes travel as groups or as buckets, in few blocks or many, the links are the same."""
    for name, value in {"BLOCKS": blocks, "BLOCK": block, "SHINGLES": shingles, "HUB": hub}.items():
        monkeypatch.setattr(ngram_join, name, value)
    rows = corpus(blocks + block)
    docs = spark.createDataFrame(rows, "doc_id int, text string").withColumn("bands", F.lit("clash")).withColumn("rep", F.lit(1))
    assert found(ngram_join.near_copies(docs)) == brute(rows)


def test_join_edges(spark):
    schema = "doc_id long, text string"
    assert ngram_join.near_copies(spark.createDataFrame([], schema)).count() == 0
    rows = [(None, "a b c d e f"), (1, "a b c d e f"), (1, "a b c d e f"), (2, "a b c d e f"), (3, "w " * 60_000)]
    got = {(r["doc_id"], r["class_id"], r["copies"], r["n_links"]) for r in ngram_join.near_copies(spark.createDataFrame(rows, schema)).collect()}
    assert got == {(None, None, 1, 0), (1, 1, 3, 2), (2, 1, 3, 2), (3, 3, 1, 0)}
    kept = ngram_join.keep_one(spark.createDataFrame(rows, schema)).collect()
    assert sorted(((r["doc_id"], r["text"][:3]) for r in kept), key=repr) == [(1, "a b"), (3, "w w"), (None, "a b")]


def test_one_of_each_group_stays(spark):
    rows = corpus(5)
    docs = spark.createDataFrame([(d, t, "en", "s", 1) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = ngram_join.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({c for c, _ in brute(rows).values()})


def test_texts_that_share_an_id_are_documents_of_their_own(spark):
    r = random.Random(8)
    a, b = text_of(r, 60), text_of(r, 60)
    rows = [(1, a), (1, b), (2, changed(r, a, 1)), (3, changed(r, b, 1)), (3, b)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted((x["doc_id"], x["class_id"], x["n_links"]) for x in ngram_join.near_copies(docs).collect()) == [(1, 1, 1), (1, 1, 2), (2, 1, 1), (3, 1, 2), (3, 1, 2)]
    assert sorted((x["doc_id"], x["text"]) for x in ngram_join.keep_one(docs).collect()) == sorted([(1, a), (1, b)])


def test_long_texts_are_read_in_pieces(monkeypatch):
    r = random.Random(9)
    text = text_of(r, 400) + " é ß_9 " + "x" * 300 + "..." + text_of(r, 200)
    whole = ngram_join.shingle_set(text)
    for size in (1, 7, 100, 250):
        monkeypatch.setattr(ngram_join, "PIECE", size)
        assert list(ngram_join.shingle_set(text)) == list(whole)


def test_bands_reach_the_recall():
    for recall in (0.9, 0.99, 0.9999):
        bands, rows = ngram_join.choose_bands(0.8, recall)
        assert bands * rows <= ngram_join.HASHES and 1 - (1 - 0.8**rows) ** bands >= recall
    with pytest.raises(ValueError):
        ngram_join.choose_bands(0.1, 0.9999, 8)


def test_a_large_group_makes_rows_in_proportion(spark):
    """Of a group of n linked texts come at most a few rows each, not one per pair."""
    r = random.Random(2)
    base = text_of(r, 300)
    rows = [(i, changed(r, base, 3)) for i in range(120)]
    got = found(ngram_join.near_copies(spark.createDataFrame(rows, "doc_id long, text string")))
    assert got == brute(rows)


def test_texts_of_a_large_group_are_sent_a_few_times_and_no_link_is_lost(spark, monkeypatch):
    """A group of more than BLOCKS blocks, with pairs that bounds settle, pairs in doubt, a second group that shares half, and strangers to buckets."""
    r = random.Random(11)
    base, other = text_of(r, 90), text_of(r, 90)
    mixed = " ".join(base.split()[:45] + other.split()[:45])
    texts = [changed(r, base, r.choice([1, 1, 1, 2, 3, 6])) for _ in range(420)] + [changed(r, mixed, r.randint(0, 3)) for _ in range(60)] + [changed(r, other, 2) for _ in range(40)]
    rows = list(enumerate(texts + texts[:30]))
    r.shuffle(rows)
    sent, doubtful, plain, near = [], [], ngram_join._verified, ngram_join.near_groups._verified
    for name, value in {"BLOCK": 64, "BLOCKS": 2}.items():
        monkeypatch.setattr(ngram_join, name, value)
    monkeypatch.setattr(ngram_join, "_verified", lambda dealt: sent.append(dealt.count()) or plain(dealt))
    monkeypatch.setattr(ngram_join.near_groups, "DIFFERENCES", 150)
    monkeypatch.setattr(ngram_join.near_groups, "SHARING", 50)
    monkeypatch.setattr(ngram_join.near_groups, "_verified", lambda dealt, t: doubtful.append(dealt.count()) or near(dealt, t))
    got, wanted = found(ngram_join.near_copies(spark.createDataFrame(rows, "doc_id long, text string"))), brute(rows)
    lost = sum(n - got[d][1] for d, (_, n) in wanted.items())
    assert all(got[d][1] <= n for d, (_, n) in wanted.items()) and lost <= 0.002 * sum(n for _, n in wanted.values())
    assert {d: c for d, (c, _) in got.items()} == {d: c for d, (c, _) in wanted.items()}
    assert sum(sent) <= 30 * len(texts) and 0 < doubtful[0] <= 5 * len(texts)


def test_bounds_never_settle_a_pair_wrongly():
    r = np.random.RandomState(1)
    for _ in range(2000):
        n = r.randint(1, 40)
        lacks, has = ([set(r.choice(60, r.randint(0, m + 1), replace=False)) for _ in range(2)] for m in (n, 12))
        lacks = [{x for x in y if x < n} for y in lacks]
        a, b = (set(range(n)) - x | {100 + y for y in z} for x, z in zip(lacks, has))
        if not a | b:
            continue
        similar = len(a & b) >= 0.8 * len(a | b) - 1e-9
        sure, may = ngram_join.near_groups._bounds(n, len(lacks[0]), len(has[0]), len(lacks[1]), len(has[1]), 0.8)
        assert (not sure or similar) and (may or not similar)


def test_components(spark):
    r = random.Random(3)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(160)] + [(i, i + 1) for i in range(400, 460)] + [(500, i) for i in range(501, 560)]
    parent = {}

    def root(a):
        parent.setdefault(a, a)
        while parent[a] != a:
            a = parent[a]
        return a

    for a, b in edges:
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    got = {x["node"]: x["component"] for x in ngram_join.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {n: root(n) for n in parent if any(n in e and e[0] != e[1] for e in edges)}
    assert ngram_join.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


# Nearest neighbours.
def nearest(rows, q, k):
    vector = dict(rows)[q]
    scored = [(-float(np.dot(np.float64(v), np.float64(vector))), i) for i, v in rows if i != q]
    return [(i, -s) for s, i in sorted(scored)[:k]]


def search(spark, rows, k=20, every=5):
    df = spark.createDataFrame([(i, [float(x) for x in v] if v is not None else None) for i, v in rows], "vec_id long, embedding array<float>").withColumn("rank", F.lit("clash"))
    out = defaultdict(list)
    for r in ann.search(df, lambda c: c % every == 0, k).orderBy("query_id", "rank").collect():
        out[r["query_id"]].append((r["vec_id"], r["score"], r["rank"]))
    return out


def recall(rows, got, k):
    hits = total = 0
    for q, found in got.items():
        hits += len({i for i, *_ in found} & {i for i, _ in nearest(rows, q, k)})
        total += min(k, len(rows) - 1)
    return hits / total


@pytest.mark.parametrize("kind", ["sphere", "norms", "clusters"])
def test_recall_and_scores(spark, kind):
    r = np.random.RandomState(1)
    x = r.standard_normal((1500, 24))
    if kind == "sphere":
        x /= np.linalg.norm(x, axis=1)[:, None]
    if kind == "norms":
        x *= r.lognormal(0, 1, (1500, 1))
    if kind == "clusters":
        x = x * 0.2 + r.standard_normal((12, 24))[r.randint(0, 12, 1500)]
    rows = list(enumerate(np.float32(x)))
    got = search(spark, rows, every=20)
    assert set(got) == set(range(0, 1500, 20)) and recall(rows, got, 20) >= 0.9
    for q, found in got.items():
        assert [f[2] for f in found] == list(range(1, 21)) and q not in {f[0] for f in found}
        assert [(-s, i) for i, s, _ in found] == sorted((-s, i) for i, s, _ in found)
        for i, s, _ in found:
            assert s == pytest.approx(float(np.dot(np.float64(rows[i][1]), np.float64(rows[q][1]))), abs=1e-12)


def test_equal_vectors_ties_and_rows_that_take_no_part(spark):
    a, b = [1.0, 0.0, 0.0], [0.5, 0.5, 0.0]
    rows = [(i, a) for i in range(60)] + [(i, b) for i in range(60, 70)] + [(100, None), (105, [0.0, 0.0, 0.0]), (110, [float("nan"), 1.0, 1.0]), (115, [1.0]), (120, [float("inf"), 0.0, 0.0])]
    got = search(spark, rows)
    assert set(got) == {i for i in range(0, 70, 5)}
    assert [i for i, *_ in got[0]] == list(range(1, 21)) and [i for i, *_ in got[30]] == list(range(20))
    assert [i for i, *_ in got[60]] == [i for i, _ in nearest(rows[:70], 60, 20)]


def test_few_rows_and_none(spark):
    assert [i for i, *_ in search(spark, [(0, [1.0, 2.0]), (1, [2.0, 1.0])])[0]] == [1]
    assert search(spark, [(0, [1.0, 2.0])]) == {} and search(spark, []) == {}


def test_small_units_give_the_same(spark, monkeypatch):
    r = np.random.RandomState(2)
    rows = list(enumerate(np.float32(r.standard_normal((600, 16)))))
    whole = search(spark, rows)
    monkeypatch.setattr(ann, "UNIT", 16)
    monkeypatch.setattr(ann, "CHUNK", 8)
    assert recall(rows, search(spark, rows), 20) >= 0.9 and recall(rows, whole, 20) >= 0.9


def test_candidates_are_abandoned_early():
    r = np.random.RandomState(3)
    x = r.standard_normal((4000, 64)) * 0.5 + r.standard_normal((40, 64))[r.randint(0, 40, 4000)]
    x /= np.linalg.norm(x, axis=1)[:, None]
    lists = ann.Lists.fit(x[:1000], 4000, 1.0, 20)
    best = ann.Best(20)
    full = ann.scan(lists, best, np.arange(4000), x, list(range(40)), x[:40])
    assert full < 0.6 * 40 * 4000
    hits = sum(len(set(best.id[best.owner == q]) & set(np.argsort(-x @ x[q])[:20])) for q in range(40))
    assert hits / 800 > 0.97


def test_query_recall(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r["vec_id"], np.float32(r["embedding"])) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    got = defaultdict(list)
    for r in queries.op8_ann(spark, sf).collect():
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    assert recall(rows, got, 20) >= 0.9


def test_queries_of_small_clusters_get_all_their_neighbours(spark):
    """Clusters far smaller than k, and lone vectors: every query gets k rows, or all there are."""
    r = np.random.RandomState(31)
    centres = r.standard_normal((150, 16)) * 10
    rows = [(i, centres[i % 150] + r.standard_normal(16) * 0.01) for i in range(600)] + [(600 + i, r.standard_normal(16) * 200) for i in range(10)]
    got = search(spark, rows, k=20, every=5)
    assert len(got) == 122 and all(len(v) == 20 for v in got.values())


def test_bundles_hold_all_lists():
    of, blocks = ann.bundles({0: 4000, 1: 50, 2: 100, 4: 9000, 5: 1}, 6)
    assert list(of) == sorted(of) and len(of) == 6 and dict(blocks) == {0: 1, 1: 1, 2: 3, 3: 1}
