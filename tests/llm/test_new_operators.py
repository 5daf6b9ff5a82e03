"""Periodic runs, phrases and graph search against plain versions, and their edges."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from conftest import SF_ORACLE
from edge import ROWS, docs, words
from pyspark.sql import functions as F

from portmart.llm import graph_search, periodic_runs, phrase_mining
from portmart.llm.catalog import QUERIES

# ---------------------------------------------------------------- periodic runs


def runs(w):
    """Every maximal stretch of each period, the smallest period for equal stretches."""
    out = {}
    for q in range(1, len(w) // 4 + 1):
        i = q
        while i < len(w):
            j = i
            while j < len(w) and w[j] == w[j - q]:
                j += 1
            if j - i + q >= max(6, 4 * q):
                out.setdefault((i - q, j - i + q), q)
            i = max(j, i + 1)
    return sorted(((s, n, q) for (s, n), q in out.items()), key=lambda r: (r[0], r[2]))


def answer(doc_id, text):
    w = words(text)
    found = runs(w)
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    best = min(found, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=None)
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in found)
    kept = " ".join(x for i, x in enumerate(w) if i not in gone)
    tail = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(found), *tail, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


COLUMNS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def test_runs_match_a_plain_search(spark):
    rng = random.Random(5)
    texts = []
    for _ in range(400):
        w = []
        for _ in range(rng.randint(0, 5)):
            unit = [rng.choice("abc") for _ in range(rng.randint(1, 7))]
            w += (unit * rng.randint(1, 9))[: rng.randint(1, 40)]
        texts.append(" \t\n"[rng.randint(0, 2)].join(w))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string").repartition(3)
    got = periodic_runs.find_runs(df).select(*COLUMNS).collect()
    assert sorted(map(tuple, got)) == sorted(answer(i, t) for i, t in enumerate(texts))


def test_planted_periods(spark):
    texts = {i: " ".join(f"w{(i * j * j) % 97}" for j in range(i % 150)) for i in range(200)}

    def planted(doc_id):
        w, h = words(texts[doc_id]), zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 or not w:
            return texts[doc_id]
        a = g % len(w)
        p = 1 + (len(w) - a) // (3 + g % 8)
        return " ".join(x if i < a else w[a + (i - a) % p] for i, x in enumerate(w))

    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: r.text for r in periodic_runs.plant(df).collect()}
    assert got == {i: planted(i) for i in texts}
    assert sum(got[i] != texts[i] for i in texts) > 5


def test_run_edges(spark):
    rows = ROWS + [(20, "x " * 60_000, "en", "a", None, 7, "h", 0.1, "w", "c")]
    df = docs(spark, rows)
    got = periodic_runs.find_runs(df).select(*COLUMNS, "n_words", "n_dropped", "runs").collect()
    small = [r for r in rows if r[0] not in (10, 20)]
    want = [answer(r[0], r[1]) for r in small]
    assert sorted(map(str, (tuple(r)[:8] for r in got if r.doc_id not in (10, 20)))) == sorted(map(str, want))
    giant = next(r for r in got if r.doc_id == 20)
    assert (giant.start, giant.length, giant.period, giant.n_dropped) == (0, 60_000, 1, 59_999)
    assert next(r for r in got if r.doc_id == 10).n_runs == 0
    assert periodic_runs.find_runs(periodic_runs.plant(docs(spark, []))).count() == 0
    assert periodic_runs.plant(df.where("doc_id is null")).where("text is not null").count() == 1


def test_runs_need_no_shuffle(spark):
    plan = periodic_runs.find_runs(periodic_runs.plant(docs(spark)))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "PythonUDF" not in plan


# ---------------------------------------------------------------- phrases


def plain_phrases(rows, min_count, max_words=3, percent=50, best=2000):
    f, n = collections.Counter(), collections.Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = (text or "").translate({i: i + 32 for i in range(65, 91)})
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(w)
            for m in range(1, max_words + 1):
                for i in range(len(w) - m + 1):
                    f[lang, tuple(w[i : i + m])] += 1
    cand = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= min_count}
    out = []
    for (lang, w), a in cand.items():
        longer = [
            b for (g, v), b in cand.items()
            if g == lang and len(v) > len(w) and any(v[i : i + len(w)] == w for i in range(len(v)))
        ]
        if any(100 * b >= percent * a for b in longer):
            continue
        cuts = [(1000000 * a * a // (f[lang, w[:k]] * f[lang, w[k:]]), k) for k in range(1, len(w))]
        score, k = min(cuts)
        out.append((lang, -score, -a, " ".join(w).encode(), f[lang, w[:k]], f[lang, w[k:]], n[lang]))
    out.sort()
    rank = collections.Counter()
    for lang, score, a, phrase, left, right, total in out:
        rank[lang] += 1
        if rank[lang] <= best:
            yield (lang, rank[lang], phrase.decode(), -a, left, right, total, -score)


def _random_rows(seed, n):
    rng = random.Random(seed)
    vocabulary = ["The", "the", "of", "new", "York", "éte", "a", "b", "c", "d"]
    seps = [" ", " ", " ", "\t", "  ", ". ", ",", "\n", "\r"]
    return [
        (rng.choice(["en", "fr", "", None]), "".join(rng.choice(vocabulary) + rng.choice(seps) for _ in range(rng.randint(0, 60))))
        for _ in range(n)
    ]


@pytest.mark.parametrize(("max_words", "shard"), [(3, 1 << 19), (3, 7), (4, 50), (2, 3)])
def test_phrases_match_a_plain_count(spark, max_words, shard):
    rows = _random_rows(max_words, 60) + [(None, None), ("en", ""), ("en", "the new York the new York")]
    df = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    df = df.withColumns({c: F.lit("clash") for c in ("h", "n", "phrase", "score", "rank", "word", "keys")})
    got = phrase_mining.mine(df, min_count=6, max_words=max_words, best=40, shard_phrases=shard)
    assert sorted(map(tuple, got.collect())) == sorted(plain_phrases(rows, 6, max_words, best=40))


def test_phrase_edges(spark):
    assert phrase_mining.mine(docs(spark, [])).count() == 0
    assert phrase_mining.mine(docs(spark, ROWS[4:7])).count() == 0
    want = sorted(plain_phrases([(r[2], r[1]) for r in ROWS if r[0] != 10], 2))
    got = phrase_mining.mine(docs(spark, [r for r in ROWS if r[0] != 10]), min_count=2)
    assert sorted(map(tuple, got.collect())) == want


def test_texts_are_read_as_often_however_many_phrases_are_frequent(spark, monkeypatch):
    rows = _random_rows(5, 60)
    df = spark.createDataFrame(rows, "lang string, text string")
    reads, real = [], phrase_mining.source
    monkeypatch.setattr(phrase_mining, "source", lambda docs: reads.append(1) or real(docs))
    seen = set()
    for shard in (1 << 15, 5, 1):
        reads.clear()
        got = phrase_mining.mine(df, min_count=4, best=40, shard_phrases=shard)
        assert sorted(map(tuple, got.collect())) == sorted(plain_phrases(rows, 4, best=40))
        seen.add(len(reads))
    assert seen == {5}  # words, pairs, triples, spelling, windows


def test_windows_in_many_small_batches_count_the_same(spark, monkeypatch):
    rows = _random_rows(6, 60)
    df = spark.createDataFrame(rows, "lang string, text string").repartition(5)
    monkeypatch.setattr(phrase_mining, "WINDOWS_AT_ONCE", 16)
    monkeypatch.setattr(phrase_mining, "SHARDS_A_PARTITION", 1)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2")
    try:
        got = phrase_mining.mine(df, min_count=4, max_words=4, best=40).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted(map(tuple, got)) == sorted(plain_phrases(rows, 4, 4, best=40))


def test_packed_phrases_come_back():
    rng = np.random.default_rng(3)
    size = rng.integers(2, 5, 500).astype(np.int8)
    keys = rng.integers(1, 6, (500, 4)).astype(np.uint64)
    keys[np.arange(4) >= size[:, None]] = 0
    rows = phrase_mining.packed(size, keys, np.arange(500), 7, True)
    places = rows.column(0).to_pylist()
    assert places == sorted(set(places)) and all(0 <= p < 14 and p % 2 for p in places)
    words, n, value = phrase_mining.unpacked(rows)
    assert sorted(value.tolist()) == list(range(500))
    for phrase, i in zip(np.split(words, np.cumsum(n)[:-1]), value.tolist(), strict=True):
        assert phrase.tolist() == keys[i, : size[i]].tolist()


def test_trie_counts_all_phrases():
    rng = np.random.default_rng(2)
    symbols = np.unique(rng.integers(1, 1 << 63, 900, dtype=np.uint64))
    pick = lambda n: symbols[np.minimum((rng.pareto(1, n) * 30).astype(int), len(symbols) - 1)]
    phrases = [np.array(x, np.uint64) for x in {tuple(pick(int(rng.integers(2, 4))).tolist()) for _ in range(2000)}]
    trie = phrase_mining.build_trie(np.concatenate(phrases), np.array([len(x) for x in phrases]))
    key, piece = pick(9000), np.cumsum(rng.random(9000) < 0.1)
    p = phrase_mining.Positions(None, None, None, key, piece, None, None)
    total = sum(np.bincount(x, minlength=len(phrases)) for x in phrase_mining.accepted(trie, p, 3))
    seen = collections.Counter(
        tuple(key[i : i + m].tolist()) for m in (2, 3) for i in range(9001 - m) if piece[i] == piece[i + m - 1]
    )
    assert [seen[tuple(x.tolist())] for x in phrases] == total.tolist()


# ---------------------------------------------------------------- graph search


def exact(rows, every, k):
    """(query, rank, id, score) by brute force; scores rounded, ties by id."""
    held = {i: np.array(v, float) for i, v in rows}
    out = []
    for q in sorted(x for x in held if x % every == 0):
        near = sorted((-round(float(held[q] @ v), 9), i) for i, v in held.items() if i != q and len(v) == len(held[q]))
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(near[:k])]
    return out


def test_small_tables_are_answered_exactly(spark):
    rng = np.random.default_rng(1)
    some = rng.normal(size=(150, 8)) * rng.uniform(0.1, 4, size=(150, 1))  # norms differ
    rows = [(int(i), some[i].astype(np.float32).tolist()) for i in range(150)]
    rows += [(200 + i, rows[7][1]) for i in range(60)]  # a crowd of copies
    rows += [(300 + i, [1.0, float(i)]) for i in range(3)]  # another length
    odd = [(400, None), (401, []), (402, [0.0] * 8), (403, [float("nan")] + [1.0] * 7), (404, [float("inf")] * 8), (None, some[0].tolist())]
    odd += [(405, [None] + [1.0] * 7), rows[3]]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>").repartition(3)
    df = df.withColumns({c: F.lit(1) for c in ("shard", "length", "vector", "ids", "rank")})
    got = graph_search.search(df, every=20, k=20, shard_vectors=60).collect()
    assert sorted((r.query_id, r.rank, r.vec_id, round(r.score, 9) + 0.0) for r in got) == sorted(exact(rows, 20, 20))


def test_empty_and_lonely_vectors(spark):
    schema = "vec_id long, embedding array<float>"
    assert graph_search.search(spark.createDataFrame([], schema)).count() == 0
    assert graph_search.search(spark.createDataFrame([(20, [1.0, 2.0])], schema)).count() == 0
    two = graph_search.search(spark.createDataFrame([(20, [1.0, 2.0]), (1, [1.0, 0.0])], schema)).collect()
    assert [tuple(r) for r in two] == [(20, 1, 1, 1.0)]


def test_a_dense_cluster_does_not_trap_the_search():
    rng = np.random.default_rng(4)
    centre = rng.normal(size=32)
    crowd = centre + rng.normal(size=(1500, 32)) * 0.02
    lone = rng.normal(size=(500, 32))
    points = np.concatenate([crowd, lone])
    points /= np.linalg.norm(points, axis=1)[:, None]
    graph = graph_search.build(graph_search.extended(points, 1.0))
    found, _ = graph.search(np.pad(points[1500:], ((0, 0), (0, 1))).astype(np.float32), 96)
    true = np.argsort(-(points[1500:] @ points.T), axis=1)[:, :20]
    recall = np.mean([len(set(a) & set(b[:20].tolist())) / 20 for a, b in zip(true.tolist(), found, strict=True)])
    assert recall >= 0.9


def test_recall_on_the_table(spark):
    table = spark.read.parquet(f"{SF_ORACLE}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in table.collect()]
    got = collections.defaultdict(set)
    for r in QUERIES["op12_graph_search"](spark, SF_ORACLE).collect():
        got[r.query_id].add(r.vec_id)
    want = collections.defaultdict(set)
    for q, _, i, _ in exact(rows, 20, 20):
        want[q].add(i)
    assert set(got) == set(want) and all(len(v) == 20 for v in got.values())
    assert np.mean([len(got[q] & want[q]) / 20 for q in want]) >= 0.9

