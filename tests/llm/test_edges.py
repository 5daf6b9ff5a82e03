"""Nulls, empty and long texts, ties, repeated rows, empty tables, clashing names."""

import random
import zlib

import pytest
from edge import BASE, NEAR, ROWS, SCHEMA, components, docs, without_repeats, words
from pyspark.sql import functions as F

from portmart.llm import (
    decontamination,
    html_extraction,
    language_id,
    mixing,
    ngram_join,
    quality_rules,
    rule_ensemble,
    sharding,
    substring_dedup,
    warc,
)

PAIRS = [(r[0], r[1]) for r in ROWS]


def key(rows):
    return sorted(tuple(str(v) for v in r) for r in rows)


def test_quality_rules(spark):
    rows = quality_rules.apply_rules(docs(spark)).collect()
    assert len(rows) == len(ROWS)
    by_id = {r.doc_id: r for r in rows}
    for r in (by_id[4], by_id[5], by_id[6]):
        assert (r.n_words, r.word_chars, r.n_repeat_words, r.base_failed, r.kept) == (0, 0, 0, True, False)
    assert (by_id[9].n_words, by_id[9].n_repeat_words) == (120, 120)
    assert by_id[10].n_words == 30_000 and by_id[10].n_repeat_words == 0
    assert (by_id[12].n_dup_lines, by_id[12].n_repeat_words) == (0 + 1 - 1 + 1, 9)
    assert by_id[13].word_chars == sum(len(w) for w in words(ROWS[-1][1]))


def test_rule_table_compiles_to_one_projection(spark):
    plan = quality_rules.apply_rules(docs(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan


def test_repeat_words_match_a_plain_count(spark):
    texts = [" ".join("abcd"[(i * i + s) % 4] for i in range(40 + s)) for s in range(30)]
    rows = quality_rules.measure(spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")).collect()
    for r in rows:
        w = texts[r.doc_id].split()
        wins = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
        assert r.n_repeat_words == len({i + k for i, x in enumerate(wins) if wins.count(x) > 1 for k in range(3)})


def test_mixing(spark):
    rows = mixing.mix(docs(spark)).collect()
    assert len(rows) == len(ROWS)
    assert key(rows) == key(mixing.mix(docs(spark).repartition(5)).collect())
    size = {}
    for d, t, _, s, *_ in ROWS:
        size[s] = size.get(s, 0) + len(words(t))
    names = sorted([s for s in size if s is not None]) + [None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    # Water-filling the long way: clamp, share the excess by weight, until none is above.
    budget, stop = 1.5 * sum(size.values()), {s: 2.0 * size[s] for s in size}
    clamped = {}
    while True:
        free = [s for s in names if s not in clamped]
        left = budget - sum(clamped.values())
        level = {s: left * weight[s] / sum(weight[f] for f in free) for s in free}
        over = [s for s in free if level[s] > stop[s]]
        if not over:
            break
        clamped |= {s: stop[s] for s in over}
    target = sorted({round(v, 6) for v in (clamped | level).values()})
    assert sorted({round(r.target, 6) for r in rows}) == target
    assert all(0 <= r.taken <= 2 * r.size for r in rows)


def test_mixing_meets_targets_and_repeats_documents(spark):
    many = [(i, "w " * (i % 50 + 1), "x" if i % 3 else "y") for i in range(3000)]
    d = spark.createDataFrame(many, "doc_id long, text string, source string")
    rows = mixing.mix(d).collect()
    for source in ("x", "y"):
        mine = [r for r, m in zip(sorted(rows, key=lambda r: r.doc_id), many) if m[2] == source]
        assert abs(sum(r.taken for r in mine) - mine[0].target) <= 50
    out = mixing.repeat_documents(d)
    assert out.columns == d.columns
    assert out.count() == sum(r.taken // r.size for r in rows)


def test_mixing_makes_up_for_a_giant(spark):
    """50 sources, each one long document and 200 short ones, at needs from a
    fiftieth of the words to all: every target is met within 1 % or half a
    short document."""
    giant = 5000
    rows = [(s * 1000 + i, "w " * (giant if i == 0 else 25), f"s{s:02d}") for s in range(50) for i in range(201)]
    d = spark.createDataFrame(rows, "doc_id long, text string, source string")
    weights = tuple(float(1 + s) for s in range(50))
    out = mixing.mix(d).collect()
    records = mixing.measured(d).cache()
    for p in (mixing.plan(records, weights, 0.5, 1.0), mixing.plan(records, (1.0,), 0.35, 1.0)):
        r = records.join(p.withColumnRenamed("source", "s"), F.col("source") == F.col("s"))
        r = r.groupBy("source", "target").agg(F.sum(F.col("size") * mixing.copies(F.col("size"), F.col("key"))).alias("taken"))
        assert all(abs(x.taken - x.target) <= max(0.01 * x.target, 13) for x in r.collect())
    by = {}
    for r in out:
        by.setdefault(r.target, []).append(r.taken)
    assert all(abs(sum(t) - k * (len(t) // 201)) <= 0.01 * k * (len(t) // 201) for k, t in by.items())


def test_mixing_of_many_sources(spark):
    rows = [(i, "w " * (i % 7 + 1), f"host{i % 1500:05d}") for i in range(6000)]
    d = spark.createDataFrame(rows, "doc_id long, text string, source string")
    size = {}
    for _, t, s in rows:
        size[s] = size.get(s, 0) + len(t) // 2
    weight = {s: (5.0, 2.0, 1.0)[i % 3] for i, s in enumerate(sorted(size))}
    level = min(
        (x for x in (2.0 * size[s] / weight[s] for s in size)),
        key=lambda v: abs(sum(min(2.0 * size[s], v * weight[s]) for s in size) - 1.5 * sum(size.values())),
    )
    p = {r.source: r.target for r in mixing.plan(mixing.measured(d)).collect()}
    assert set(p) == set(size)
    assert abs(sum(p.values()) - 1.5 * sum(size.values())) < 1e-3
    free = {round(p[s] / weight[s], 6) for s in size if p[s] < 2.0 * size[s] - 1e-9}
    assert len(free) == 1 and abs(free.pop() - level) < 20
    assert all(p[s] <= 2.0 * size[s] for s in size)


def test_sharding(spark):
    rows = sharding.shard(docs(spark), n_shards=3).collect()
    assert len(rows) == len(ROWS)
    want = sorted((str(d), len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in PAIRS)
    assert sorted((str(r.doc_id), r.size, r.text_crc32) for r in rows) == want
    for s in range(3):
        mine = sorted(r.slot for r in rows if r.shard == s)
        assert mine == list(range(len(mine)))


def test_rebalance_edits_few_slots():
    even = sharding.initial_map(4, 64)
    load = {s: 100 for s in range(64)} | {0: 1000}
    new = sharding.rebalance(even, load, 4)
    total = [sum(load[s] for s in new if new[s] == k) for k in range(4)]
    assert max(total) - min(total) <= 100
    assert sum(new[s] != even[s] for s in even) < 16
    assert sharding.rebalance(new, load, 4) == new


def test_slot_map_versions_stay(spark, tmp_out):
    sharding.store_map(spark, tmp_out, 1, sharding.initial_map(2, 8))
    sharding.store_map(spark, tmp_out, 2, sharding.initial_map(3, 8))
    assert [sharding.load_map(spark, tmp_out, v).agg(F.max("shard")).first()[0] for v in (1, 2)] == [1, 2]


def test_decontamination(spark):
    middle = " ".join(BASE.split()[20:60])
    items = spark.createDataFrame(
        [(1, middle), (1, middle), (2, "THREE SHORT WORDS"), (3, None), (4, ""), (5, "never seen in any text at all")],
        "item_id long, text string",
    )
    got = {(r.doc_id, r.item_id) for r in decontamination.search(docs(spark), items).collect()}
    assert got == {(1, 1), (2, 1), (3, 1), (7, 2), (8, 2)}
    kept = decontamination.drop_contaminated(docs(spark), items)
    assert kept.columns == docs(spark).columns
    assert kept.count() == len(ROWS) - 6


def test_items_of_one_id_or_none_are_searched_one_by_one(spark):
    text = [" ".join(f"i{k}w{i}" for i in range(30 + k)) for k in range(6)]
    items = [(1, text[0]), (1, text[1]), (1, text[1]), (None, text[2]), (None, text[3]), (2, text[4]), (2, text[4] + " more")]
    items = spark.createDataFrame([*items, (None, None)], "item_id long, text string")
    rows = [(k, f"before {t} after") for k, t in enumerate(text)] + [(6, text[2] + " " + text[3]), (None, text[0])]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    got = key((r.doc_id, r.item_id, r.item_shingles, r.shared) for r in decontamination.search(d, items).collect())
    want = [(0, 1, 26, 26), (1, 1, 27, 27), (2, None, 28, 28), (3, None, 29, 29), (4, 2, 30, 30), (6, None, 29, 29), (None, 1, 26, 26)]
    assert got == key(want)
    assert [r.doc_id for r in decontamination.drop_contaminated(d, items).collect()] == [5]


def test_short_items_in_long_documents_are_found(spark):
    """Recall of the sketch search against all pairs, items of 1 to 12 shingles."""
    texts = [" ".join(f"t{d}w{i}" for i in range(400 * (d % 9 + 1))) for d in range(60)]
    items = [(k, " ".join(texts[k].split()[37 : 37 + 5 + k % 12])) for k in range(60)]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    found = decontamination.search(d, spark.createDataFrame(items, "item_id int, text string")).collect()
    assert all(r.doc_id == r.item_id and r.containment == 1.0 for r in found)
    assert len(found) >= 0.9 * len(items)


def test_items_of_few_shingles_are_all_found(spark):
    texts = [" ".join(f"t{d}w{i}" for i in range(600)) for d in range(30)]
    items = [(k, " ".join(texts[k % 30].split()[k : k + 5 + k // 30 % 4])) for k in range(480)]
    items += [(480 + k, f"only {k}") for k in range(4)]
    texts += [f"ONLY {k}" for k in range(4)]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    i = spark.createDataFrame(items, "item_id int, text string")
    found = decontamination.search(d, i).collect()
    want = [(k % 30, k) for k in range(480)] + [(30 + k, 480 + k) for k in range(4)]
    assert sorted((r.doc_id, r.item_id) for r in found) == sorted(want)
    assert all(r.containment == 1.0 for r in found)


def test_language(spark):
    model = language_id.fit(docs(spark))
    rows = language_id.identify(docs(spark), model).collect()
    assert len(rows) == len(ROWS)
    for r, text in ((r, t) for r in rows for d, t in PAIRS if d is not None and d == r.doc_id):
        assert (r.lang_pred == "und") == (not any(c.isalpha() for c in text or ""))
        assert 0 <= r.score <= 1
    assert language_id.keep_identified(docs(spark)).columns == docs(spark).columns


def test_language_mixture_and_nothing_learnt(spark):
    a = [(i, "alpha bravo charlie delta echo foxtrot " * 5, "a") for i in range(20)]
    b = [(i + 20, "zulu yankee xray whiskey victor uniform " * 5, "b") for i in range(20)]
    d = spark.createDataFrame(a + b, "doc_id long, text string, lang string")
    model = language_id.fit(d)
    shares, _ = model.infer([a[0][1], a[0][1] * 3 + b[0][1], b[0][1]])
    assert shares.argmax(axis=1).tolist() == [0, 0, 1]
    assert shares[0].max() == 1.0 and 0.6 < shares[1][0] < 0.9
    none = language_id.fit(d.withColumn("lang", F.lit(None).cast("string")))
    assert {r.lang_pred for r in language_id.identify(d, none).collect()} == {"und"}


@pytest.mark.parametrize("rows", [PAIRS, [(i, " ".join(f"s{(i // 4) * 1000 + j + (j % 13 == i % 4) * 7}" for j in range(90))) for i in range(40)]])
def test_ngram_join(spark, rows):
    d = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in ngram_join.components(d).collect())
    assert got == components(rows)


def test_ngram_join_of_boilerplate_and_chains(spark):
    """Documents share 50 to 90 % of a boilerplate, some by steps of a chain."""
    rng = random.Random(6)
    plate = [f"plate{i}" for i in range(160)]
    texts = []
    for i in range(80):
        own = [f"own{i}x{k}" for k in range(rng.randint(5, 90))]
        texts.append(plate[: rng.randint(100, 160)] + own)
    for _ in range(4):
        step = rng.choice(texts)[:]
        for k in range(12):
            at = rng.randrange(len(step))
            step = step[:at] + [f"step{rng.random()}" for _ in range(6)] + step[at + 6 :]
            texts.append(step)
    rows = [(i, " ".join(w)) for i, w in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = ngram_join.components(df).select("doc_id", "n_shingles", "component_id").collect()
    want = components(rows)
    assert sorted((str(r[0]), r[1], str(r[2])) for r in got) == want
    assert 5 < len({r[2] for r in want}) < len(rows)


def test_ngram_join_of_one_large_group(spark, monkeypatch):
    """Near copies of one text, most pairs of them not alike; batches of three
    and salted tokens."""
    import random

    rng = random.Random(5)
    base = [f"b{i}" for i in range(80)]
    rows = []
    for i in range(60):
        copy = list(base)
        for _ in range(rng.randint(0, 4)):
            copy[rng.randrange(80)] = f"r{rng.random()}"
        rows.append((i, " ".join(copy)))
    monkeypatch.setattr(ngram_join, "HOT_FACTOR", 1e-9)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        d = spark.createDataFrame(rows, "doc_id long, text string")
        got = sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in ngram_join.components(d).collect())
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == components(rows)


def test_one_document_of_each_group_stays(spark):
    kept = ngram_join.keep_representatives(docs(spark))
    assert kept.columns == docs(spark).columns
    ids = [r.doc_id for r in kept.collect()]
    assert len(ids) == len(ROWS) - 4
    assert not {2, 3, 8} & set(ids) and {1, 4, 5, 6, 7, 9, 10, 11, 12, 13} <= set(ids)


def test_substring_dedup(spark):
    rows = PAIRS + [(20, " ".join(["x"] * 60)), (21, "lead in " + BASE), (22, " ".join(BASE.split()[:34]))]
    d = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2")
    try:
        got = substring_dedup.remove_repeats(d).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_sha256) for r in got) == without_repeats(rows)
    assert all(sum(i["to"] - i["from"] for i in r["intervals"]) == r.n_removed for r in got)


PAGES = [
    (1, "http://a.example/x", "<html><body><nav>menu</nav><article><h1>T&amp;t</h1><p>One <b>two<p>three\n four</article></body>"),
    (2, "http://a.example/y", None),
    (3, "http://a.example/z", ""),
    (3, "http://a.example/z", ""),
    (4, None, "no markup &lt;at&gt; all"),
    (None, "http://a.example/q", "<p>null id</p>"),
    (5, "http://b.example/1", "<script>var t = '</p><p>x';</script><div class='sidebar'>s</div><main><form>f</form><p>kept</main>"),
    (6, "http://b.example/2", "<article>body<section id=comments><p>a comment</section><div class='ad'>buy</div>tail</article>"),
    (7, "HTTP://B.example:80/3#f", "<div><p>long " + "word " * 50_000 + "</div>"),
    (8, "http://b.example/4\r\nX: y", "WARC/1.1\r\nX-Capture-Run: no\r\n\r\nfoo\r\n\r\n"),
]
PAGE_SCHEMA = "page_id long, url string, html string, host string, seed string, payload string, first int"


def pages(spark, rows=PAGES):
    return spark.createDataFrame([(*r, "h", "s", "p", 1) for r in rows], PAGE_SCHEMA)


def test_extraction(spark):
    got = {r.page_id: r.text for r in html_extraction.extract(pages(spark)).collect()}
    assert got[1] == "T&t\n\nOne two\n\nthree four"
    assert got[2] == got[3] == ""
    assert got[4] == "no markup <at> all"
    assert (got[5], got[6], got[None]) == ("kept", "body\n\ntail", "null id")
    assert got[7].startswith("long word word") and len(got[7]) == 4 + 5 * 50_000


def test_constant_text_of_a_host_is_template(spark):
    rows = [
        (i, f"http://h.example/{i}", f"<div><p>Welcome to the site</p><p>story {i}</p>{'<p>more</p>' * (i % 3)}<p>All rights</p></div>")
        for i in range(12)
    ]
    got = {r.page_id: r.text for r in html_extraction.extract(pages(spark, rows)).collect()}
    assert all(f"story {i}" in got[i] and "Welcome" not in got[i] for i in range(12))
    copies = [(i, f"http://h.example/{i}", "<div><p>one and the same</p></div>") for i in range(12)]
    got = html_extraction.extract(pages(spark, copies)).collect()
    assert {r.text for r in got} == {"one and the same"}


def test_text_of_copies_and_near_copies_is_kept(spark):
    """A long article in copies on a host of short ones, and a host of near
    copies with an edited or an added paragraph; a line in all articles goes."""
    para = [" ".join(f"p{k}w{i}" for i in range(20)) for k in range(9)]

    def page(i, title, paragraphs):
        body = "".join(f"<p>{p}</p>" for p in paragraphs)
        return (i, f"http://h{i // 100}.example/{i}", f"<body><article><h1>{title}</h1>{body}</article></body>")

    def alone(rows):
        """The texts if each page were the only one of its host."""
        single = [(i, f"http://{i}.example/", h) for i, _, h in rows]
        return {r.page_id: r.text for r in html_extraction.extract(pages(spark, single)).collect()}

    rows = [page(i, "long", para) for i in range(8)]
    rows += [page(i, f"short {i}", [f"only {i} here"]) for i in range(8, 30)]
    rows += [page(100 + i, "news", [*para[:8], f"edited {i} in here"]) for i in range(30)]
    rows += [page(200 + i, "news", [*para[: i % 7], f"added {i}", *para[i % 7 :]]) for i in range(30)]
    rows += [page(300 + i, "news", [p.replace(f"w{k + 3} ", f"x{i} ") for k, p in enumerate(para)]) for i in range(30)]
    for seed in ("least", "greatest"):
        got = {r.page_id: r.text for r in html_extraction.extract(pages(spark, rows)).collect()}
        assert got == alone(rows), seed
        rows = [(i, u, h.replace("<body>", "<body><!-- other hash -->")) for i, u, h in rows]
    line = [page(i, f"title {i}", ["Share this story", f"story {i} " + " ".join(f"s{i}w{k}" for k in range(30))]) for i in range(20)]
    got = {r.page_id: r.text for r in html_extraction.extract(pages(spark, line)).collect()}
    assert all("Share" not in t and f"title {i}" in t and f"s{i}w29" in t for i, t in got.items())


def test_seed_of_copies_loses_no_paragraph(spark):
    """The long page is the seed of its host by construction of the wrapper."""
    html = "<article>" + "".join(f"<p>para {k} of the long page</p>" for k in range(6)) + "</article>"
    rows = [(i, "http://c.example/", html) for i in range(6)]
    rows += [(10 + i, "http://c.example/", f"<article><p>short page {i}</p></article>") for i in range(30)]
    p = pages(spark, rows).select(F.lit("c.example").alias("host"), F.col("html").alias("page"))
    seeds = spark.createDataFrame([("c.example", html)], "host string, seed string")
    found = html_extraction.induce(p, seeds).collect()
    assert len(found) == 6 and {(r.equal, r.pages) for r in found} == {(1, 31)}


@pytest.mark.parametrize(
    "page",
    [
        "<body style='overflow: hidden'><p>text</p></body>",
        '<body title="the hidden cost"><p>text</p></body>',
        '<body data-menu="hidden" data-x=hidden><p>text</p></body>',
        "<body title='a class=\"ad\" role=menu'><p>text</p></body>",
        '<html class="no-js menu"><body class="comments-open"><p>text</p></body></html>',
        '<body id="comments" class="search"><main class="comments"><p>text</p></main></body>',
        '<body><article class="post no-comments"><p>text</p></article></body>',
        '<body><article class="comment"><p>text</p></article></body>',
        '<body><article><div class="article-header"><h1>text</h1></div></article></body>',
        '<body><article><div class="header"><h1>text</h1></div></article></body>',
        '<body><article><p class="research-search-x no-share">text</p></article></body>',
        "<body><p>text</p><p hidden>no</p><p class=x hidden>no</p><p title='a'hidden>no</p><p HIDDEN=''>no</p></body>",
        '<body><p>text</p><div class="x comments">no</div><div id=sidebar>no</div><div role="menu">no</div></body>',
        '<body><article><p>text</p><article class="comment">no</article><ol class="comment-list">no</ol></article></body>',
        '<body><div class="site-header">no</div><div class="main-nav">no</div><p>text</p><div class="cookie-banner">no</div></body>',
    ],
)
def test_only_whole_names_and_attributes_drop(page):
    assert html_extraction.blocks(html_extraction.parse(page), set()) == ["text"]


def test_tree_matching_finds_the_largest_mapping():
    m = html_extraction.Matcher()
    a, b = (html_extraction.parse(t) for t in ("<div><h1>x</h1><p>1</p><p>2</p></div>", "<div><p>1</p><ul><li>q</ul><p>2</p></div>"))
    m.number(a), m.number(b)
    assert m.match(a.shape, b.shape)[0] == 6  # root, div, two paragraphs and their texts
    assert [(x.text, y.text) for _, x, y in sorted(m.texts(a, b), key=lambda t: t[0])] == [("1", "1"), ("2", "2")]


def test_deep_pages(spark):
    """5,000 nested elements, as a seed and beside pages of other depths."""
    rows = [
        (i, f"http://d{i % 2}.example/{i}", f"<div><p>story {i}</p>{('<font>' + 'x' * (i % 2)) * (5000 - i // 2)}deep {i}</div>")
        for i in range(6)
    ]
    got = {r.page_id: r.text for r in html_extraction.extract(pages(spark, rows)).collect()}
    assert all(got[i].startswith(f"story {i}") and got[i].endswith(f"deep {i}") for i in range(6))
    m = html_extraction.Matcher()
    a, b = (html_extraction.parse("<b>" * n + "<i>x</i>" + "</b>" * n) for n in (5000, 4999))
    m.number(a), m.number(b)
    assert m.match(a.shape, a.shape)[0] == 5003 and m.match(a.shape, b.shape)[0] == 5000


def test_archives(spark, tmp_out):
    out = warc.archive(pages(spark), tmp_out + "/w").collect()
    assert len(out) == len(PAGES)
    by_id = {r.page_id: r for r in out if r.page_id != 3}
    assert (by_id[2].record_type, by_id[2].payload_digest) == ("response", "3I42H3S6NNFQ2MSVX7XZKYAYSCX5QBYJ")
    assert [(r.record_type, r.refers_to) for r in out if r.page_id == 3] == [("revisit", 2)] * 2
    assert by_id[7].urlkey == "example,b)/3"
    order = [(r.urlkey, r.ts, -1 if r.page_id is None else r.page_id) for r in out]
    assert order == sorted(order)


def test_archives_round_trip(spark, tmp_out):
    run = warc.write_archives(pages(spark), tmp_out + "/w")
    back = {r.page_id: r.payload for r in warc.read_archives(spark, tmp_out + "/w", run).collect() if r.record_type == "response"}
    assert back == {p: h or "" for p, _, h in PAGES if p != 3}


def test_loser_tree():
    runs = [[1, 4, 4], [], [2, 4], [0], [4, 9, 9]]
    merged = [runs[k][i] for k, i in warc.LoserTree(runs)]
    assert merged == sorted(sum(runs, []))
    assert list(warc.LoserTree([])) == [] and list(warc.LoserTree([[], []])) == []
    assert list(warc.LoserTree([[5]])) == [(0, 0)]


def test_quality_classifier(spark):
    labels = spark.createDataFrame([(1, 1), (2, 1), (9, 0), (9, None), (None, 0), (11, 0)], "doc_id long, quality int")
    rows = rule_ensemble.classify(docs(spark), labels).collect()
    assert len(rows) == len(ROWS)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    none = rule_ensemble.classify(docs(spark), labels.where("false")).collect()
    assert {r.score for r in none} == {0.5}
    ones = rule_ensemble.classify(docs(spark), labels.where("quality = 1")).collect()
    assert {r.score for r in ones} == {1.0}


def test_tree_paths_become_rules():
    text = "Tree\n  If (feature 0 <= 1.5)\n   If (feature 1 <= 2.0)\n    Predict: 0.0\n   Else (feature 1 > 2.0)\n    Predict: 1.0\n  Else (feature 0 > 1.5)\n   Predict: 1.0\n"
    a, b = rule_ensemble.STATISTICS[:2]
    assert rule_ensemble.tree_rules(text) == [
        ((a, True, 1.5),),
        ((a, True, 1.5), (b, True, 2.0)),
        ((a, True, 1.5), (b, False, 2.0)),
        ((a, False, 1.5),),
    ]


def test_empty_tables(spark):
    d = spark.createDataFrame([], SCHEMA)
    items = spark.createDataFrame([(1, "a b c d e f g")], "item_id long, text string")
    labels = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    results = [
        quality_rules.apply_rules(d),
        mixing.mix(d),
        mixing.repeat_documents(d),
        sharding.shard(d),
        decontamination.search(d, items),
        decontamination.search(docs(spark), items.where("false")),
        language_id.identify(d, language_id.fit(d)),
        ngram_join.components(d),
        ngram_join.keep_representatives(d),
        substring_dedup.remove_repeats(d),
        rule_ensemble.classify(d, labels),
        html_extraction.extract(pages(spark).where("false")),
        warc.archive(pages(spark).where("false")),
    ]
    assert [r.count() for r in results] == [0] * len(results)


def test_near_text_is_near():
    assert NEAR != BASE
