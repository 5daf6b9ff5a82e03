"""The registered queries against DuckDB SQL, or a plain version, at sf0.01."""

import html
import re
import zlib

import duckdb
import pytest
from compare import rows_of
from conftest import SF_ORACLE

from portmart.llm.catalog import QUERIES
from portmart.llm.sql import SQL


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_ORACLE}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(SQL))
def test_against_sql(spark, con, name):
    df = QUERIES[name](spark, SF_ORACLE)
    got, names = rows_of(df.columns, [tuple(r) for r in df.collect()])
    rel = con.sql(SQL[name])
    want, columns = rows_of(rel.columns, rel.fetchall())
    assert names == columns
    assert got == want


def test_every_operator_is_registered():
    assert sorted({int(k[2:].split("_")[0]) for k in QUERIES}) == list(range(1, 14))


def test_quality_score_on_held_out_documents(spark, con):
    quality = dict(con.sql("SELECT doc_id, quality FROM labels").fetchall())
    rows = QUERIES["op1_rule_ensemble"](spark, SF_ORACLE).collect()
    assert len(rows) == 1000
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    seen = [(r.predicted, quality[r.doc_id]) for r in rows if r.held_out and r.doc_id in quality]
    assert sum(p == q for p, q in seen) >= 0.95 * len(seen)


def test_language_of_held_out_documents(spark, con):
    lang = dict(con.sql("SELECT doc_id, lang FROM documents").fetchall())
    rows = QUERIES["op5_language_id"](spark, SF_ORACLE).collect()
    assert len(rows) == 1000
    seen = [r.lang_pred == lang[r.doc_id] for r in rows if r.held_out]
    assert sum(seen) >= 0.97 * len(seen)


def test_shards(spark, con):
    texts = dict(con.sql("SELECT doc_id, text FROM documents").fetchall())
    rows = QUERIES["op3_sharding"](spark, SF_ORACLE).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    load, places = [0] * 16, {}
    for r in rows:
        data = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32) == (len(data) + 1, zlib.crc32(data))
        load[r.shard] += r.size
        places.setdefault(r.shard, []).append(r.slot)
    assert max(load) - min(load) <= 0.01 * sum(load) / 16
    assert all(sorted(p) == list(range(len(p))) for p in places.values())


def test_main_text(spark, con):
    pages = con.sql("SELECT page_id, url, html FROM pages").fetchall()
    got = {r.page_id: (r.url, r.text, r.n_chars) for r in QUERIES["op10_html_extraction"](spark, SF_ORACLE).collect()}
    assert len(got) == len(pages)
    for page_id, url, page in pages:
        article = re.search("<article>(.*?)</article>", page, re.S)[1]
        parts = re.split("</?p>|</?h1>", re.sub("</?b>", "", article).replace("<br>", " "))
        text = "\n\n".join(t for t in (" ".join(html.unescape(p).split()) for p in parts) if t)
        assert got[page_id] == (url, text, len(text))
