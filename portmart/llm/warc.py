"""Web archives: write, read back, and merge their index.

``write_archives`` writes one WARC/1.1 record per page through Spark's text
writer (a record ends with two CRLF, which is the writer's line separator),
so any store Spark reaches will do and a failed task's file is never seen.
The second header of every record names the run by a random identifier;
version line and run header together separate the records of an archive when
it is read, whatever the payloads contain.

Payloads are compared by SHA-1 digest.  The least page id of a digest is a
response, the others are revisits without payload that refer to it.

``merge_index`` is an external merge.  Every archive split is indexed and
sorted by itself: a run, written as a file of its own.  The runs are cut at
the same places of the order (URL key, timestamp, page), and each range is
merged from its k run slices with a loser tree, so the result is in global
order from range to range.  The page is part of the order, so one URL's
captures may spread over many ranges.

Defined results: a null html is an empty payload; payloads shorter than
``min_bytes`` are always responses; repeated rows of the least page are all
responses; pages without id never become the one referred to, unless a
digest has no other, and then they are all responses; a null URL has the
empty key; an empty table gives an empty result; other columns are ignored.
Pages carry no capture time, so the record date counts ``page_id`` seconds
from a fixed start.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from portmart.llm.common import materialize, text_of
from portmart.session import scratch_path

CRLF = "\r\n"
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
# RFC 4648 base32, and the profile of revisits by digest.
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
FIRST_SECOND = 1_577_836_800

INDEX = "urlkey string, ts string, page_id long, record_type string, payload_digest string, payload_bytes long, refers_to long"


def base32_sha1(text: Column) -> Column:
    """Bare upper-case base32 SHA-1 of a text's UTF-8 bytes: each 5 hex
    digits are 4 base32 symbols."""
    hexes = F.sha1(text.cast("binary"))
    parts = [F.lpad(F.conv(F.substring(hexes, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", BASE32)


def captures(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """``page_id, url, payload, payload_bytes, payload_digest, record_type,
    refers_to`` of every page."""
    t = text_of("html")
    p = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        text_of("url").alias("url"),
        t.alias("payload"),
        F.octet_length(t).cast("long").alias("payload_bytes"),
        base32_sha1(t).alias("payload_digest"),
    )
    shared = p.where(F.col("payload_bytes") >= min_bytes).groupBy("payload_digest")
    shared = shared.agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
    shared = materialize(shared.where("n > 1 and first is not null"), "shared-payloads").select(
        F.col("payload_digest").alias("digest"), "first"
    )
    p = p.join(shared, p["payload_digest"] == shared["digest"], "left")
    again = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return p.select(
        "page_id",
        "url",
        "payload",
        "payload_bytes",
        "payload_digest",
        F.when(again, "revisit").otherwise("response").alias("record_type"),
        F.when(again, F.col("first")).alias("refers_to"),
    )


def record(run: str) -> Column:
    """One record without its final separator."""

    def urn(page: Column) -> Column:
        return F.concat(F.lit("<urn:md5:"), F.md5(F.concat(F.lit(run), F.coalesce(page.cast("string"), F.lit("")))), F.lit(">"))

    revisit = F.col("record_type") == "revisit"
    block = F.concat(F.lit(HTTP_HEAD), F.when(revisit, "").otherwise(F.col("payload")))
    seconds = F.timestamp_seconds(F.lit(FIRST_SECOND) + F.coalesce("page_id", F.lit(0)))
    lines = [
        ("WARC-Type", F.col("record_type")),
        ("WARC-Record-ID", urn(F.col("page_id"))),
        ("WARC-Date", F.date_format(seconds, "yyyy-MM-dd'T'HH:mm:ss'Z'")),
        ("WARC-Target-URI", F.regexp_replace("url", "[\\r\\n]", "")),
        ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        ("WARC-Profile", F.when(revisit, PROFILE)),
        ("WARC-Refers-To", F.when(revisit, urn(F.col("refers_to")))),
        ("X-Page-Id", F.col("page_id").cast("string")),
        ("X-Refers-To-Page", F.col("refers_to").cast("string")),
        ("X-Payload-Length", F.col("payload_bytes").cast("string")),
        ("Content-Type", F.lit("application/http; msgtype=response")),
        ("Content-Length", F.octet_length(block).cast("string")),
    ]
    head = [F.when(v.isNotNull(), F.concat(F.lit(f"{k}: "), v, F.lit(CRLF))).otherwise("") for k, v in lines]
    return F.concat(F.lit(separator(run)), *head, F.lit(CRLF), block)


def separator(run: str) -> str:
    return f"WARC/1.1{CRLF}X-Capture-Run: {run}{CRLF}"


def write_archives(pages: DataFrame, path: str, min_bytes: int = 0) -> str:
    """Write the archives under ``path``; returns the run's identifier."""
    run = uuid.uuid4().hex
    records = captures(pages, min_bytes).select(record(run).alias("value"))
    records.write.option("lineSep", CRLF * 2).option("compression", "gzip").text(path)
    return run


def read_archives(spark: SparkSession, path: str, run: str) -> DataFrame:
    """``page_id, url, ts, record_type, payload_digest, payload_bytes,
    refers_to, payload`` of every record.  A block that is not as long as its
    header says, or a payload with another digest, is an error."""
    v = F.col("value")
    r = spark.read.option("lineSep", separator(run)).text(path).where(v != "")
    head = F.concat(F.substring_index(v, CRLF * 2, 1), F.lit(CRLF))
    r = r.select(head.alias("head"), v.substr(F.length(head) + 3, F.length(v) - F.length(head) - 6).alias("block"))

    def field(name: str) -> Column:
        found = F.regexp_extract("head", f"(?:^|\\n){name}: ([^\\r\\n]*)\\r\\n", 1)
        return F.when(found != "", found)

    r = r.select(
        field("X-Page-Id").cast("long").alias("page_id"),
        F.coalesce(field("WARC-Target-URI"), F.lit("")).alias("url"),
        field("WARC-Date").alias("ts"),
        field("WARC-Type").alias("record_type"),
        F.substring_index(field("WARC-Payload-Digest"), ":", -1).alias("payload_digest"),
        field("X-Payload-Length").cast("long").alias("payload_bytes"),
        field("X-Refers-To-Page").cast("long").alias("refers_to"),
        field("Content-Length").cast("long").alias("length"),
        "block",
    )
    payload = F.col("block").substr(F.lit(len(HTTP_HEAD) + 1), F.length("block"))
    whole = F.octet_length("block") == F.col("length")
    same = (F.col("record_type") == "revisit") | (
        (base32_sha1(payload) == F.col("payload_digest")) & (F.octet_length(payload) == F.col("payload_bytes"))
    )
    checked = F.when(whole & same, F.col("record_type")).otherwise(F.raise_error(F.lit("damaged archive record")))
    return r.select(
        "page_id", "url", "ts", checked.alias("record_type"), "payload_digest", "payload_bytes", "refers_to", payload.alias("payload")
    )


def url_key(url: Column) -> Column:
    """The URL with its host reversed label by label: keys of one site are
    neighbours.  Scheme, leading ``www``, port and fragment do not count."""
    rest = F.regexp_replace(F.lower(url), "^[a-z][a-z0-9+.-]*://(?:www[0-9]*\\.)?|#.*$", "")
    host = F.regexp_extract(rest, "^[^/:?]*", 0)
    path = F.regexp_replace(F.substr(rest, F.length(host) + 1), "^:[0-9]+", "")
    return F.concat(F.array_join(F.reverse(F.split(host, "\\.")), ","), F.lit(")"), path)


class LoserTree:
    """Merges k sorted lists: each inner node holds the loser of its match,
    so the next least item costs one walk from its leaf to the root."""

    def __init__(self, runs: list[list[Any]]) -> None:
        self.runs = runs
        self.at = [0] * len(runs)
        self.losers = [-1] * len(runs)
        for leaf in range(len(runs)):
            self._play(leaf)

    def _less(self, a: int, b: int) -> bool:
        if self.at[a] >= len(self.runs[a]):
            return False
        if self.at[b] >= len(self.runs[b]):
            return True
        x, y = self.runs[a][self.at[a]], self.runs[b][self.at[b]]
        return (x, a) < (y, b)

    def _play(self, winner: int) -> None:
        node = (winner + len(self.runs)) // 2
        while node:
            waiting = self.losers[node]
            if waiting < 0:  # the opponent has not come yet
                self.losers[node] = winner
                return
            if self._less(waiting, winner):
                self.losers[node], winner = winner, waiting
            node //= 2
        self.losers[0] = winner

    def __iter__(self) -> Iterator[tuple[int, int]]:
        """Run and place of each item, in order."""
        while self.runs:
            best = self.losers[0]
            if self.at[best] >= len(self.runs[best]):
                return
            yield best, self.at[best]
            self.at[best] += 1
            self._play(best)


def sorted_runs(index: DataFrame) -> DataFrame:
    """The index, every split sorted by itself and written as a run."""
    order = ["urlkey", "ts", "page_id"]
    runs = index.withColumn("run", F.spark_partition_id()).sortWithinPartitions(*order)
    return materialize(runs, "index-runs")


def merge_index(runs: DataFrame) -> DataFrame:
    """All entries in global order of URL key, timestamp and page."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        whole = pa.Table.from_batches(held)
        keys = [whole.column(c).to_pylist() for c in ("urlkey", "ts", "page_id")]
        slices: list[list[tuple]] = []
        first: list[int] = []
        last = None
        for i, (run, *key) in enumerate(zip(whole.column("run").to_pylist(), *keys, strict=True)):
            if run != last:
                slices.append([])
                first.append(i)
                last = run
            slices[-1].append((key[0], key[1], -1 if key[2] is None else key[2]))
        order = [first[k] + i for k, i in LoserTree(slices)]
        yield from whole.drop_columns(["run"]).take(order).combine_chunks().to_batches()

    order = ["urlkey", "ts", "page_id"]
    ranges = runs.repartitionByRange(*order).sortWithinPartitions("run", *order)
    return ranges.mapInArrow(merge, INDEX)


def archive(pages: DataFrame, path: str | None = None, min_bytes: int = 0) -> DataFrame:
    """Write the pages, read the archives back and merge their index."""
    spark = pages.sparkSession
    path = path or os.path.join(scratch_path(spark, "warc"), "archives")
    run = write_archives(pages, path, min_bytes)
    entries = read_archives(spark, path, run)
    index = entries.select(
        url_key(F.col("url")).alias("urlkey"), "ts", "page_id", "record_type", "payload_digest", "payload_bytes", "refers_to"
    )
    return merge_index(sorted_runs(index))
