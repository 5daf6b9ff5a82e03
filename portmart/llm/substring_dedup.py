"""Removal of repeated word windows.

Every window of ``width`` consecutive words is hashed (Rabin-Karp) and the
windows are counted in Spark; words covered by a window that starts at two or
more places go, and overlapping repeated windows merge into maximal intervals.

Counting every window of a large corpus would shuffle one row per word.  Equal
windows hold equal anchors, though: the anchor of a window is the run of
``anchor`` words in it with the least hash, and neighbouring windows mostly
share theirs.  So anchors are counted first, about one for every
``(width - anchor) / 2`` words, and then those windows whose anchor occurs at
two or more places: a window whose anchor is unique cannot be repeated.  The
repeated anchors go to the tasks as a bit table of one size, ``FILTER_BITS``;
bits that anchors share by chance only add windows to the count.  Windows are
compared by two 64-bit hashes.

In the end only the texts whose hash is in a second such table are shuffled to
meet their intervals; the others pass as they are.

Before either count a batch sums what it holds itself: windows found twice in
it are decided there, as intervals, and one row tells the other batches.  So
a passage that one third of all rows share reaches a task once per batch.

Defined results: a null or empty text has no words, nothing is removed, and
the hash is that of the empty string; a text shorter than the window keeps
all its words; repeated rows are two documents, so their windows repeat;
null ids are carried; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portmart.llm import tokens
from portmart.llm.common import materialize, text_of

WIDTH = 35
ANCHOR = 18
FILTER_BITS = 27
FILTER_BLOCK_BITS = 18
WINDOWS_AT_ONCE = 250_000
SECOND_BASE = 0xA0761D6478BD642F


def text_windows(column: pa.Array, width: int) -> Iterator[tuple[int, np.ndarray]]:
    """Each text with a window, by its place, and its words' hashes."""
    for offset in range(0, len(column), tokens.ROWS_AT_ONCE):
        texts = column.slice(offset, tokens.ROWS_AT_ONCE).to_pylist()
        for a, b in tokens.chunks(texts):
            hashes, counts = tokens.word_hashes([t or b"" for t in texts[a:b]])
            start = 0
            for i, n in enumerate(counts):
                if n >= width:
                    yield offset + a + i, hashes[start : start + n]
                start += n


def least_in_window(values: np.ndarray, size: int) -> np.ndarray:
    """Place of the least of each ``size`` consecutive values, the last of
    equal ones, by doubling spans."""

    def better(i: np.ndarray, j: np.ndarray) -> np.ndarray:
        return np.where(values[i] < values[j], i, j)

    place, span = np.arange(len(values)), 1
    while 2 * span <= size:
        place = better(place[:-span], place[span:])
        span *= 2
    rest = size - span
    return better(place[: len(place) - rest], place[rest:]) if rest else place


def anchors(hashes: np.ndarray, width: int, anchor: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every run of ``anchor`` words, and each window's anchor."""
    runs = tokens.run_hashes(hashes, anchor)
    return runs, least_in_window(runs, width - anchor + 1)


def anchor_counts(docs: DataFrame, width: int = WIDTH, anchor: int = ANCHOR) -> DataFrame:
    """``h, n``: anchors and at how many places they stand."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.zeros(0, np.uint64)]
            for _, hashes in text_windows(batch.column(0), width):
                runs, place = anchors(hashes, width, anchor)
                found.append(runs[np.unique(place)])
            h, n = np.unique(np.concatenate(found), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n)], ["h", "n"])

    each = docs.select(text_of("text").cast("binary").alias("t")).mapInArrow(run, "h long, n long")
    return each.groupBy("h").agg(F.sum("n").alias("n"))


def bit_table(hashes: DataFrame) -> np.ndarray:
    """Bit table of the values of column ``h``: at most 2**FILTER_BITS bits
    reach the driver, however many values there are."""
    bit = F.col("h").bitwiseAND((1 << FILTER_BITS) - 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks: dict[int, np.ndarray] = {}
        for batch in batches:
            block, bits = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for b in np.unique(block):
                mine = blocks.setdefault(int(b), np.zeros(1 << FILTER_BLOCK_BITS, bool))
                mine[bits[block == b] & ((1 << FILTER_BLOCK_BITS) - 1)] = True
        for b, mine in blocks.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([b], pa.int64()), pa.array([np.packbits(mine).tobytes()])], ["block", "bits"]
            )

    placed = hashes.select(F.shiftright(bit, FILTER_BLOCK_BITS).alias("block"), bit.alias("bit"))
    parts = placed.repartition("block").mapInArrow(run, "block long, bits binary")
    table = np.zeros((1 << (FILTER_BITS - FILTER_BLOCK_BITS), 1 << (FILTER_BLOCK_BITS - 3)), np.uint8)
    for row in parts.collect():
        table[row["block"]] = np.frombuffer(row["bits"], np.uint8)
    return table.reshape(-1)


def is_set(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    bit = hashes & np.uint64((1 << FILTER_BITS) - 1)
    return (table[(bit >> np.uint64(3)).astype(np.int64)] >> (7 - (bit & np.uint64(7))).astype(np.uint8)) & 1 == 1


def intervals(doc: np.ndarray, pos: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of consecutive positions: document, first and one past the last."""
    order = np.lexsort((pos, doc))
    doc, pos = doc[order], pos[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (pos[1:] != pos[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(doc))[: len(first)] - 1
    return doc[first], pos[first], pos[last] + 1


def candidate_windows(
    docs: DataFrame, table: np.ndarray, width: int = WIDTH, anchor: int = ANCHOR
) -> DataFrame:
    """Windows whose anchor may be repeated, as ``h1, h2, weight, doc_id,
    text_hash, lo, hi``: weight 1 is a window to be counted, 2 tells that a
    window is repeated, 0 is an interval of windows already known to be."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(table)
    t = text_of("text")
    source = docs.select("doc_id", F.xxhash64(t).alias("text_hash"), t.cast("binary").alias("t"))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def rows(batch: pa.RecordBatch, held: list[tuple[int, np.ndarray, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        doc = np.repeat(np.array([d for d, *_ in held], np.int64), [len(p) for _, p, _, _ in held])
        pos = np.concatenate([p for _, p, _, _ in held])
        h1, h2 = (np.concatenate([x[k] for x in held]) for k in (2, 3))
        order = np.lexsort((h2, h1))
        new = np.ones(len(order), bool)
        a, b = h1[order], h2[order]
        new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        group = np.cumsum(new) - 1
        often = np.bincount(group)[group] >= 2
        # Singles in the order of the texts: their keys then compress.
        single, tell = np.sort(order[~often]), order[often & new]
        known, lo, hi = intervals(doc[order[often]], pos[order[often]])
        none = pa.nulls(len(tell), pa.int64())
        docs_out = pa.concat_arrays([pa.array(doc[single]), none, pa.array(known)])
        spread = tokens.mix(known.astype(np.uint64) * np.uint64(SECOND_BASE) + lo.astype(np.uint64))
        zeros = np.zeros(len(tell), np.int64)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate([h1[single], h1[tell], spread]).view(np.int64)),
                pa.array(np.concatenate([h2[single], h2[tell], spread]).view(np.int64)),
                pa.array(np.repeat(np.array([1, 2, 0], np.int32), [len(single), len(tell), len(known)])),
                batch.column(0).take(docs_out),
                batch.column(1).take(docs_out),
                pa.array(np.concatenate([pos[single], zeros, lo])),
                pa.array(np.concatenate([pos[single] + 1, zeros, hi])),
            ],
            ["h1", "h2", "weight", "doc_id", "text_hash", "lo", "hi"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        for batch in batches:
            held, size = [], 0
            for i, hashes in text_windows(batch.column(2), width):
                runs, place = anchors(hashes, width, anchor)
                pos = np.flatnonzero(is_set(bits, runs[place]))
                if len(pos):
                    first, second = tokens.run_hashes(hashes, width), tokens.run_hashes(hashes, width, SECOND_BASE)
                    held.append((i, pos, first[pos], second[pos]))
                    size += len(pos)
                if size >= WINDOWS_AT_ONCE:
                    yield rows(batch, held)
                    held, size = [], 0
            if held:
                yield rows(batch, held)

    return source.mapInArrow(
        run, f"h1 long, h2 long, weight int, doc_id {kind}, text_hash long, lo long, hi long"
    )


def repeated_windows(windows: DataFrame) -> DataFrame:
    """``doc_id, text_hash, lo, hi``: window starts that are repeated.  Reads
    its rows in order of the window and keeps one row at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The last window may go on in the next batch: its hashes, its weight so far, its row if unsent.
        key, weight_so_far, unsent = None, 0, None
        for batch in batches:
            if not batch.num_rows:
                continue
            h1, h2, weight = (batch.column(i).to_numpy() for i in range(3))
            new = np.ones(len(h1), bool)
            new[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
            group = np.cumsum(new) - 1
            total = np.bincount(group, weights=weight).astype(np.int64)
            goes_on = key == (h1[0], h2[0])
            if goes_on:
                total[0] += weight_so_far
                if unsent is not None and total[0] >= 2:
                    yield unsent
                    unsent = None
            else:
                unsent = None
            send = (weight == 0) | ((weight == 1) & (total[group] >= 2))
            payload = batch.select(["doc_id", "text_hash", "lo", "hi"])
            yield payload.filter(pa.array(send))
            key, weight_so_far = (h1[-1], h2[-1]), int(total[-1])
            single = np.flatnonzero((group == group[-1]) & (weight == 1))
            if weight_so_far == 1 and len(single):
                unsent = payload.slice(int(single[0]), 1)

    kind = windows.schema["doc_id"].dataType.simpleString()
    dealt = windows.repartition("h1", "h2").sortWithinPartitions("h1", "h2")
    return dealt.mapInArrow(run, f"doc_id {kind}, text_hash long, lo long, hi long")


def removals(docs: DataFrame, width: int = WIDTH, anchor: int = ANCHOR) -> DataFrame:
    """``doc_id, text_hash, spans``: per document the intervals of window
    starts that are repeated, each as ``first << 32 | one past the last``."""
    repeated = bit_table(anchor_counts(docs, width, anchor).where("n >= 2"))
    found = repeated_windows(candidate_windows(docs, repeated, width, anchor))
    span = F.shiftleft(F.col("lo"), 32).bitwiseOR(F.col("hi"))
    spans = found.groupBy("doc_id", "text_hash").agg(F.collect_set(span).alias("spans"))
    return materialize(spans, "removals")


def remove_repeats(docs: DataFrame, width: int = WIDTH, anchor: int = ANCHOR) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256, intervals, kept_text`` of
    every document; ``intervals`` are the maximal removed word ranges."""
    spans = removals(docs, width, anchor).select(
        F.col("doc_id").alias("s_id"), F.col("text_hash").alias("s_hash"), "spans"
    )
    # Only texts that may lose words travel to their intervals.
    shared = docs.sparkSession.sparkContext.broadcast(bit_table(spans.select(F.col("s_hash").alias("h"))))
    t = text_of("text")
    d = docs.select("doc_id", F.xxhash64(t).alias("text_hash"), t.cast("binary").alias("t"))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def concerned(wanted: bool) -> DataFrame:
        def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            table = shared.value
            for batch in batches:
                hashes = batch.column(1).to_numpy().view(np.uint64)
                yield batch.filter(pa.array(is_set(table, hashes) == wanted))

        return d.mapInArrow(pick, f"doc_id {kind}, text_hash long, t binary")

    some = concerned(True)
    some = some.join(spans, some["doc_id"].eqNullSafe(spans["s_id"]) & (some["text_hash"] == spans["s_hash"]), "left")
    whole = concerned(False).select("doc_id", "t", F.lit(None).cast("array<long>").alias("spans"))
    return whole.unionByName(some.select("doc_id", "t", "spans")).mapInArrow(
        cut_words(width),
        f"doc_id {kind}, n_words long, n_removed long, kept_sha256 string, "
        "intervals array<struct<from:long,to:long>>, kept_text string",
    )


def cut_words(width: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Cuts the words of the given window starts out of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tokens.slices(batches):
            texts, spans = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            sizes, gone, digest, ranges, kept = [], [], [], [], []
            for text, starts in zip(texts, spans, strict=True):
                held = text.split()
                sizes.append(len(held))
                cut: list[tuple[int, int]] = []
                for span in sorted(starts or ()):
                    a, b = span >> 32, (span & 0xFFFFFFFF) + width - 1
                    if cut and a <= cut[-1][1]:
                        cut[-1] = (cut[-1][0], max(b, cut[-1][1]))
                    else:
                        cut.append((a, b))
                for a, b in reversed(cut):
                    del held[a:b]
                gone.append(sizes[-1] - len(held))
                kept.append(b" ".join(held).decode("utf-8", "replace"))
                digest.append(hashlib.sha256(b" ".join(held)).hexdigest())
                ranges.append([{"from": a, "to": b} for a, b in cut])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(sizes, pa.int64()),
                    pa.array(gone, pa.int64()),
                    pa.array(digest, pa.string()),
                    pa.array(ranges, pa.list_(pa.struct([("from", pa.int64()), ("to", pa.int64())]))),
                    pa.array(kept, pa.string()),
                ],
                ["doc_id", "n_words", "n_removed", "kept_sha256", "intervals", "kept_text"],
            )

    return run
