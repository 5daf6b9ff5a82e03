"""Detection of periodic runs of words.

A run is a stretch of words that repeats with its smallest period q, at least
four times over and at least six words long, and that no neighbouring word
extends.  In the plane of word positions and lags it is a diagonal of matches:
word i equals word i - q.  The diagonals are followed online: the cells of a
word, one for each lag at which an earlier occurrence may belong to a run, add
one to the match length of the active diagonal of that lag; a diagonal that a
word does not continue ends there, and is emitted at once if it is long enough.

The cells are sparse.  A run of period q, 2**k <= q < 2**(k + 1), matches at
lag q over 3 * q words or more, so an earlier occurrence counts only where the
next 3 * 2**k words (5 for q = 1) agree too.  Of those only the nearest one
can lie on a run: were there a nearer one at distance d, the stretch from it
to the end of the agreeing words would have both periods d and q and hold at
least d + q words, hence (Fine and Wilf) the period gcd(d, q), and q would not
be the smallest.  By the same argument a diagonal of 3 * q such matches is
maximal and q its smallest period, so multiples of a period never show.  Each
class of lags thus gives a word one cell at most: n log n cells for n words,
"a a a ..." included, and only words of a class whose agreeing words occur
twice in the document are looked at in the next class.

Everything about a document is found in the task that reads it: no shuffle.
Words are compared by their 64-bit hashes.

Defined results: a null or empty text has no words and no run, its four run
columns are null and both hashes are those of the empty string; repeated rows
are answered each; a null id is carried, and with ``plant`` such a text stays
as it is; an empty table gives an empty result; other columns are ignored,
whatever their names.  Ties of length/period go to the smaller start, then to
the smaller period.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portmart.llm import tokens
from portmart.llm.common import text_of, words

LEAST_WORDS = 6
LEAST_POWER = 4

RESULT = (
    "n_words long, n_runs long, start long, length long, period long, exponent_milli long, "
    "runs_sha256 string, collapsed_sha256 string, n_dropped long, runs array<struct<start:long,length:long,period:long>>"
)


def least_match(lag: int) -> int:
    """Words that must match at ``lag`` for a run of that period."""
    return max(LEAST_WORDS, LEAST_POWER * lag) - lag


def cells(hashes: np.ndarray, doc: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, int]]:
    """For each class of lags the matching cells, as positions in order,
    their lags, and how many words from the position on agree.

    ``hashes`` are the words of several documents in a row, ``doc`` the
    document of each."""
    found = []
    longest = int(np.bincount(doc).max()) if len(doc) else 0
    at, k = np.arange(len(hashes)), 0
    while len(at) and LEAST_POWER << k <= longest:
        low, high = 1 << k, 2 << k
        agree = min(least_match(q) for q in range(low, min(high, low + 2)))
        runs = tokens.run_hashes(hashes, agree)
        at = at[at < len(runs)]
        at = at[doc[at] == doc[at + agree - 1]]
        key = tokens.mix(runs[at] + doc[at].astype(np.uint64) * np.uint64(tokens.BYTE_BASE))
        order = np.argsort(key, kind="stable")
        key, place = key[order], at[order]
        same = key[1:] == key[:-1]
        lag = place[1:] - place[:-1]
        near = same & (lag >= low) & (lag < high)
        here, lag = place[1:][near], lag[near]
        by_place = np.argsort(here)
        found.append((here[by_place], lag[by_place], agree))
        # Words that agree with nothing over this length agree with nothing over a longer one.
        twice = np.zeros(len(place), bool)
        twice[1:] |= same
        twice[:-1] |= same
        at = np.sort(place[twice])
        k += 1
    return found


def diagonals(here: np.ndarray, lag: np.ndarray, agree: int) -> Iterator[tuple[int, int, int]]:
    """Runs as ``start, length, period`` from the cells of one class, read
    word by word: a class has one cell for a word, so one active diagonal."""
    active, matched, last = 0, 0, -2
    for i, q in zip(here.tolist(), lag.tolist(), strict=True):
        if i == last + 1 and q == active:
            matched += 1
        else:
            if matched and matched + agree - 1 >= least_match(active):
                yield last - matched + 1 - active, matched + agree - 1 + active, active
            active, matched = q, 1
        last = i
    if matched and matched + agree - 1 >= least_match(active):
        yield last - matched + 1 - active, matched + agree - 1 + active, active


def runs_of(texts: list[bytes]) -> list[list[tuple[int, int, int]]]:
    """The runs of each text, by start, then period."""
    hashes, counts = tokens.word_hashes(texts)
    first = np.concatenate([[0], np.cumsum(counts)])
    doc = np.repeat(np.arange(len(texts)), counts)
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for here, lag, agree in cells(hashes, doc):
        # A diagonal that reached into the next document would need agreeing words across the border.
        for start, length, period in diagonals(here, lag, agree):
            d = int(doc[start])
            out[d].append((start - int(first[d]), length, period))
    for runs in out:
        runs.sort(key=lambda r: (r[0], r[2]))
    return out


def strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run of greatest length/period, compared exactly."""
    best = None
    for run in runs:
        # Runs come by start, then period: only a greater ratio replaces.
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def collapse(text: bytes, runs: list[tuple[int, int, int]]) -> tuple[bytes, int, int]:
    """The words no run covers after its first period, joined by one space;
    the number of words and of dropped ones."""
    held = text.split()
    n, cut = len(held), []
    for start, length, period in sorted((s + q, s + m, q) for s, m, q in runs):
        if cut and start <= cut[-1][1]:
            cut[-1][1] = max(cut[-1][1], length)
        else:
            cut.append([start, length])
    for a, b in reversed(cut):
        del held[a:b]
    return b" ".join(held), n, n - len(held)


def _answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in tokens.slices(batches):
        texts = [t or b"" for t in batch.column(1).to_pylist()]
        rows = []
        for a, b in tokens.chunks(texts):
            for text, runs in zip(texts[a:b], runs_of(texts[a:b]), strict=True):
                kept, n, dropped = collapse(text, runs)
                best = strongest(runs)
                start, length, period = best or (None, None, None)
                lines = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
                rows.append(
                    (
                        n,
                        len(runs),
                        start,
                        length,
                        period,
                        1000 * length // period if best else None,
                        hashlib.sha256(lines.encode()).hexdigest(),
                        hashlib.sha256(kept).hexdigest(),
                        dropped,
                        [{"start": s, "length": m, "period": q} for s, m, q in runs],
                    )
                )
        long, run = pa.int64(), pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
        kinds = [long] * 6 + [pa.string()] * 2 + [long, pa.list_(run)]
        columns = list(zip(*rows, strict=True)) if rows else [()] * len(kinds)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *[pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]],
            ["doc_id", *[c.split()[0] for c in RESULT.split(", ")]],
        )


def find_runs(docs: DataFrame) -> DataFrame:
    """Per document ``doc_id`` and ``n_words, n_runs``, the strongest run
    ``start, length, period, exponent_milli``, the digests of all runs and of
    the collapsed text, ``n_dropped``, and ``runs``, by start, then period."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    source = docs.select("doc_id", text_of("text").cast("binary").alias("t"))
    return source.mapInArrow(_answer, f"doc_id {kind}, {RESULT}")


def plant(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` where the tenth of the documents that the checksum of
    the id names repeats a part of its words to the end, so that long periods
    occur: word i >= a becomes word a + (i - a) % p."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    chosen = F.when(h % 10 == 0, words(text_of("text")))
    held = docs.select("doc_id", "text", h.alias("_h"), chosen.alias("_w"))
    g, n = F.floor(F.col("_h") / 10), F.size("_w")
    part = held.select("doc_id", "text", "_h", "_w", F.when(n > 0, g % n).alias("_a"), g.alias("_g"))
    period = 1 + F.floor((F.size("_w") - F.col("_a")) / (3 + F.col("_g") % 8))
    part = part.withColumn("_p", period)
    a, p = F.col("_a").cast("int"), F.col("_p").cast("int")
    tail = F.slice("_w", a + 1, p)
    # Whole periods, and the words the last one has of them.
    rest = F.size("_w") - a
    again = F.flatten(F.array_repeat(tail, F.ceil(rest / p).cast("int")))
    planted = F.concat(F.slice("_w", F.lit(1), a), F.slice(again, F.lit(1), rest))
    hit = F.col("_w").isNotNull() & (F.size("_w") > 0)
    return part.select("doc_id", F.when(hit, F.array_join(planted, " ")).otherwise(F.col("text")).alias("text"))
