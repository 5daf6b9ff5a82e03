"""Words and word runs of many texts at once, as 64-bit hashes in numpy.

Runs inside Spark's Arrow workers, one batch of texts at a time.  A word's
hash is the polynomial of its bytes modulo 2**64, mixed; runs of words are
Rabin-Karp polynomials of the words' hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20
# Tables of powers are as long as they have to be, rounded up to this.
POWERS_STEP = 1 << 16
# Rows of an Arrow batch that are Python objects at a time.
ROWS_AT_ONCE = 1000
BYTE_BASE = 0x9E3779B97F4A7C15
WORD_BASE = 0xD6E8FEB86659FD93

_is_space = np.zeros(256, bool)
_is_space[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """1, base, base**2, ... modulo 2**64, at least n of them."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        row = np.full(-(-max(n, 1) // POWERS_STEP) * POWERS_STEP, base, np.uint64)
        row[0] = 1
        have = _powers[base] = np.multiply.accumulate(row)
        if n > 8 * CHUNK_BYTES:  # a rare giant must not stay in memory
            del _powers[base]
    return have


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every input bit over all 64 output bits."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte of each word of ``data`` and the byte after its last."""
    inside = ~_is_space[data]
    edge = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8)))
    return edge[::2], edge[1::2]


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of all texts in order, and the words per text."""
    data = np.frombuffer(b"\n".join(texts), np.uint8)
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(texts), np.int64)
    first, _ = word_spans(data)
    ends = np.cumsum([len(t) + 1 for t in texts])
    counts = np.diff(np.searchsorted(first, np.concatenate([[0], ends])))
    if not len(first):
        return np.zeros(0, np.uint64), counts
    weighed = data.astype(np.uint64)
    weighed += np.uint64(1)
    weighed *= powers(BYTE_BASE, len(data))[: len(data)]
    weighed[_is_space[data]] = 0
    total = np.add.reduceat(weighed, first)
    total *= powers(pow(BYTE_BASE, -1, 1 << 64), len(data))[first]
    return mix(total), counts


def run_hashes(words: np.ndarray, width: int, base: int = WORD_BASE) -> np.ndarray:
    """Rabin-Karp hash of the run of ``width`` words that starts at each
    word, for all starts at which a whole run fits."""
    n = len(words) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    rising = powers(base, len(words))
    sums = np.concatenate([[np.uint64(0)], np.cumsum(words * rising[: len(words)])])
    return mix((sums[width:] - sums[:-width]) * powers(pow(base, -1, 1 << 64), len(words))[:n])


def chunks(texts: list[bytes | None], chunk_bytes: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``chunk_bytes`` each; a longer text ends one."""
    start, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t or b"")
        if size >= chunk_bytes:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of at most ``ROWS_AT_ONCE`` rows.  A piece is a
    copy: whoever keeps one does not keep the whole batch in memory while the
    next batch is read.  Spark keeps its Python workers between tasks, so what
    a batch took is given back to the system after it."""
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS_AT_ONCE):
            yield batch.take(pa.array(np.arange(start, min(start + ROWS_AT_ONCE, batch.num_rows))))
        del batch
        for pool in (pa.default_memory_pool(), pa.system_memory_pool()):  # the latter also has numpy's arrays
            pool.release_unused()
