"""Mining of collocations: phrases far more frequent than their parts suggest.

Texts are lower-cased (A-Z), cut into pieces at ``. , ; : ! ?`` and line
breaks, and the pieces into words; phrases are counted for each language
apart.  The work climbs by phrase length, as Apriori allows: a phrase reaches
the threshold only if its first and its last words without one do.

1. Words are counted, one row for each word and Arrow batch.
2. For each length, the phrases whose two shorter parts may be frequent are
   dealt into buckets by a 64-bit hash and the buckets are counted; a phrase in
   a bucket under the threshold cannot be frequent.  What may be frequent is
   told to the tasks as a bit table of one size, whatever the corpus: bits that
   are shared by chance only let more phrases through.  The phrases of the
   buckets that remain are the candidates: none that is frequent is missing.
   A bucket also keeps the least mark (a short checksum) of the texts it was
   found in; only texts of that mark spell it, not every text that holds it.
3. The candidates are counted exactly, in one more pass over the texts.  At each
   position that may start a candidate stands a window, the longest phrase that
   may be one; a task sums equal windows and deals them out by their first two
   words, a row for each shard.  So are the candidates, in shards of about
   ``SHARD_PHRASES``.  The task that gets a shard builds a double-array trie of it and moves the states
   of all windows at once, one word deeper at a time; a window counts for every
   accepting state on its way.  Rows come sorted, a shard's candidates before its
   windows, so a task holds one trie and one batch, however many windows come.

A word is two symbols of the trie, the high and the low digits of its number,
so that no node has more than some thousand children and the nodes interleave.
The texts are read once for the words, once for each phrase length and twice for
the candidates, however many phrases are frequent.

Words, phrases and languages are told apart by 64-bit hashes until the
candidates; scores are exact (decimal arithmetic).

Defined results: a null text is empty; a null language is ``und``, the empty
text is a language of its own; repeated rows count each time; ids are not
read; ties go by the contract (score, then count, then phrase by bytes); an
empty table or one without a frequent phrase gives an empty result; other
columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from portmart.llm import tokens
from portmart.llm.common import materialize, text_of
from portmart.llm.substring_dedup import bit_table, is_set

MIN_COUNT = 10
MAX_WORDS = 3
ABSORBED_PERCENT = 50
BEST = 2000
SCORE_SCALE = 1_000_000
SHARD_PHRASES = 1 << 15
# Shards for each shuffle partition, so that partitions are even.
SHARDS_A_PARTITION = 4
RANK_PARTS = 64
MARKS = 0xFF
# Phrase positions that a task holds before it counts them.
POSITIONS_AT_ONCE = 1 << 20
# Windows that a task holds before it sums equal ones.
WINDOWS_AT_ONCE = 1 << 20
# Gaps of the double array that a node tries before it moves on.
GAPS_AT_ONCE = 32
# Counts below this stay exact: its square times the scale has 38 digits.
COUNT_TYPE = "decimal(15,0)"

# Characters that end a piece, and those that end a word in it.
PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
WORD_ENDS = b" \t"

_lower = np.arange(256, dtype=np.uint8)
_lower[ord("A") : ord("Z") + 1] += 32
_ends_piece = np.zeros(256, bool)
_ends_piece[list(PIECE_ENDS)] = True
_in_word = ~_ends_piece
_in_word[list(WORD_ENDS)] = False


class Positions(NamedTuple):
    """The words of some texts: the lower-cased bytes, each word's first byte
    and the one after its last, its key (hash of language and word), piece,
    row and text's mark."""

    data: np.ndarray
    first: np.ndarray
    last: np.ndarray
    key: np.ndarray
    piece: np.ndarray
    row: np.ndarray
    mark: np.ndarray


def language_salt(lang: str) -> int:
    return int.from_bytes(hashlib.blake2b(lang.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big")


def text_positions(texts: list[bytes], salts: np.ndarray, offset: int = 0) -> Positions:
    data = _lower[np.frombuffer(b"\n".join(texts), np.uint8)]
    inside = _in_word[data]
    edge = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8)))
    first, last = edge[::2], edge[1::2]
    row = np.searchsorted(np.cumsum([len(t) + 1 for t in texts]), first, side="right")
    piece = np.cumsum(_ends_piece[data])[first]
    mark = np.array([zlib.crc32(t) & MARKS for t in texts], np.uint8)[row]
    if not len(first):
        return Positions(data, first, last, np.zeros(0, np.uint64), piece, row + offset, mark)
    weighed = data.astype(np.uint64)
    weighed += np.uint64(1)
    weighed *= tokens.powers(tokens.BYTE_BASE, len(data))[: len(data)]
    weighed[~inside] = 0
    total = np.add.reduceat(weighed, first)
    total *= tokens.powers(pow(tokens.BYTE_BASE, -1, 1 << 64), len(data))[first]
    key = tokens.mix(tokens.mix(total) * np.uint64(tokens.WORD_BASE) + salts[row])
    return Positions(data, first, last, key, piece, row + offset, mark)


def batch_positions(batch: pa.RecordBatch) -> Iterator[Positions]:
    """Words of the texts of a batch (columns language, text) by chunks."""
    for start in range(0, batch.num_rows, tokens.ROWS_AT_ONCE):
        part = batch.slice(start, tokens.ROWS_AT_ONCE)
        langs = part.column(0).dictionary_encode()
        known = np.array([language_salt(x) for x in langs.dictionary.to_pylist()], np.uint64)
        salts, texts = known[langs.indices.to_numpy()], part.column(1).to_pylist()
        for a, b in tokens.chunks(texts):
            yield text_positions(texts[a:b], salts[a:b], start + a)


def climb(p: Positions, tables: list[np.ndarray]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For lengths 2, 3, ...: the length, the positions at which a phrase of
    it stands whose two shorter parts are in ``tables`` (of lengths 1, 2, ...),
    and the hashes of these phrases."""
    h, may = p.key, is_set(tables[0], p.key)
    for size in range(2, len(tables) + 2):
        at = np.flatnonzero(may[:-1] & may[1:])
        at = at[at + size - 1 < len(p.key)]
        at = at[p.piece[at] == p.piece[at + size - 1]]
        found = tokens.mix(h[at] * np.uint64(tokens.WORD_BASE) + p.key[at + size - 1])
        yield size, at, found
        if size <= len(tables):
            h, may = np.zeros(len(p.key), np.uint64), np.zeros(len(p.key), bool)
            h[at], may[at] = found, is_set(tables[size - 1], found)


def spelled(p: Positions, at: np.ndarray, size: int) -> list[bytes]:
    """The phrases of ``size`` words at these positions, joined by a space."""
    data = p.data.tobytes()
    spans = [(p.first[at + k].tolist(), p.last[at + k].tolist()) for k in range(size)]
    return [b" ".join(data[a[i] : b[i]] for a, b in spans) for i in range(len(at))]


def source(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), text_of("text").cast("binary").alias("t")
    )


def _examples(batch: pa.RecordBatch, held: list[tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes]]]) -> list[pa.Array]:
    """Hash, count, language and spelling, once for each hash of a batch."""
    h, n, row = (np.concatenate([x[i] for x in held]) for i in range(3))
    spelling = pa.array([s for *_, x in held for s in x], pa.binary())
    unique, at, group = np.unique(h, return_index=True, return_inverse=True)
    total = np.zeros(len(unique), np.int64)
    np.add.at(total, group, n)
    return [
        pa.array(unique.view(np.int64)),
        pa.array(total),
        batch.column(0).take(pa.array(row[at])),
        spelling.take(pa.array(at)),
    ]


def count_words(docs: DataFrame) -> DataFrame:
    """``h, lang, word, n``: occurrences of each word of each language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = []
            for p in batch_positions(batch):
                h, at, n = np.unique(p.key, return_index=True, return_counts=True)
                held.append((h, n, p.row[at], spelled(p, at, 1)))
            if held:
                yield pa.RecordBatch.from_arrays(_examples(batch, held), ["h", "n", "lang", "word"])

    each = source(docs).mapInArrow(run, "h long, n long, lang string, word binary")
    return each.groupBy("h", "lang", F.col("word").cast("string").alias("word")).agg(F.sum("n").alias("n"))


def marked(h: np.ndarray, mark: np.ndarray) -> np.ndarray:
    """One hash for a phrase hash and a mark."""
    return tokens.mix(h * np.uint64(tokens.WORD_BASE) + mark.astype(np.uint64))


def frequent_buckets(docs: DataFrame, tables: list[Broadcast], min_count: int) -> DataFrame:
    """``h, mark``: hashes of the phrases one word longer than ``tables``
    reach that stand at ``min_count`` places or more, and the least mark of
    the texts that hold them."""
    tables = list(tables)  # of this length

    def counted_rows(h: np.ndarray, mark: np.ndarray) -> pa.RecordBatch:
        order = np.argsort(h)
        h, mark = h[order], mark[order]
        first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
        return pa.RecordBatch.from_arrays(
            [
                pa.array(h[first].view(np.int64)),
                pa.array(np.diff(np.append(first, len(h)))),
                pa.array(np.minimum.reduceat(mark, first), pa.int32()),
            ],
            ["h", "n", "mark"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[np.ndarray] = []
        marks: list[np.ndarray] = []
        for batch in batches:
            for p in batch_positions(batch):
                *_, (_, at, h) = climb(p, [t.value for t in tables])
                found.append(h)
                marks.append(p.mark[at])
                if sum(map(len, found)) >= POSITIONS_AT_ONCE:
                    yield counted_rows(np.concatenate(found), np.concatenate(marks))
                    found, marks = [], []
        if sum(map(len, found)):
            yield counted_rows(np.concatenate(found), np.concatenate(marks))

    each = source(docs).mapInArrow(run, "h long, n long, mark int")
    counted = each.groupBy("h").agg(F.sum("n").alias("n"), F.min("mark").alias("mark"))
    return counted.where(F.col("n") >= min_count).select("h", "mark")


def mark_table(buckets: DataFrame) -> np.ndarray:
    """Bit table of the buckets' hashes joined with their marks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h = marked(batch.column(0).to_numpy().view(np.uint64), batch.column(1).to_numpy())
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64))], ["h"])

    return bit_table(buckets.select("h", "mark").mapInArrow(run, "h long"))


def spell_candidates(docs: DataFrame, tables: list[Broadcast], chosen: Broadcast) -> DataFrame:
    """``h, lang, phrase, keys`` of every phrase that ``tables`` lead to, where
    ``chosen`` holds it with the text's mark, once for each batch of such
    texts; ``keys`` are the keys of its words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held: dict[int, list] = {}
            for p in batch_positions(batch):
                for size, at, h in climb(p, [t.value for t in tables]):
                    may = is_set(chosen.value, marked(h, p.mark[at]))
                    h, one = np.unique(h[may], return_index=True)
                    at = at[may][one]
                    keys = np.stack([p.key[at + k] for k in range(size)], axis=1)
                    held.setdefault(size, []).append((h, keys, p.row[at], spelled(p, at, size)))
            for size, parts in held.items():
                h, keys, row = (np.concatenate([x[i] for x in parts]) for i in range(3))
                h, one = np.unique(h, return_index=True)
                spelling = pa.array([s for *_, x in parts for s in x], pa.binary())
                flat = pa.array(keys[one].reshape(-1).view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(h.view(np.int64)),
                        batch.column(0).take(pa.array(row[one])),
                        spelling.take(pa.array(one)),
                        pa.ListArray.from_arrays(pa.array(np.arange(len(h) + 1, dtype=np.int32) * size), flat),
                    ],
                    ["h", "lang", "phrase", "keys"],
                )

    each = source(docs).mapInArrow(run, "h long, lang string, phrase binary, keys array<long>")
    return each.withColumn("phrase", F.col("phrase").cast("string"))


class DoubleArray(NamedTuple):
    """A trie in two arrays: the child of state s by symbol c is t = base[s] + c
    if check[t] = s.  ``accept`` numbers the accepting states from 0, -1 else;
    ``symbols`` are the word keys in order, a word's number is its place."""

    base: np.ndarray
    check: np.ndarray
    accept: np.ndarray
    symbols: np.ndarray
    low_bits: int


def _place(owner: np.ndarray, symbol: np.ndarray, n_nodes: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Slots of the edges (``owner`` node in order, ``symbol``) so that the
    children of a node keep the distances of their symbols, and each node's
    base.  Nodes of many children come first and take the next gap that fits
    them, single children then fill what is left free."""
    base = np.zeros(n_nodes, np.int64)
    slot = np.zeros(len(owner), np.int64)
    nodes, first, size = np.unique(owner, return_index=True, return_counts=True)
    used = np.zeros(2 * len(owner) + 8 * width, bool)
    used[: width + 1] = True  # the root, and room for bases of 0 or more
    magnitude, low = -1, 0
    for j in np.argsort(-size, kind="stable"):
        if size[j] == 1:
            break
        if int(size[j]).bit_length() != magnitude:  # smaller nodes try the gaps that larger ones left
            magnitude, low = int(size[j]).bit_length(), width + 1
        codes = symbol[first[j] : first[j] + size[j]]
        while True:
            if low + 4 * width >= len(used):
                used = np.concatenate([used, np.zeros(len(used), bool)])
            gaps = low + np.flatnonzero(~used[low : low + width])[:GAPS_AT_ONCE]
            fits = gaps[~used[(gaps - codes[0])[:, None] + codes].any(axis=1)]
            if len(fits):
                break
            low += width // 2
        base[nodes[j]] = fits[0] - codes[0]
        taken = base[nodes[j]] + codes
        used[taken] = True
        slot[first[j] : first[j] + size[j]] = taken
    alone = np.flatnonzero(size == 1)
    free = np.flatnonzero(~used)
    if len(free) < len(alone):
        free = np.concatenate([free, np.arange(len(used), len(used) + len(alone))])
    free = free[: len(alone)]
    base[nodes[alone]] = free - symbol[first[alone]]
    slot[first[alone]] = free
    return slot, base


def build_trie(keys: np.ndarray, lengths: np.ndarray) -> DoubleArray:
    """The trie of key sequences (uint64) that stand in a row, each of its
    length; sequence i is accepted as i."""
    symbols, code = np.unique(keys, return_inverse=True)
    low_bits = (max(len(symbols) - 1, 1).bit_length() + 1) // 2
    width = 1 << low_bits
    begin = np.cumsum(lengths) - lengths
    digits = np.stack([code >> low_bits, code & (width - 1)], axis=1)
    # Nodes by depth: the distinct pairs of a parent node and a digit; 0 is the root.
    node = np.zeros(len(lengths), np.int64)
    owners, edges, nodes = [], [], 1
    final = np.zeros(len(lengths), np.int64)
    for depth in range(2 * int(lengths.max())):
        on = np.flatnonzero(2 * lengths > depth)
        digit = digits[begin[on] + depth // 2, depth % 2]
        pair, at = np.unique(node[on] * width + digit, return_inverse=True)
        owners.append(pair // width)
        edges.append(pair % width)
        node[on] = nodes + at
        nodes += len(pair)
        final[on] = node[on]
    owner, edge = np.concatenate(owners), np.concatenate(edges)
    order = np.lexsort((edge, owner))
    slot, base_of = _place(owner[order], edge[order], nodes, width)
    slots = np.zeros(nodes, np.int64)
    slots[order + 1] = slot  # edge k leads to node k + 1
    size = int(slots.max()) + width + 1
    base, check = np.zeros(size, np.int32), np.full(size, -1, np.int32)
    base[slots] = base_of
    check[slots[order + 1]] = slots[owner[order]]
    accept = np.full(size, -1, np.int32)
    accept[slots[final]] = np.arange(len(lengths))
    return DoubleArray(base, check, accept, symbols, low_bits)


def walk(
    trie: DoubleArray, key: np.ndarray, piece: np.ndarray, max_words: int, starts: np.ndarray | None = None
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each length, the positions (of ``starts``, else of all) at which a
    phrase of it stands, and its number: the states of all positions advance
    together, one word at a time."""
    code = np.searchsorted(trie.symbols, key)
    code[code == len(trie.symbols)] = 0
    known = trie.symbols[code] == key
    at = np.flatnonzero(known) if starts is None else starts[known[starts]]
    state = np.zeros(len(at), np.int32)
    for size in range(1, max_words + 1):
        inside = at + size - 1 < len(code)
        at, state = at[inside], state[inside]
        word = at + size - 1
        go = known[word] & (piece[word] == piece[at])
        at, state, word = at[go], state[go], code[word[go]]
        for shift, mask in ((trie.low_bits, -1), (0, (1 << trie.low_bits) - 1)):
            child = trie.base[state] + (word >> shift & mask)
            go = trie.check[child] == state
            at, state, word = at[go], child[go].astype(np.int32), word[go]
        number = trie.accept[state]
        yield at[number >= 0], number[number >= 0]


def accepted(trie: DoubleArray, p: Positions, max_words: int) -> Iterator[np.ndarray]:
    """For each length, the numbers of the phrases that stand in the texts."""
    for _, number in walk(trie, p.key, p.piece, max_words):
        yield number


class Windows(NamedTuple):
    """Phrases with the hash of each, how often it stands, its words and their
    keys, 0 after the last."""

    h: np.ndarray
    n: np.ndarray
    size: np.ndarray
    keys: np.ndarray


def windows_of(p: Positions, tables: list[np.ndarray], chosen: np.ndarray) -> Windows:
    """The longest phrase at each position that ``chosen`` holds."""
    max_words = len(tables) + 1
    size, h = np.zeros(len(p.key), np.int8), np.zeros(len(p.key), np.uint64)
    for length, at, found in climb(p, tables):
        may = is_set(chosen, found)
        size[at[may]], h[at[may]] = length, found[may]
    at = np.flatnonzero(size)
    size, keys = size[at], np.zeros((len(at), max_words), np.uint64)
    for k in range(max_words):
        on = size > k
        keys[on, k] = p.key[at[on] + k]
    return Windows(h[at], np.ones(len(at), np.int32), size, keys)


def summed(held: list[Windows]) -> Windows:
    """Equal windows as one."""
    h, n, size, keys = (np.concatenate(x) for x in zip(*held, strict=True))
    order = np.argsort(h)
    h = h[order]
    first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
    return Windows(h[first], np.add.reduceat(n[order], first), size[order[first]], keys[order[first]])


# Phrases of one shard: its place, the first two keys of each pair and how many
# phrases begin with it, then each phrase's words, further keys and value.
PACKED = ["place", "pairs", "below", "size", "rest", "value"]
PACKED_SCHEMA = "place long, pairs array<long>, below array<int>, size array<byte>, rest array<long>, value array<long>"


def packed(size: np.ndarray, keys: np.ndarray, value: np.ndarray, n_shards: int, counted: bool) -> pa.RecordBatch:
    """A row for each shard of these phrases; candidates, which are not
    ``counted``, have even places, windows the odd ones."""
    pair = tokens.mix(keys[:, 0] * np.uint64(tokens.WORD_BASE) + keys[:, 1])
    order = np.argsort(pair)
    size, keys, value = size[order], keys[order], value[order]
    # In the order of the pairs, as the hash is.
    shard = ((pair[order] >> np.uint64(32)) * np.uint64(n_shards) >> np.uint64(32)).astype(np.int64)
    new_shard = np.concatenate([[True], shard[1:] != shard[:-1]])
    new_pair = np.concatenate([[True], (keys[1:, :2] != keys[:-1, :2]).any(axis=1)]) | new_shard
    begin, of_pair = np.flatnonzero(new_shard), np.flatnonzero(new_pair)
    ends = np.append(begin, len(size))
    pairs = np.searchsorted(of_pair, ends)
    rest = np.concatenate([[0], np.cumsum(size.astype(np.int64) - 2)])[ends]
    further = keys[:, 2:][np.arange(2, keys.shape[1]) < size[:, None]]

    def lists(offsets: np.ndarray, values: np.ndarray) -> pa.ListArray:
        return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values))

    return pa.RecordBatch.from_arrays(
        [
            pa.array(2 * shard[begin] + counted),
            lists(2 * pairs, keys[of_pair, :2].reshape(-1).view(np.int64)),
            lists(pairs, np.diff(np.append(of_pair, len(size))).astype(np.int32)),
            lists(ends, size.astype(np.int8)),
            lists(rest, further.view(np.int64)),
            lists(ends, value.astype(np.int64)),
        ],
        PACKED,
    )


def unpacked(rows: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys in a row, words and value of each phrase."""
    pairs, below, size, rest, value = (rows.column(i).flatten().to_numpy() for i in range(1, 6))
    size, pairs = size.astype(np.int64), np.repeat(pairs.reshape(-1, 2), below, axis=0)
    start = np.cumsum(size) - size
    keys, further = np.zeros(int(size.sum()), np.int64), np.ones(int(size.sum()), bool)
    keys[start], keys[start + 1] = pairs[:, 0], pairs[:, 1]
    further[start] = further[start + 1] = False
    keys[further] = rest
    return keys.view(np.uint64), size, value


def deal_candidates(candidates: DataFrame, max_words: int, n_shards: int) -> DataFrame:
    """The candidates (``h, keys``) by shard; their values are ``h``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                size = batch.column(1).value_lengths().to_numpy()
                keys = np.zeros((len(size), max_words), np.uint64)
                keys[np.arange(max_words) < size[:, None]] = batch.column(1).flatten().to_numpy().view(np.uint64)
                yield packed(size, keys, batch.column(0).to_numpy(), n_shards, False)

    return candidates.select("h", "keys").mapInArrow(run, PACKED_SCHEMA)


def deal_windows(docs: DataFrame, tables: list[Broadcast], chosen: Broadcast, n_shards: int) -> DataFrame:
    """The windows of the texts by shard, equal ones of a task summed as far
    as ``WINDOWS_AT_ONCE`` allows; their values are their numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[Windows] = []
        for batch in batches:
            for p in batch_positions(batch):
                held.append(windows_of(p, [t.value for t in tables], chosen.value))
                if sum(len(w.h) for w in held) >= WINDOWS_AT_ONCE:
                    held = [summed(held)]
                    if 4 * len(held[0].h) >= 3 * WINDOWS_AT_ONCE:
                        w = held.pop()
                        yield packed(w.size, w.keys, w.n, n_shards, True)
        if sum(len(w.h) for w in held):
            w = summed(held)
            yield packed(w.size, w.keys, w.n, n_shards, True)

    return source(docs).mapInArrow(run, PACKED_SCHEMA)


def count_shards(rows: DataFrame, max_words: int) -> DataFrame:
    """``h, n``: exact occurrences of the candidates in the windows; ``rows``
    have each shard's candidates and then its windows in a row."""

    def counts(h: np.ndarray, total: np.ndarray) -> pa.RecordBatch:
        some = np.flatnonzero(total)
        return pa.RecordBatch.from_arrays([pa.array(h[some]), pa.array(total[some])], ["h", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, held, trie = -1, [], None
        h = total = np.zeros(0, np.int64)
        for batch in batches:
            for i, place in enumerate(batch.column(0).to_pylist()):
                if place >> 1 != shard:
                    yield counts(h, total)
                    shard, held, trie = place >> 1, [], None
                    h = total = np.zeros(0, np.int64)
                keys, size, value = unpacked(batch.slice(i, 1))
                if place % 2 == 0:
                    held.append((keys, size, value))
                    continue
                if trie is None and held:
                    keys_of, size_of, h = (np.concatenate(x) for x in zip(*held, strict=True))
                    trie, total, held = build_trie(keys_of, size_of), np.zeros(len(h), np.int64), []
                if trie is not None:
                    window = np.repeat(np.arange(len(size)), size)
                    for at, number in walk(trie, keys, window, max_words, np.cumsum(size) - size):
                        total += np.bincount(number, value[window[at]], len(h)).astype(np.int64)
        yield counts(h, total)

    return rows.mapInArrow(run, "h long, n long")


def count_candidates(
    docs: DataFrame, candidates: DataFrame, tables: list[Broadcast], n_candidates: int, shard_phrases: int
) -> DataFrame:
    """``h, n``: exact occurrences of the candidates (``h, keys``)."""
    max_words = len(tables) + 1
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n_shards = max(-(-n_candidates // shard_phrases), SHARDS_A_PARTITION * partitions)
    chosen = docs.sparkSession.sparkContext.broadcast(bit_table(candidates.select("h")))
    windows = deal_windows(docs, tables, chosen, n_shards)
    rows = deal_candidates(candidates, max_words, n_shards).unionByName(windows)
    rows = rows.repartition(-(-n_shards // SHARDS_A_PARTITION), F.shiftright("place", 1)).sortWithinPartitions("place")
    counted = materialize(count_shards(rows, max_words), "counts")
    chosen.destroy()
    return counted


def count_phrases(
    docs: DataFrame, words: DataFrame, min_count: int, max_words: int, shard_phrases: int
) -> DataFrame:
    """``lang, phrase, size, a``: phrases of 2 to ``max_words`` words that
    occur ``min_count`` times or more, and how often they do."""
    share = docs.sparkSession.sparkContext.broadcast  # each table once, for all passes
    tables = [share(bit_table(words.where(F.col("n") >= min_count).select("h")))]
    kept = []
    for size in range(2, max_words + 1):
        kept.append(materialize(frequent_buckets(docs, tables, min_count), f"buckets-{size}"))
        if size < max_words:
            tables.append(share(bit_table(kept[-1].select("h"))))
    buckets = reduce(DataFrame.unionByName, kept)
    chosen = share(mark_table(buckets))
    each = spell_candidates(docs, tables, chosen).join(buckets, "h", "left_semi")
    candidates = materialize(
        each.groupBy("h", "lang", "phrase").agg(F.any_value("keys").alias("keys")), "candidates"
    )
    chosen.destroy()
    n_candidates = candidates.count()
    if not n_candidates:
        return candidates.select("lang", "phrase", F.size("keys").alias("size"), F.lit(0).cast("long").alias("a"))
    counts = count_candidates(docs, candidates, tables, n_candidates, shard_phrases)
    for table in tables:
        table.destroy()
    found = candidates.join(counts, "h").where(F.col("n") >= min_count)
    return materialize(found.select("lang", "phrase", F.size("keys").alias("size"), F.col("n").alias("a")), "phrases")


def score(phrases: DataFrame, words: DataFrame) -> DataFrame:
    """``phrases`` with ``l, r, score`` of their worst cut."""
    parts = phrases.select("lang", F.col("phrase").alias("part"), F.col("a").alias("f")).unionByName(
        words.select("lang", F.col("word").alias("part"), F.col("n").alias("f"))
    )
    parts = materialize(parts, "parts")
    held = F.split("phrase", " ")
    cut = phrases.select("*", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k")).select(
        "*",
        F.array_join(F.slice(held, F.lit(1), F.col("k")), " ").alias("head"),
        F.array_join(F.slice(held, F.col("k") + 1, F.col("size")), " ").alias("rest"),
    )
    heads = parts.select("lang", F.col("part").alias("head"), F.col("f").alias("l"))
    rests = parts.select("lang", F.col("part").alias("rest"), F.col("f").alias("r"))
    met = cut.join(heads, ["lang", "head"]).join(rests, ["lang", "rest"])
    exact = f"CAST(({SCORE_SCALE} * (CAST(a AS {COUNT_TYPE}) * CAST(a AS {COUNT_TYPE}))) DIV (CAST(l AS {COUNT_TYPE}) * CAST(r AS {COUNT_TYPE})) AS BIGINT)"
    met = met.withColumn("score", F.expr(exact))
    worst = met.groupBy("lang", "phrase", "size", "a").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("cut")
    )
    return worst.select("lang", "phrase", "size", "a", "cut.l", "cut.r", "cut.score")


def drop_absorbed(phrases: DataFrame, scored: DataFrame, percent: int) -> DataFrame:
    """Without the phrases that mostly occur inside one longer candidate."""
    held = F.split("phrase", " ")
    longer = phrases.where("size > 2").select("lang", "a", "size", held.alias("w"))
    spans = longer.select("*", F.explode(F.sequence(F.lit(2), F.col("size") - 1)).alias("m"))
    spans = spans.select("*", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("m") + 1)).alias("at"))
    inner = spans.select("lang", F.array_join(F.slice("w", F.col("at"), F.col("m")), " ").alias("phrase"), "a")
    most = inner.groupBy("lang", "phrase").agg(F.max("a").alias("most"))
    met = scored.join(most, ["lang", "phrase"], "left")
    return met.where(F.col("most").isNull() | (100 * F.col("most") < percent * F.col("a"))).drop("most")


def mine(
    docs: DataFrame,
    min_count: int = MIN_COUNT,
    max_words: int = MAX_WORDS,
    absorbed_percent: int = ABSORBED_PERCENT,
    best: int = BEST,
    shard_phrases: int = SHARD_PHRASES,
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the ``best`` phrases of each
    language.  Reads ``lang`` and ``text`` of ``docs``."""
    words = materialize(count_words(docs), "words")
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    phrases = count_phrases(docs, words, min_count, max_words, shard_phrases)
    scored = score(phrases, words.where(F.col("n") >= min_count))
    kept = drop_absorbed(phrases, scored, absorbed_percent)
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # The best of a part first, so no task ranks all phrases of a language.
    part = F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS))
    for keys in (["lang", part], ["lang"]):
        kept = kept.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
        kept = kept.where(F.col("rank") <= best)
    return kept.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )
