"""Jaccard similarity join of documents on word shingles, by vertical
partitioning.

All shingles have one global order: by how frequent they are (a fixed-size
count sketch over the whole corpus), then by hash.  The sets of all documents
are cut at the same places of that order.

1. Documents with equal sets form a class; from here on classes are joined.
2. Two sets with Jaccard similarity t share a shingle among the first
   ``n - ceil(t n) + 1`` of either in the global order.  Classes that share
   one meet.  Each is paired with the smallest of them, the leader, and with
   one drawn for each shared shingle, which is linear in the size of a group
   of near copies and leaves most of a large group connected.
3. Pairs that the sizes and a bitmap of the sets rule out go.  For the rest
   the sets are cut into fragments of the global order, the overlap of each
   fragment is counted separately and summed per pair: exact similarity.
4. Components of the links.  Pairs inside one component need no verdict;
   where classes of different components still share a shingle as in 2, all
   those pairs are verified too.  The components are then complete.

A class is named by a 64-bit hash of its set.

Defined results: without words or text a document has no shingles, is linked
with nothing and is its own component; fewer than 5 words are one shingle;
repeated rows and null ids belong to the class of their text, and the
component is the least non-null id reachable; an empty table gives an empty
result; other columns are ignored by ``components`` and kept by
``keep_representatives``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.window import Window

from portmart.llm import tokens
from portmart.llm.common import discard, materialize, own_prefix, text_of
from portmart.llm.components import connected_components, merge_components
from portmart.llm.substring_dedup import bit_table, is_set

WIDTH = 5
PERCENT = 75
SKETCH_BITS = 20
SKETCH_BLOCKS = 64
FOLDED_BITS = 512
# Groups a class met others in before, that a row remembers.
BEFORE = 8
FRAGMENT_BITS = 3
SETS_AT_ONCE = 1000
# Bytes of text hashed at a time: a worker holds about 100 times as much for it,
# and keeps that when it is idle.
CHUNK_BYTES = 1 << 18
# Above this many times the sketch's mean count a shingle is dealt by a salt too.
HOT_FACTOR = 64
SALTS = 64

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def shingle_sets(texts: list[bytes | None], width: int = WIDTH) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of every text."""
    for a, b in tokens.chunks(texts, CHUNK_BYTES):
        words, counts = tokens.word_hashes([(t or b"").translate(_LOWER) for t in texts[a:b]])
        runs = tokens.run_hashes(words, width)
        start = 0
        for n in counts:
            if n >= width:
                found = runs[start : start + n - width + 1]
            elif n:
                found = tokens.run_hashes(words[start : start + n], int(n)) ^ np.uint64(n)
            else:
                found = words[:0]
            found = np.sort(found)
            yield found[np.concatenate([[True], found[1:] != found[:-1]])] if n else found
            start += n


def class_ids(sets: list[np.ndarray]) -> np.ndarray:
    """One number for each set, all with members: equal sets, equal numbers."""
    if not sets:
        return np.zeros(0, np.int64)
    sizes = np.array([len(s) for s in sets])
    members = tokens.mix(np.concatenate(sets) * np.uint64(tokens.BYTE_BASE) + np.uint64(1))
    first = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    return tokens.mix(np.add.reduceat(members, first) + sizes.astype(np.uint64)).view(np.int64)


def bitmap(found: np.ndarray) -> bytes:
    """One bit per bucket, about as many buckets as members: the parity of
    the members in it.  Sets that differ in d members have bitmaps that
    differ in at most d bits, also when both are folded."""
    bits = max(FOLDED_BITS, 1 << (len(found) - 1).bit_length())
    counts = np.bincount((found & np.uint64(bits - 1)).astype(np.int64), minlength=bits)
    return np.packbits(counts & 1).tobytes()


def fold(bits: np.ndarray, size: int) -> np.ndarray:
    """A bitmap of 64-bit words folded to ``size`` words."""
    return np.bitwise_xor.reduce(bits.reshape(-1, size), axis=0)


def least_overlap(n: np.ndarray, m: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """Least overlap of sets of n and m members with the similarity asked for."""
    return -(-(percent * (n + m)) // (100 + percent))


def describe(docs: DataFrame) -> DataFrame:
    """``doc_id, text_hash, n, class, bitmap, folded`` of every document with words,
    and rows with ``block`` and ``counts``: each partition's count sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = np.zeros(1 << SKETCH_BITS, np.uint32)
        for batch in tokens.slices(batches):
            sets = list(shingle_sets(batch.column(2).to_pylist()))
            named = np.zeros(len(sets), np.int64)
            held = [i for i, s in enumerate(sets) if len(s)]
            for part in (held[i : i + SETS_AT_ONCE] for i in range(0, len(held), SETS_AT_ONCE)):
                some = [sets[i] for i in part]
                named[part] = class_ids(some)
                places = (np.concatenate(some) >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)
                sketch += np.bincount(places, minlength=len(sketch)).astype(np.uint32)
            maps = [bitmap(s) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(named),
                    pa.array(maps, pa.binary()),
                    pa.array([fold(np.frombuffer(m, np.int64), FOLDED_BITS // 64) for m in maps], pa.list_(pa.int64())),
                    pa.nulls(len(sets), pa.int32()),
                    pa.nulls(len(sets), pa.binary()),
                ],
                NAMES,
            )
        blocks = sketch.reshape(SKETCH_BLOCKS, -1)
        used = [i for i in range(SKETCH_BLOCKS) if blocks[i].any()]
        yield pa.RecordBatch.from_arrays(
            [
                pa.nulls(len(used), id_type),
                pa.nulls(len(used), pa.int64()),
                pa.nulls(len(used), pa.int64()),
                pa.nulls(len(used), pa.int64()),
                pa.nulls(len(used), pa.binary()),
                pa.nulls(len(used), pa.list_(pa.int64())),
                pa.array(used, pa.int32()),
                pa.array([blocks[i].tobytes() for i in used], pa.binary()),
            ],
            NAMES,
        )

    NAMES = ["doc_id", "text_hash", "n", "class", "bitmap", "folded", "block", "counts"]
    kind = docs.schema["doc_id"].dataType.simpleString()
    id_type = to_arrow_type(docs.schema["doc_id"].dataType)
    t = text_of("text")
    return docs.select("doc_id", F.xxhash64(t).alias("text_hash"), t.cast("binary").alias("t")).mapInArrow(
        run, f"doc_id {kind}, text_hash long, n long, class long, bitmap binary, folded array<long>, block int, counts binary"
    )


def order_classes(described: DataFrame) -> tuple[np.ndarray, int]:
    """The frequency class of every sketch bucket, log2 of its count, and the
    class from which on a shingle counts as hot.  The sketch has one size
    whatever the corpus, so it is small enough for the driver and the tasks."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                one = np.frombuffer(counts, np.uint32).astype(np.uint64)
                sums[block] = sums[block] + one if block in sums else one
        for block, total in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([total.tobytes()])], ["block", "counts"])

    parts = described.where("block is not null").select("block", "counts").repartition(SKETCH_BLOCKS, "block")
    total = np.zeros((SKETCH_BLOCKS, (1 << SKETCH_BITS) // SKETCH_BLOCKS), np.uint64)
    for row in parts.mapInArrow(add, "block int, counts binary").collect():
        total[row["block"]] = np.frombuffer(row["counts"], np.uint64)
    total = total.reshape(-1)
    classes = np.ceil(np.log2(total + 1.0)).astype(np.uint8)
    return classes, int(np.ceil(np.log2(HOT_FACTOR * max(total.mean(), 1.0))))


def in_order(found: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Positions of the global order: frequency class above, hash below."""
    frequency = classes[(found >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)].astype(np.uint64)
    return (frequency << np.uint64(58)) | (found & np.uint64((1 << 58) - 1))


def prefixes(docs: DataFrame, classes: np.ndarray, hot: int, percent: int = PERCENT) -> DataFrame:
    """``token, salt, class, n``: the first shingles of every set, each class
    once per slice of a batch.  Tokens of hot shingles are dealt over salts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tokens.slices(batches):
            sets = [s for s in shingle_sets(batch.column(0).to_pylist()) if len(s)]
            if not sets:
                continue
            names, one = np.unique(np.concatenate([class_ids(sets[i : i + SETS_AT_ONCE]) for i in range(0, len(sets), SETS_AT_ONCE)]), return_index=True)
            sizes = np.array([len(sets[i]) for i in one], np.int64)
            lengths = sizes - -(-percent * sizes // 100) + 1
            token = np.concatenate(
                [np.partition(in_order(sets[i], classes), k - 1)[:k] for i, k in zip(one, lengths, strict=True)]
            )
            owner, size = np.repeat(names, lengths), np.repeat(sizes, lengths)
            salt = np.where(token >> np.uint64(58) >= hot, owner % SALTS, 0).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(token.view(np.int64)), pa.array(salt), pa.array(owner), pa.array(size)],
                ["token", "salt", "class", "n"],
            )

    return docs.select(text_of("text").cast("binary").alias("t")).mapInArrow(
        run, "token long, salt int, class long, n long"
    )


def meetings(tokens_of: DataFrame, hot: int, percent: int = PERCENT) -> DataFrame:
    """``token, part, class, n, leader, leader_n, other, other_n``: all classes
    that share a token, next to the smallest of them and to one drawn among
    those before, if another one.  Where only two share it, which one pair
    settles, the token is left out.  A token's classes come in order of size and are parted
    where the next is too large for any before it.  Streams over sorted rows,
    keeping only the leader and the last row; a salted token keeps all its
    rows, in one part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The last group may go on in the next batch: token, salt, leader, its
        # size, whether the leader was sent, and the last size.
        last: tuple | None = None
        for batch in batches:
            token, salt, owner, size = (batch.column(i).to_numpy() for i in range(4))
            if not len(token):
                continue
            changed = np.ones(len(token), bool)
            changed[1:] = (token[1:] != token[:-1]) | (salt[1:] != salt[:-1]) | (100 * size[:-1] < percent * size[1:])
            goes_on = last is not None and (token[0], salt[0]) == last[:2] and 100 * last[5] >= percent * size[0]
            first = np.flatnonzero(changed)
            group = np.cumsum(changed) - 1
            leader, leader_n = owner[first].copy(), size[first].copy()
            if goes_on:
                leader[0], leader_n[0] = last[2], last[3]
            other = owner != leader[group]
            meets = np.zeros(len(first), bool)
            np.logical_or.at(meets, group, other)
            # The leader's own row is sent with its group, once.
            own = ~other & changed & meets[group]
            late = []
            if goes_on:
                own[0] = False
                if meets[0] and not last[4]:
                    late.append(last[:4])
            dealt_twice = (token.view(np.uint64) >> np.uint64(58)) >= hot
            keep = other | own | dealt_twice
            extra = np.array(late, np.int64).reshape(-1, 4)
            part = np.where(dealt_twice, 0, leader_n[group])
            # Another draw for every token, so near copies meet many partners.
            here = np.arange(len(token))
            before = here - first[group]
            drawn = tokens.mix(token.view(np.uint64) + owner.view(np.uint64)) % np.maximum(before, 1).astype(np.uint64)
            drawn = first[group] + drawn.astype(np.int64)
            partner, partner_n = owner[drawn], size[drawn]
            same = (before == 0) | (partner == leader[group])
            # Two classes at most, in a group that this batch holds whole.
            new = changed.copy()
            new[1:] |= owner[1:] != owner[:-1]
            pair_only = np.bincount(group, weights=new) <= 2
            pair_only[-1] = False
            pair_only[0] &= not goes_on
            settled = pair_only[group] & ~dealt_twice
            none = np.zeros(len(extra), bool)
            settled_out = np.concatenate([none, settled[keep]])
            same_out = np.concatenate([~none, same[keep]])
            columns = [
                np.concatenate([extra[:, 0], token[keep]]),
                np.concatenate([extra[:, 3], part[keep]]),
                np.concatenate([extra[:, 2], owner[keep]]),
                np.concatenate([extra[:, 3], size[keep]]),
                np.concatenate([extra[:, 2], leader[group][keep]]),
                np.concatenate([extra[:, 3], leader_n[group][keep]]),
                np.concatenate([extra[:, 2], partner[keep]]),
                np.concatenate([extra[:, 3], partner_n[keep]]),
            ]
            masks = [settled_out, settled_out, None, None, None, None, same_out, same_out]
            yield pa.RecordBatch.from_arrays([pa.array(c, mask=m) for c, m in zip(columns, masks, strict=True)], NAMES)
            sent = bool(meets[-1] or dealt_twice[-1] or (goes_on and len(first) == 1 and last[4]))
            last = (int(token[-1]), int(salt[-1]), int(leader[-1]), int(leader_n[-1]), sent, int(size[-1]))

    NAMES = ["token", "part", "class", "n", "leader", "leader_n", "other", "other_n"]
    dealt = tokens_of.repartition("token", "salt").sortWithinPartitions("token", "salt", "n", "class")
    return dealt.mapInArrow(run, "token long, part long, class long, n long, leader long, leader_n long, other long, other_n long")


def alike_in_size(n: str, m: str, percent: int = PERCENT) -> F.Column:
    return 100 * F.least(n, m) >= percent * F.greatest(n, m)


def star_pairs(met: DataFrame, hot: int) -> DataFrame:
    """``a, n, b, m``: every class that met others with its leader and with the
    one drawn; for salted tokens also the leaders of the salts with the least
    of them.  Linear in the meetings."""
    drawn = met.select(F.col("other").alias("a"), F.col("other_n").alias("n"), F.col("class").alias("b"), F.col("n").alias("m"))
    own = met.select(F.col("leader").alias("a"), F.col("leader_n").alias("n"), F.col("class").alias("b"), F.col("n").alias("m"))
    salted = met.where(F.shiftrightunsigned("token", 58) >= hot).select("token", "leader", "leader_n").distinct()
    low = salted.groupBy("token").agg(F.min(F.struct("leader", "leader_n")).alias("low"))
    across = salted.join(low, "token").select(
        F.col("low.leader").alias("a"), F.col("low.leader_n").alias("n"), F.col("leader").alias("b"), F.col("leader_n").alias("m")
    )
    return own.unionByName(drawn).unionByName(across).where((F.col("a") != F.col("b")) & alike_in_size("n", "m")).distinct()


def mixed_meetings(found: DataFrame, component: DataFrame, written: list[DataFrame]) -> DataFrame:
    """``token, part, class, n, component`` where classes of different
    components share a token.  Adds the tables it reads to ``written``."""
    f = found.join(component, found["class"] == component["node"], "left")
    f = f.select("token", "part", "class", "n", F.coalesce("component", "class").alias("component"))
    f = materialize(f, "met-components")
    mixed = f.groupBy("token", "part").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
    mixed = materialize(mixed.where("lo < hi").select("token", "part"), "mixed-tokens")
    written += [f, mixed]
    return f.join(mixed, ["token", "part"])


def untested(pairs: DataFrame, tested: DataFrame) -> DataFrame:
    pairs = pairs.where((F.col("a") != F.col("b")) & alike_in_size("n", "m")).distinct()
    known = tested.select(F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi"))
    return pairs.join(
        known, (F.least("a", "b") == known["lo"]) & (F.greatest("a", "b") == known["hi"]), "left_anti"
    )


def crossing_pairs(mixed: DataFrame, classes_of: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``a, n, b, m``: all pairs of classes of different components that
    share a token, but for those that sizes or folded bitmaps rule out.

    Two classes of boilerplate share many tokens.  Each row carries the groups
    (token and part) its class stands in just before, in one order for all:
    where two rows have one of these in common, the pair met there already,
    so it is left to the first group that it shares."""
    group = F.xxhash64("token", "part")
    nearby = Window.partitionBy("class").orderBy("token", "part").rowsBetween(-BEFORE, -1)
    placed = mixed.withColumn("before", F.collect_list(group).over(nearby))
    folded = classes_of.select(F.col("class").alias("k"), "folded")
    rows = placed.join(folded, placed["class"] == folded["k"]).drop("k")
    x = rows.select(
        "token",
        "part",
        F.col("class").alias("a"),
        "n",
        F.col("component").alias("ca"),
        F.col("folded").alias("fa"),
        F.col("before").alias("ba"),
    )
    y = rows.select(
        "token",
        "part",
        F.col("class").alias("b"),
        F.col("n").alias("m"),
        F.col("component").alias("cb"),
        F.col("folded").alias("fb"),
        F.col("before").alias("bb"),
    )
    apart = F.lit(0)
    for i in range(FOLDED_BITS // 64):
        apart = apart + F.bit_count(F.col("fa")[i].bitwiseXOR(F.col("fb")[i]))
    # No more apart than n + m less twice the least overlap, in whole numbers.
    allowed = (100 + percent) * (F.col("n") + F.col("m") - apart) >= 2 * percent * (F.col("n") + F.col("m"))
    first = ~F.arrays_overlap("ba", "bb")
    met = x.join(y, ["token", "part"]).where((F.col("ca") < F.col("cb")) & alike_in_size("n", "m") & first & allowed)
    return met.select("a", "n", "b", "m")


def bitmaps_allow(pairs: DataFrame, classes_of: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs that their bitmaps do not rule out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tokens.slices(batches):
            n, m = batch.column(1).to_numpy(), batch.column(3).to_numpy()
            apart = np.zeros(len(n), np.int64)
            for i, (x, y) in enumerate(zip(batch.column(4).to_pylist(), batch.column(5).to_pylist(), strict=True)):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                size = min(len(x), len(y))
                apart[i] = np.bitwise_count(fold(x, size) ^ fold(y, size)).sum(dtype=np.int64)
            yield batch.select(["a", "n", "b", "m"]).filter(pa.array(apart <= n + m - 2 * least_overlap(n, m, percent)))

    x = classes_of.select(F.col("class").alias("ka"), F.col("bitmap").alias("xa"))
    y = classes_of.select(F.col("class").alias("kb"), F.col("bitmap").alias("xb"))
    both = pairs.join(x, pairs["a"] == x["ka"]).join(y, F.col("b") == y["kb"]).select("a", "n", "b", "m", "xa", "xb")
    return both.mapInArrow(run, "a long, n long, b long, m long")


def cuts(classes: np.ndarray, counts: int = 1 << FRAGMENT_BITS) -> np.ndarray:
    """Places at which the global order is cut, equal shares of the sketch
    between them."""
    mass = np.bincount(classes, weights=2.0**classes * (classes > 0), minlength=64)
    upto = np.cumsum(mass)
    out = []
    for k in range(1, counts):
        want = upto[-1] * k / counts
        c = int(np.searchsorted(upto, want))
        inside = (want - (upto[c] - mass[c])) / max(mass[c], 1.0)
        out.append((c << 58) + int(min(max(inside, 0.0), 1.0) * ((1 << 58) - 1)))
    return np.array(sorted(out), np.uint64)


def row_key(docs: DataFrame) -> Column:
    """Id and hash of the text, in a struct: nulls in it are equal.  Cast, as
    a struct of another nullability would be dealt out anew by a join."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    key = F.struct("doc_id", F.xxhash64(text_of("text")).alias("text_hash"))
    return key.cast(f"struct<doc_id:{kind},text_hash:bigint>")


def hash_of(key: str) -> Column:
    return F.xxhash64(F.col(key)["doc_id"], F.col(key)["text_hash"])


def may_be_among(hashes: DataFrame) -> Callable[[Column], Column]:
    """Whether a hash may be among those of column ``h``: always if it is, and
    seldom if not.  Told by a bit table of one size."""
    shared = hashes.sparkSession.sparkContext.broadcast(bit_table(hashes))

    def run(h: pa.Array) -> pa.Array:
        return pa.array(is_set(shared.value, h.to_numpy(zero_copy_only=False).view(np.uint64)))

    return F.arrow_udf(run, "boolean")


def fragments(
    docs: DataFrame, classes_of: DataFrame, wanted: DataFrame, classes: np.ndarray, written: list[DataFrame]
) -> DataFrame:
    """``class, fragment, members`` of the wanted classes, from one document
    of each."""
    places = cuts(classes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tokens.slices(batches):
            for name, s in zip(batch.column(0).to_pylist(), shingle_sets(batch.column(1).to_pylist()), strict=True):
                keys = in_order(s, classes)
                by_key = np.argsort(keys)
                parts = np.split(s[by_key], np.searchsorted(keys[by_key], places))
                held = [i for i, p in enumerate(parts) if len(p)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([name] * len(held), pa.int64()),
                        pa.array(held, pa.int32()),
                        pa.array([parts[i].view(np.int64) for i in held], pa.list_(pa.int64())),
                    ],
                    ["class", "fragment", "members"],
                )

    pick = classes_of.join(wanted, classes_of["class"] == wanted["w"], "left_semi").select(
        F.col("class"), F.struct(F.col("doc.doc_id").alias("doc_id"), F.col("doc.text_hash").alias("text_hash")).alias("k")
    )
    pick = materialize(pick, "wanted-rows")
    written.append(pick)
    d = docs.select(row_key(docs).alias("row"), text_of("text").cast("binary").alias("t"))
    # Only texts that may be wanted travel, once: rows that repeat are told by the key of the join.
    d = d.where(may_be_among(pick.select(hash_of("k").alias("h")))(hash_of("row"))).dropDuplicates(["row"])
    one = d.join(pick, d["row"] == pick["k"]).select("class", "t")
    return one.mapInArrow(run, "class long, fragment int, members array<long>")


def verified(
    pairs: DataFrame, docs: DataFrame, classes_of: DataFrame, classes: np.ndarray, percent: int = PERCENT
) -> DataFrame:
    """The pairs that reach the similarity, written: ``u, v, overlap``.  The
    overlap is counted per fragment and summed per pair."""
    written: list[DataFrame] = []
    p = materialize(bitmaps_allow(pairs, classes_of, percent), "allowed-pairs")
    wanted = p.select(F.col("a").alias("w")).unionByName(p.select(F.col("b").alias("w"))).distinct()
    f = materialize(fragments(docs, classes_of, wanted, classes, written), "fragments")
    fb = f.select(F.col("class").alias("kb"), "fragment", F.col("members").alias("mb"))
    fa = f.select(F.col("class").alias("ka"), F.col("fragment").alias("fragment_a"), F.col("members").alias("ma"))
    j = p.join(fb, p["b"] == fb["kb"]).join(fa, (F.col("a") == fa["ka"]) & (F.col("fragment") == fa["fragment_a"]))
    partial = j.select("a", "n", "b", "m", F.size(F.array_intersect("ma", "mb")).cast("long").alias("shared"))
    total = partial.groupBy("a", "n", "b", "m").agg(F.sum("shared").alias("overlap"))
    near = 100 * F.col("overlap") >= percent * (F.col("n") + F.col("m") - F.col("overlap"))
    links = materialize(total.where(near).select(F.col("a").alias("u"), F.col("b").alias("v"), "overlap"), "links")
    discard(p, f, *written)
    return links


def join(docs: DataFrame, percent: int = PERCENT) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``described`` documents, ``links`` between classes that connect all
    that is connected, and ``component`` per linked class."""
    described = materialize(describe(docs), "described")
    classes, hot = order_classes(described)
    with_words = described.where("n > 0")
    classes_of = materialize(
        with_words.groupBy("class").agg(
            F.min(F.struct("doc_id", "text_hash")).alias("doc"), F.any_value("bitmap").alias("bitmap"), F.any_value("folded").alias("folded")
        ),
        "classes",
    )
    met = materialize(meetings(prefixes(docs, classes, hot, percent), hot, percent), "met")
    stars = materialize(star_pairs(met, hot), "star-pairs")
    links = verified(stars, docs, classes_of, classes, percent)
    component = materialize(connected_components(links), "components")
    found = met.where("token is not null").select("token", "part", "class", "n").distinct()

    written: list[DataFrame] = [met, stars]
    crossing = crossing_pairs(mixed_meetings(found, component, written), classes_of, percent)
    crossing = materialize(untested(crossing, stars), "crossing-pairs")
    discard(*written)
    more = verified(crossing, docs, classes_of, classes, percent)
    if not more.isEmpty():
        links = links.unionByName(more)
        component = materialize(merge_components(component, more), "components")
    return described, links, component


def labelled(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``doc_id, text_hash, n, label`` of every document with words; ``label``
    is the class the component is named by."""
    described, _, component = join(docs, percent)
    d = described.where("n > 0").select("doc_id", "text_hash", "n", "class")
    return d.join(component, d["class"] == component["node"], "left").select(
        "doc_id", "text_hash", "n", F.coalesce("component", "class").alias("label")
    )


def components(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every document."""
    described, _, component = join(docs, percent)
    rows = described.where("n is not null")
    per_class = rows.where("n > 0").groupBy("class").agg(F.min("doc_id").alias("low"))
    c = per_class.join(component, per_class["class"] == component["node"], "left")
    c = materialize(c.select("class", "low", F.coalesce("component", "class").alias("label")), "class-labels")
    low = c.groupBy("label").agg(F.min("low").alias("component_id"))
    low = materialize(low, "label-ids").withColumnRenamed("label", "l")
    named = c.join(low, c["label"] == low["l"]).select(F.col("class").alias("k"), "component_id")
    named = materialize(named, "class-ids")
    out = rows.join(named, (rows["class"] == named["k"]) & (rows["n"] > 0), "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def keep_representatives(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """One document of each component, all columns kept: the least by id and
    text.  Documents without words all stay."""
    own = own_prefix(docs)
    rows = materialize(labelled(docs, percent), "labelled")
    first = rows.groupBy("label").agg(F.min(F.struct("doc_id", "text_hash")).alias("first"))
    first = materialize(first, "first-of-label").withColumnRenamed("label", "l")
    out = rows.join(first, rows["label"] == first["l"]).where(
        ~F.struct("doc_id", "text_hash").eqNullSafe(F.col("first"))
    )
    out = materialize(out.select(F.col("doc_id").alias(f"{own}id"), F.col("text_hash").alias(f"{own}hash")).distinct(), "others")
    repeated = rows.groupBy("doc_id", "text_hash").agg(F.count(F.lit(1)).alias("times")).where("times > 1")
    repeated = materialize(repeated.select(F.col("doc_id").alias(f"{own}id"), F.col("text_hash").alias(f"{own}hash")), "repeated")
    text_hash = F.xxhash64(text_of("text"))
    key = F.xxhash64(f"{own}id", f"{own}hash").alias("h")
    concerned = may_be_among(out.select(key).unionByName(repeated.select(key)))(F.xxhash64("doc_id", text_hash))
    # Only rows that may go travel to the join, the others stay where they are.
    untouched, docs = docs.where(~concerned), docs.where(concerned)
    kept = docs.join(out, F.col("doc_id").eqNullSafe(F.col(f"{own}id")) & (text_hash == F.col(f"{own}hash")), "left_anti")
    if repeated.isEmpty():
        return untouched.unionByName(kept)
    same = F.col("doc_id").eqNullSafe(F.col(f"{own}id")) & (text_hash == F.col(f"{own}hash"))
    once = kept.join(repeated, same, "left_semi").withColumn(f"{own}hash", text_hash).dropDuplicates(["doc_id", f"{own}hash"])
    once = once.drop(f"{own}hash")
    return untouched.unionByName(kept.join(repeated, same, "left_anti")).unionByName(once)
