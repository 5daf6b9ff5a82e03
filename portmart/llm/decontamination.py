"""Benchmark decontamination: short test items inside long documents.

Size-partitioned MinHash containment search.  Documents are partitioned by
the size of their shingle set, in classes that double; a class of up to u
shingles is sketched by one-permutation MinHash with ``8 u`` bins (the least
hash of each bin), so however long the document, a shingle shared with an
item is in the sketch with probability 0.94 or more.  Items are sketched for
every class at once: with bins cut by leading bits, a shingle that is the
least of its bin stays so in all finer classes, so one number per shingle
says from which class on it belongs to the sketch.  A shared sketch entry
makes a candidate pair, and exact shingle containment verifies it.  Items of
at most ``SHORT`` shingles, which a sketch could miss, are looked up among all
shingles of the documents, so they are found without loss.

An item is found when ``threshold`` of its distinct 5-word shingles stand
anywhere in the document, case ignored.

Defined results: a null or empty text or item has no shingles and matches
nothing; a text of fewer than 5 words is one shingle; repeated document rows
are each judged; every text under a repeated or null item id is searched for by
itself, and the one of greatest containment stands for the id in the result;
null ids are carried; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from portmart.llm.common import materialize, own_prefix, shingle_hashes, text_of, words

THRESHOLD = 0.75
BIN_BITS = 3  # 8 bins for each shingle of the class bound
SHORT = 4  # items of so few shingles are looked up among all shingles

# An index entry is 36 bytes of fixed width; beyond this size it is joined by shuffling.
INDEX_ENTRY_BYTES = 36
BROADCAST_BYTES = 64 * 1024 * 1024


def shingled(rows: DataFrame, keys: list[Column], text_col: str = "text") -> DataFrame:
    """``keys`` plus ``h``, the sorted distinct shingle hashes."""
    d = rows.select(*keys, words(F.lower(text_of(text_col))).alias("w"))
    names = [c for c in d.columns if c != "w"]
    return d.where(F.size("w") > 0).select(*names, shingle_hashes(F.col("w")).alias("h"))


def row_key(text_col: str = "text") -> list[Column]:
    return [F.col("doc_id"), F.xxhash64(text_of(text_col)).alias("text_hash")]


def item_index(items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The shingle sets of the distinct (id, text) rows, and their sketch
    entries for all classes: ``h, item_id, item_hash, from_bits`` where
    ``from_bits`` is the number of leading bits from which on the shingle is
    the least of its bin; -1 for short items, which need no sketch."""
    sets = shingled(items, [F.col("item_id"), F.xxhash64(text_of("text")).alias("item_hash")])
    sets = materialize(sets.dropDuplicates(["item_id", "item_hash"]), "item-sets")
    h = F.col("h")
    from_bits = F.transform(
        h,
        lambda x, i: F.struct(
            x.alias("h"),
            F.when(F.size(h) <= SHORT, F.lit(-1))
            .when(i == 0, F.lit(0))
            .otherwise(65 - F.length(F.bin(x.bitwiseXOR(F.get(h, i - 1)))))
            .alias("from_bits"),
        ),
    )
    entries = sets.select("item_id", "item_hash", F.inline(from_bits))
    return sets, materialize(entries, "item-index")


def sketch(docs: DataFrame) -> DataFrame:
    """``doc_id, text_hash, bits, h``: one row per shingle; ``bits`` is -1 for
    those outside the sketch, which only short items are looked up in."""
    h = F.col("h")
    size_class = F.length(F.bin(F.size(h).cast("bigint") - 1))
    d = shingled(docs, row_key()).withColumn("bits", size_class + BIN_BITS)
    entries = F.transform(
        h,
        lambda x, i: F.struct(
            F.when(
                (i == 0)
                | (F.call_function("shiftrightunsigned", x.bitwiseXOR(F.get(h, i - 1)), 64 - F.col("bits")) != 0),
                F.col("bits"),
            )
            .otherwise(F.lit(-1))
            .alias("bits"),
            x.alias("h"),
        ),
    )
    return d.select("doc_id", "text_hash", F.inline(entries))


def candidates(docs: DataFrame, index: DataFrame, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Pairs of documents and items that share a sketch entry, or, for short
    items, a shingle."""
    side = index.withColumnRenamed("h", "ih")
    if index.count() * INDEX_ENTRY_BYTES <= broadcast_bytes:
        side = F.broadcast(side)
    s = sketch(docs)
    hit = s.join(side, (s["h"] == side["ih"]) & (s["bits"] >= side["from_bits"]))
    return hit.select("doc_id", "text_hash", "item_id", "item_hash").distinct()


def search(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Verified pairs: ``doc_id, text_hash, item_id, item_shingles, shared,
    containment``; one row per item found in a distinct (id, text) row."""
    sets, index = item_index(items)
    pairs = materialize(candidates(docs, index), "decon-candidates")
    c = pairs.select(F.col("doc_id").alias("c_id"), F.col("text_hash").alias("c_hash"), "item_id", "item_hash")
    wanted = c.select("c_id", "c_hash").distinct()
    keyed = docs.select(*row_key(), F.col("text"))
    found = keyed.join(
        wanted, keyed["doc_id"].eqNullSafe(wanted["c_id"]) & (keyed["text_hash"] == wanted["c_hash"])
    ).dropDuplicates(["doc_id", "text_hash"])
    doc_sets = shingled(found, [F.col("doc_id"), F.col("text_hash")]).withColumnRenamed("h", "doc_h")
    j = doc_sets.join(c, doc_sets["doc_id"].eqNullSafe(c["c_id"]) & (doc_sets["text_hash"] == c["c_hash"]))
    s = sets.select(F.col("item_id").alias("s_id"), F.col("item_hash").alias("s_hash"), F.col("h").alias("item_h"))
    j = j.join(s, j["item_id"].eqNullSafe(s["s_id"]) & (j["item_hash"] == s["s_hash"]))
    j = j.select(
        "doc_id",
        "text_hash",
        "item_id",
        F.size("item_h").cast("long").alias("item_shingles"),
        F.size(F.array_intersect("doc_h", "item_h")).cast("long").alias("shared"),
    )
    j = j.where(F.col("shared") >= F.lit(threshold) * F.col("item_shingles"))
    best = F.max(F.struct((F.col("shared") / F.col("item_shingles")).alias("containment"), "item_shingles", "shared"))
    j = j.groupBy("doc_id", "text_hash", "item_id").agg(best.alias("best"))
    return j.select("doc_id", "text_hash", "item_id", "best.item_shingles", "best.shared", "best.containment")


def drop_contaminated(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents in which no item is found, all their columns kept."""
    own = own_prefix(docs)
    found = search(docs, items, threshold)
    bad = found.select(F.col("doc_id").alias(f"{own}id"), F.col("text_hash").alias(f"{own}hash"))
    bad = materialize(bad.distinct(), "decon-hits")
    return docs.join(
        bad,
        F.col("doc_id").eqNullSafe(F.col(f"{own}id")) & (F.xxhash64(text_of("text")) == F.col(f"{own}hash")),
        "left_anti",
    )
