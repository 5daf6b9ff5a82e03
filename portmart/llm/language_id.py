"""Language identification as mixture inference.

Every language is a distribution over hashed character trigrams, counted from
labelled training documents.  A document is a bag of words, each written in
one language; expectation-maximisation estimates the share of every language
from the words' trigram likelihoods.  The set of languages is chosen by
penalised likelihood: the sets considered grow by falling share, and a
further language has to raise the log-likelihood by more than its penalty.
The prediction is the language with the largest share, the score that share.

The model is fitted on a bounded sample, ``TRAIN_DOCS`` documents of each
language, drawn by a hash of id and text among the rows that are not held
out; whole texts are read, in training and in prediction.

Defined results: a text that is null or has no letter is ``und`` with score
0, and so is every text when nothing could be learnt (no labelled row); ties
go to the language first in code point order; null ids are held out;
repeated rows are predicted alike; an empty table gives an empty result;
other columns are ignored by ``identify`` and kept by ``keep_identified``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portmart.llm import tokens
from portmart.llm.common import held_out

TRAIN_DOCS = 4000
BUCKET_BITS = 16
SMOOTHING = 0.05
ROUNDS = 12
PENALTY = 4.0
PIECE_CHARS = 1 << 20
# Characters of whole texts judged at a time.
CHUNK_CHARS = 1 << 18

_letters: list[np.ndarray] = []


def is_letter() -> np.ndarray:
    """Truth per code point, built once per process."""
    if not _letters:
        _letters.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _letters[0]


def trigrams(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of lower-case ``text``: the bucket of the trigram around each letter
    (anything else counts as a word border), the index among them at which
    each word starts, and the words' code point positions."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    inside = is_letter()[points]
    c = np.zeros(len(points) + 2, np.uint32)
    c[1:-1] = np.where(inside, points, 0)
    at = np.flatnonzero(inside)
    mixed = c[at] * np.uint32(0x9E3779B1) + c[at + 1] * np.uint32(0x85EBCA6B) + c[at + 2] * np.uint32(0xC2B2AE35)
    mixed ^= mixed >> np.uint32(15)
    mixed *= np.uint32(0x2C1B3C6D)
    first = np.flatnonzero(c[at] == 0)
    return mixed >> np.uint32(32 - BUCKET_BITS), first, at[first]


def pieces(texts: list[str]) -> Iterator[tuple[str, int]]:
    """The texts, one per line, in pieces that end between words where they
    can, each with its offset."""
    whole = "\n".join(texts)
    start = 0
    while start < len(whole):
        end = start + PIECE_CHARS
        if end < len(whole):
            cut = max(whole.rfind(" ", start, end), whole.rfind("\n", start, end))
            end = cut + 1 if cut > start else end
        yield whole[start:end], start
        start = end


@dataclass(frozen=True)
class Model:
    languages: list[str]
    log_p: np.ndarray  # language x bucket

    def word_scores(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Log-likelihood of each word in each language, and its text."""
        ends = np.cumsum([len(t) + 1 for t in texts])
        scores, owner = [np.zeros((0, len(self.languages)))], [np.zeros(0, np.int64)]
        for piece, offset in pieces(texts):
            bucket, first, at = trigrams(piece)
            if len(first):
                scores.append(np.stack([np.add.reduceat(row[bucket], first) for row in self.log_p], axis=1))
                owner.append(np.searchsorted(ends, at + offset, side="right"))
        return np.concatenate(scores), np.concatenate(owner)

    def infer(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Share of every language per text, and whether it has any word."""
        n_texts, n_lang = len(texts), len(self.languages)
        shares = np.zeros((n_texts, n_lang))
        if not n_lang or not n_texts:
            return shares, np.zeros(n_texts, bool)
        scores, owner = self.word_scores([(t or "").lower() for t in texts])
        n_words = np.bincount(owner, minlength=n_texts)
        known = np.flatnonzero(n_words)
        if not len(known):
            return shares, n_words > 0
        top = scores.max(axis=1, keepdims=True)
        docs = _Docs(np.exp(scores - top), n_words[known])
        alone = np.add.reduceat(scores - top, docs.first, axis=0)
        best = alone.argmax(axis=1)
        chosen = np.eye(n_lang)[best]
        reached = alone.max(axis=1)
        everything, ll = docs.fit(np.ones((len(known), n_lang)))
        price = PENALTY * 0.5 * np.log(np.maximum(n_words[known], 2))
        order = np.argsort(-everything, axis=1, kind="stable")
        # A set can at most reach what all languages together reach.
        open_ = ll - reached > price
        for size in range(2, n_lang + 1):
            rows = np.flatnonzero(open_)
            if not len(rows):
                break
            allowed = np.zeros((len(rows), n_lang))
            np.put_along_axis(allowed, order[rows, :size], 1.0, axis=1)
            share, got = docs.only(rows).fit(allowed)
            better = got - reached[rows] > price[rows]
            chosen[rows[better]] = share[better]
            reached[rows[better]] = got[better]
            open_[rows] = better & (ll[rows] - got > price[rows])
        shares[known] = chosen
        return shares, n_words > 0

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        shares, known = self.infer(texts)
        if not self.languages:
            return ["und"] * len(texts), np.zeros(len(texts)), shares
        best = shares.argmax(axis=1)
        names = [self.languages[b] if k else "und" for b, k in zip(best, known, strict=True)]
        return names, np.where(known, shares.max(axis=1), 0.0), shares


@dataclass(frozen=True)
class _Docs:
    """Word likelihoods of several documents, one document after the other."""

    likelihood: np.ndarray
    n_words: np.ndarray

    @property
    def first(self) -> np.ndarray:
        return np.concatenate([[0], np.cumsum(self.n_words)[:-1]])

    def only(self, rows: np.ndarray) -> _Docs:
        keep = np.zeros(len(self.n_words), bool)
        keep[rows] = True
        return _Docs(self.likelihood[np.repeat(keep, self.n_words)], self.n_words[rows])

    def fit(self, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """EM over the allowed languages: shares and log-likelihood."""
        share = allowed / allowed.sum(axis=1, keepdims=True)
        owner, first = np.repeat(np.arange(len(self.n_words)), self.n_words), self.first
        for _ in range(ROUNDS):
            joint = self.likelihood * share[owner]
            joint /= np.maximum(joint.sum(axis=1, keepdims=True), 1e-300)
            share = np.add.reduceat(joint, first, axis=0) / self.n_words[:, None]
        total = np.maximum((self.likelihood * share[owner]).sum(axis=1), 1e-300)
        return share, np.add.reduceat(np.log(total), first)


def chunks(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``CHUNK_CHARS`` characters each."""
    start, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t or "")
        if size >= CHUNK_CHARS:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def count_trigrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``lang, bucket, n`` summed over one partition of ``lang, text``."""
    sums: dict[str, np.ndarray] = {}
    for batch in tokens.slices(batches):
        langs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for lang, text in zip(langs, texts, strict=True):
            mine = sums.setdefault(lang, np.zeros(1 << BUCKET_BITS, np.int64))
            for piece, _ in pieces([text.lower()]):
                mine += np.bincount(trigrams(piece)[0], minlength=1 << BUCKET_BITS)
    for lang, mine in sums.items():
        used = np.flatnonzero(mine)
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(used), pa.string()), pa.array(used), pa.array(mine[used])], ["lang", "bucket", "n"]
        )


def fit(docs: DataFrame, train_docs: int = TRAIN_DOCS) -> Model:
    """Learn from at most about ``train_docs`` documents of each language."""
    labelled = docs.where(~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    labelled = labelled.select("doc_id", F.col("lang").alias("lang"), "text")
    there = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not there:
        return Model([], np.zeros((0, 1 << BUCKET_BITS)))
    rate = F.lit(1.0)
    for lang, n in there.items():
        if n > train_docs:
            rate = F.when(F.col("lang") == lang, train_docs / n).otherwise(rate)
    draw = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1_000_000)) / 1e6
    sample = labelled.where(draw < rate).select("lang", "text")
    counted = sample.mapInArrow(count_trigrams, "lang string, bucket long, n long")
    # At most one row per language and bucket reaches the driver.
    rows = counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    languages = sorted(there)
    counts = np.zeros((len(languages), 1 << BUCKET_BITS))
    place = {lang: i for i, lang in enumerate(languages)}
    counts[rows["lang"].map(place).to_numpy(int), rows["bucket"].to_numpy(int)] = rows["n"].to_numpy()
    counts += SMOOTHING
    return Model(languages, np.log(counts / counts.sum(axis=1, keepdims=True)))


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` and, per language of the
    model, its share (``languages``, ``shares``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tokens.slices(batches):
            texts = batch.column(2).to_pylist()
            for a, b in chunks(texts):
                names, score, shares = model.predict(texts[a:b])
                present = [[model.languages[j] for j in np.flatnonzero(s)] for s in shares]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(a, b - a),
                        batch.column(1).slice(a, b - a),
                        pa.array(names, pa.string()),
                        pa.array(score, pa.float64()),
                        pa.array(present, pa.list_(pa.string())),
                        pa.array([s[s > 0].tolist() for s in shares], pa.list_(pa.float64())),
                    ],
                    ["doc_id", "held_out", "lang_pred", "score", "languages", "shares"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text").mapInArrow(
        run,
        f"doc_id {kind}, held_out boolean, lang_pred string, score double, languages array<string>, shares array<double>",
    )


def keep_identified(docs: DataFrame) -> DataFrame:
    """The documents, all columns kept, of which a language was identified,
    however many languages share their words; the others are rejected."""
    model = fit(docs)
    text_at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tokens.slices(batches):
            texts = batch.column(text_at).to_pylist()
            for a, b in chunks(texts):
                _, score, _ = model.predict(texts[a:b])
                yield batch.slice(a, b - a).filter(pa.array(score > 0))

    return docs.mapInArrow(run, docs.schema)
