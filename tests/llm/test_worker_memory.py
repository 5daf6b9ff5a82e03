"""A Python worker holds little beside the batch of texts it was given."""

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from portmart.llm import language_id, ngram_join, tokens

LINE = "the quick brown fox jumps over the lazy dog and runs away again "
N_ROWS, N_WORDS = 6000, 260


def _batch(first: int) -> pa.RecordBatch:
    words = LINE.split()
    texts = [" ".join(words[(i * 7 + k * k) % len(words)] for k in range(N_WORDS)) for i in range(40)]
    rows = [texts[i % 40] for i in range(N_ROWS)]
    return pa.RecordBatch.from_arrays([pa.array(range(first, first + N_ROWS)), pa.array(rows)], ["doc_id", "text"])


class _Docs:
    """Hands back the function that would run in the tasks."""

    columns = ("doc_id", "text")
    schema = None

    def mapInArrow(self, run, schema):  # noqa: N802
        return run


@pytest.fixture
def keep(monkeypatch):
    log_p = np.log(np.full((2, 1 << language_id.BUCKET_BITS), 0.5))
    monkeypatch.setattr(language_id, "fit", lambda docs: language_id.Model(["a", "b"], log_p))
    monkeypatch.setattr(language_id, "ROUNDS", 1)
    return language_id.keep_identified(_Docs())


def test_identification_makes_no_objects_of_a_whole_batch(keep):
    batch = _batch(0)
    tracemalloc.start()
    ids = [i for out in keep(iter([batch])) for i in out.column(0).to_pylist()]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert ids == list(range(N_ROWS))
    assert peak < 30e6


def test_a_batch_is_let_go_before_the_next_is_read():
    held = []

    def batches():
        for k in range(2):
            batch = _batch(k * N_ROWS)
            size = batch.nbytes
            yield batch
            del batch
            held.append(pa.total_allocated_bytes() / size)

    before = pa.total_allocated_bytes() / _batch(0).nbytes
    ids = []
    for piece in tokens.slices(batches()):
        ids += piece.column(0).to_pylist()
    assert ids == list(range(2 * N_ROWS))
    assert max(held) - before < 0.5


def test_shingles_of_many_texts_take_little_memory():
    texts = [t.encode() for t in _batch(0).column(1).to_pylist()[:1000]]
    tokens._powers.clear()
    tracemalloc.start()
    sizes = [len(s) for s in ngram_join.shingle_sets(texts)]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(sizes) == 1000 and min(sizes) > 0
    assert peak < 30e6


def test_powers_grow_as_texts_do():
    tokens._powers.clear()
    few = tokens.powers(3, 10)
    many = tokens.powers(3, len(few) + 1)
    assert len(few) == tokens.POWERS_STEP and len(many) == 2 * tokens.POWERS_STEP
    assert many[len(few)] == np.uint64(pow(3, len(few), 1 << 64)) and (many[: len(few)] == few).all()
