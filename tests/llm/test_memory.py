"""What a task holds beside its rows is bounded, whatever the words and texts are."""

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from lifeloom.llm import lattice


def peak(call):
    """(result, MB of numpy and Python memory at the peak of the call)."""
    tracemalloc.start()
    try:
        return call(), tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def test_words_of_all_lengths_are_encoded_in_bounded_blocks(spark):
    tree = lattice.piece_tree(lattice.piece_table(spark))
    words = [f" q{i:x}" for i in range(30_000)] + [" " + "z" * n for n in range(30, 90)]
    (ids, start, count), most = peak(lambda: lattice.encode_batch(pa.array(words), tree))
    assert most < 40
    # The same as each word alone.
    for i in (*range(0, 30_000, 997), *range(30_000, len(words))):
        alone = lattice.encode_batch(pa.array([words[i]]), tree)[0]
        assert np.array_equal(ids[start[i] : start[i] + count[i]], alone), words[i]


def test_texts_are_cut_in_bounded_parts(spark):
    cut = lattice.cuts(lattice.piece_table(spark))
    texts = [f"café {i}, \U0001f600 " * 60 for i in range(4000)] + [None, "", "x"]
    (words, sizes), most = peak(lambda: lattice.words_of(pa.array(texts), *cut))
    assert most < 30
    ends = np.concatenate(([0], np.cumsum(sizes)))
    assert len(words) == ends[-1] and sizes[-3:].tolist() == [0, 0, 1]
    for i, text in enumerate(texts):
        assert "".join(words[ends[i] : ends[i + 1]].to_pylist()) == (f" {text}" if text else "")


@pytest.mark.parametrize("stage", [f for _, f in corpus_pipeline.STAGES], ids=[n for n, _ in corpus_pipeline.STAGES])
def test_stages_bound_the_batches_of_python_workers(spark, monkeypatch, stage):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    spark.conf.unset(key)
    seen = []

    def built(*_):
        texts = spark.range(0, 4000, 1, 1).selectExpr("repeat('some words ', 400) text")
        sizes = texts.mapInArrow(lambda batches: (pa.RecordBatch.from_arrays([pa.array([b.nbytes])], ["n"]) for b in batches), "n long")
        seen.extend(r.n for r in sizes.collect())

    for module, name in (("quality", "keep_good"), ("simhash", "keep_one"), ("decontaminate", "clean"), ("secrets", "redacted"), ("lattice", "report")):
        monkeypatch.setattr(getattr(corpus_pipeline, module), name, built)
    monkeypatch.setattr(corpus_pipeline, "table", lambda *_: None)
    try:
        stage(spark, None, "")
    finally:
        spark.conf.unset(key)
    assert len(seen) > 1 and max(seen) < 5e6
