"""What a worker and a batch hold at once."""

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from headway.llm import minhash, quality
from headway.session import ARROW_BATCH_KEY


def wide_batch(rows: int = 1200, words: int = 600) -> pa.RecordBatch:
    """Some 4 MB of text, no two words alike."""
    at = np.arange(rows * words).reshape(rows, words)
    texts = pa.array([" ".join(f"w{x}" for x in row) for row in at.tolist()], pa.string())
    ids = pa.array(range(rows), pa.int64())
    return pa.RecordBatch.from_arrays([ids, texts, pa.array([0] * rows, pa.int32())], ["doc_id", "text", "label"])


@pytest.mark.parametrize("work", [minhash.sketch_batches, minhash.set_batches, quality.counted_features])
def test_work_on_texts_takes_some_tens_of_mb(work):
    batch = wide_batch()
    assert batch.nbytes > 4e6
    assert sum(out.num_rows for out in work(iter([wide_batch(2)]))) == 2  # tables that stay are made
    tracemalloc.start()
    try:
        assert sum(out.num_rows for out in work(iter([batch]))) == batch.num_rows
        assert tracemalloc.get_traced_memory()[1] < 40e6
    finally:
        tracemalloc.stop()


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_pipeline_stages_bound_arrow_batches(name, stage, spark, sf_dir):
    text = "' a line that is not short, and then another one\n' || id"
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows]), pa.array([batch.nbytes])], ["rows", "bytes"])

    docs = spark.range(0, 4000, 1, 1).selectExpr(
        "id AS doc_id", f"concat(array_join(transform(sequence(1, 40), i -> {text} || '.' || i), ' ')) AS text",
        "'en' AS lang", "'s' AS source", "1L AS n_chars",
    )
    few = docs.limit(20)
    before = spark.conf.get(ARROW_BATCH_KEY, None)
    try:
        spark.conf.unset(ARROW_BATCH_KEY)
        stage(spark, few, sf_dir)
        found = docs.mapInArrow(sizes, "rows long, bytes long").collect()
        assert sum(r.rows for r in found) == 4000 and sum(r.bytes for r in found) > 8e6
        assert max(r.bytes for r in found) < 5e6
        spark.conf.set(ARROW_BATCH_KEY, "1m")
        stage(spark, few, sf_dir)
        assert spark.conf.get(ARROW_BATCH_KEY) == "1m"
    finally:
        spark.conf.unset(ARROW_BATCH_KEY)
        if before is not None:
            spark.conf.set(ARROW_BATCH_KEY, before)
