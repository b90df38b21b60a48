"""What the pipeline's stages keep off the driver."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from farebox.llm import decontaminate, langid
from farebox.llm.common import SLICE_BYTES, text_buffer, word_hashes, words_of


def test_training_sample_is_hashed_in_slices(monkeypatch):
    texts = ["", "one", None, "a b  cé " * 9000, "  ", "two words " * 20_000, "x" * 30, "y z " * 200_000, ""] * 2
    data, offsets = text_buffer(pa.array(texts, pa.string()))
    starts, ends, per_doc = words_of(data, offsets)
    whole = word_hashes(data, starts, ends)
    sizes = []
    monkeypatch.setattr(langid, "word_hashes", lambda d, a, b: (sizes.append(len(d)), word_hashes(d, a, b))[1])
    assert np.array_equal(langid.sample_hashes(data, offsets, starts, ends, per_doc), whole)
    assert len(data) > SLICE_BYTES >= max(sizes)
    none = np.zeros(0, np.int64)
    assert len(langid.sample_hashes(data[:0], np.zeros(1, np.int64), none, none, none)) == 0
    sizes.clear()
    langid.train([f"{'word ' * 3000}{i}" for i in range(120)], ["en", "de"] * 60, epochs=1)
    assert max(sizes) <= SLICE_BYTES < sum(sizes)


def test_filed_values_of_two_hundred_items_are_not_broadcast(spark, monkeypatch):
    """They took 52 MB of the driver, and again of each executor."""
    plans = {}

    def kept(df, what):
        plans[what] = df._jdf.queryExecution().executedPlan().toString()
        return df

    items = [(i, " ".join(f"w{i}x{j}" for j in range(12))) for i in range(200)]
    docs = spark.createDataFrame([(1, items[3][1]), (2, "nothing of it")], "doc_id long, text string")
    monkeypatch.setattr(decontaminate, "written", kept)
    decontaminate.matches(docs, spark.createDataFrame(items, "item_id long, text string"))
    # the filing join is the only one with the fingerprints' distance
    join = next(line for line in plans["pairs"].split("\n") if "Join" in line and "bit_count" in line)
    assert "SortMergeJoin" in join
