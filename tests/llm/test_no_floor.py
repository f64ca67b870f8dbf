"""The fit tells apart estimates and contexts of any size."""

import numpy as np

from siftline.llm import language_model as lm


def test_rare_words_of_large_corpora():
    p = 2.0 ** -np.arange(1, 63)
    bins = lm._bins(p)
    assert len(set(bins.tolist())) == len(p) and np.allclose(2.0 ** (-(bins - 1) / lm.STEPS), p)


def test_contexts_of_large_corpora():
    buckets = lm._bucket(2 ** np.arange(2, 62, dtype=np.int64))
    assert len(set(buckets.tolist())) == len(buckets) and buckets.max() < lm.BUCKETS
