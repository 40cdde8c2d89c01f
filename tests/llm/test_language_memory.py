"""Training holds its sample as it came, not spread out over all hashed n-grams."""

import tracemalloc

import numpy as np

from tidemark.llm import language


def test_training_holds_a_batch_at_a_time():
    draw = np.random.default_rng(3)
    width = len(language.ORDERS) << language.BITS
    counts = [(np.sort(draw.choice(width, 50, replace=False)), draw.integers(1, 9, 50)) for _ in range(2000)]
    tracemalloc.start()
    try:
        model = language.fit(counts, ["a" if i % 2 else "b" for i in range(2000)], epochs=1)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert model.languages == ["a", "b"] and model.table.shape == (width, 2)
    assert peak < 40e6  # the sample spread out would be 98 MB
