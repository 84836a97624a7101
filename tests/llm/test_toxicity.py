"""What the driver holds of the rows that toxicity learns from."""

import random
import sys

import numpy as np

from aerowx.llm.toxicity import feature_key


def test_keys_sort_as_the_features_and_are_small():
    rng = random.Random(7)
    rows = [sorted(rng.sample(range(1 << 20), rng.randrange(0, 6))) for _ in range(300)]
    rows += [[1], [1, 2], [1, 256], [256], [255], [0], []]
    arrays = [np.array(r, np.int32) for r in rows]
    assert [tuple(a) for a in sorted(arrays, key=feature_key)] == sorted(tuple(r) for r in rows)
    assert sys.getsizeof(feature_key(np.arange(500, dtype=np.int32))) < 5 * 500
