"""What a worker holds while it hashes texts does not grow with the Arrow batch."""

import tracemalloc

import numpy as np
import pyarrow as pa

from stratus.llm.neardup import _signer


def test_signing_many_short_texts_takes_little_memory():
    words = np.random.default_rng(5).integers(0, 1 << 40, 90_000)
    texts = [" ".join(map(str, words[i: i + 30])) for i in range(0, len(words), 30)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts)], ["doc_id", "text"])
    tracemalloc.start()
    rows = sum(out.num_rows for out in _signer(5, 25, 5)(iter([batch])))
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert rows == len(texts) and batch.nbytes > 1_000_000
    assert peak < 40e6
