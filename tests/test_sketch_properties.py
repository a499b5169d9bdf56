"""Property tests of the per-task sketch function (no Spark): any stream, any batching,
any K and memory budget -> the Misra-Gries bound holds."""

from collections import Counter

import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from trendlens.operators.misra_gries import _partition_sketch

words = st.lists(st.sampled_from([f"w{i}" for i in range(12)] + [None]), min_size=0, max_size=300)


@settings(max_examples=200, deadline=None)
@given(stream=words, k=st.integers(1, 6), budget=st.integers(1, 20), cuts=st.lists(st.integers(0, 300), max_size=6))
def test_sketch_function_bound(stream, k, budget, cuts):
    bounds = sorted({0, len(stream), *[c for c in cuts if c <= len(stream)]})
    batches = [
        pa.RecordBatch.from_arrays([pa.array(stream[lo:hi], pa.string())], names=["keyword"])
        for lo, hi in zip(bounds, bounds[1:])
    ]
    out = list(_partition_sketch(k, budget)(iter(batches)))
    got = {}
    for b in out:
        got.update(zip(b.column(0).to_pylist(), b.column(1).to_pylist()))
    true = Counter(w for w in stream if w is not None)
    n = sum(true.values())
    assert len(got) <= k
    for w, c in got.items():
        assert 0 < c <= true[w]
    for w, c in true.items():
        assert c - got.get(w, 0) <= n / (k + 1) + 1e-9
