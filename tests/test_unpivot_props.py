"""Property test: the Spark unpivot equals a NumPy brute force on random slab sets."""

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from gridspark.operators.unpivot import to_long_indexed
from gridspark.schema import SLAB_SCHEMA


@st.composite
def grids(draw):
    files = draw(st.integers(1, 3))
    out = []
    for f in range(files):
        r, y, x = draw(st.integers(1, 3)), draw(st.integers(1, 4)), draw(st.integers(1, 5))
        seed = draw(st.integers(0, 1000))
        vals = np.random.default_rng(seed).normal(0, 1e4, size=(r, y, x)).astype(np.float32)
        out.append((f"f{f}.nc", vals, draw(st.integers(0, 2**40)), draw(st.integers(0, 2**40))))
    return out


@settings(max_examples=12, deadline=None)
@given(grids())
def test_unpivot_matches_brute_force(spark, g):
    rows, expected = [], []
    for name, vals, t, fc in g:
        r_n, y_n, x_n = vals.shape
        xc = [float(np.float32(i * 0.25)) for i in range(x_n)]
        for r in range(r_n):
            for y in range(y_n):
                rows.append((name, "m", r, 0, y, y_n, float(np.float32(y * 1.5)), xc, t, fc, [float(v) for v in vals[r, y]]))
                for x in range(x_n):
                    expected.append((name, (r * y_n + y) * x_n + x, np.float32(vals[r, y, x]), float(t), float(fc)))
    df = to_long_indexed(spark.createDataFrame(rows, SLAB_SCHEMA))
    got = [(r["file_name"], r["cnt"], np.float32(r["measure_value"]), r["time"], r["forecast"]) for r in df.collect()]
    assert sorted(got) == sorted(expected)
