"""Property test: the distributed block scan equals NumPy slicing for any block size."""

import os

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from gridspark.operators.unpivot import to_long_indexed
from gridspark.sources import gridfile as G
from gridspark.sources.ncwrite import grid_file_bytes

YN, XN = "projection_y_coordinate", "projection_x_coordinate"


@settings(max_examples=10, deadline=None)
@given(
    r=st.integers(1, 3), levels=st.sampled_from([0, 2]), y=st.integers(1, 9), x=st.integers(1, 6),
    line_blocks=st.integers(1, 10), limit=st.integers(-1, 4), version=st.sampled_from([1, 2, 5]),
    record=st.booleans(), seed=st.integers(0, 999),
)
def test_block_scan_equals_numpy(spark, tmp_path_factory, r, levels, y, x, line_blocks, limit, version, record, seed):
    rng = np.random.default_rng(seed)
    shape = (r, levels, y, x) if levels else (r, y, x)
    v = rng.normal(size=shape).astype(np.float32)
    d = tmp_path_factory.mktemp("scan")
    p = os.path.join(str(d), "g.nc")
    with open(p, "wb") as f:
        f.write(grid_file_bytes("m", v, np.arange(y) * 3.0, np.arange(x) * 7.0, 5, 4, version=version,
                                record_realization=record))
    files = spark.createDataFrame([(p,)], "path string")
    req = G.requests_for_files(files, "m", YN, XN, limit)
    out = G.scan_grid(req, block_bytes=line_blocks * x * 4, target_task_bytes=64)
    assert G.scan_rejects(out).count() == 0
    rows = to_long_indexed(G.good_slabs(out)).collect()
    flat = (v[:, 0] if levels else v)
    keep = r if limit < 0 else min(limit, r)
    expected = sorted((int(i), np.float32(val)) for i, val in enumerate(flat[:keep].reshape(-1)))
    got = sorted((row["cnt"], np.float32(row["measure_value"])) for row in rows)
    assert got == expected
    assert all(row["x_coord"] == row["x"] * 7.0 and row["y_coord"] == row["y"] * 3.0 for row in rows)
