"""Height images with short runs of filtered rows."""

import time

import numpy as np

from blockstrata import fixture_bytes as B
from blockstrata.sources import images as I


def test_short_runs_are_undone_alike_and_in_little_time():
    v = np.random.default_rng(5).integers(0, 65536, (60, 2500))
    for kinds in ((0, 1, 2, 3, 4), (3,), (4,), (1, 4, 3, 2)):
        data = B.png_bytes([r.astype(">u2").tobytes() for r in v], v.shape[1], 16, 0, 2, kinds)
        start = time.process_time()
        assert (I.png16_samples(data) == v).all()
        if kinds == (0, 1, 2, 3, 4):
            assert time.process_time() - start < 1.5


def test_long_runs_are_undone_alike():
    v = np.random.default_rng(6).integers(0, 65536, (300, 40))
    data = B.png_bytes([r.astype(">u2").tobytes() for r in v], v.shape[1], 16, 0, 2, (4, 3, 1))
    assert (I.png16_samples(data) == v).all()


def test_samples_come_in_strips():
    import pandas as pd
    v = np.random.default_rng(7).integers(0, 65536, (70, 2500))
    data = B.png_bytes([r.astype(">u2").tobytes() for r in v], v.shape[1], 16, 0, 2)
    parts = list(I._samples([pd.DataFrame({"path": ["/t/a.png"], "content": [data]})]))
    whole = pd.concat(parts)
    assert len(parts) > 1 and max(map(len, parts)) <= I.STRIP
    assert (whole.pivot(index="row", columns="col", values="v").to_numpy() == v).all() and set(whole["tile"]) == {"a"}
