"""Nearest neighbours where rows repeat: copies are neither neighbours of their own id nor a reason to visit less."""

import numpy as np
import pytest

from evalspark.llm import nearest


@pytest.mark.parametrize("copies", [1, 12, 40])
def test_repeated_rows(spark, copies):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(200, 16))
    rows = [(i, v.tolist()) for i, v in enumerate(x)] * copies
    got = nearest.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), "vec_id % 50 = 0", 5).collect()
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    assert len(got) == 20 and {r.query_id for r in got} == {0, 50, 100, 150}
    near = {q: {int(j) for j in np.argsort(-(unit @ unit[q]))[1:6]} for q in (0, 50, 100, 150)}
    assert all(r.vec_id != r.query_id for r in got)
    assert sum(r.vec_id in near[r.query_id] for r in got) >= 18


def test_fewer_ids_than_wanted(spark):
    rows = [(i, [float(i + 1), 1.0]) for i in range(4)] * 30
    got = nearest.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), "vec_id = 0", 5).collect()
    assert sorted(r.vec_id for r in got) == [1, 2, 3]
