"""Pairwise moments against pandas and NumPy."""

import numpy as np
import pandas as pd
import pytest

from episcope.operators import aggregates as A
from episcope.operators import moments as M


def test_states_merge_to_the_state_of_all_rows():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(200, 5)) * [1, 10, 1e-3, 1, 1] + [0, 1e6, 5, 0, 7]
    x[rng.random((200, 5)) < 0.3] = np.nan
    x[:, 3] = np.nan
    x[:, 4] = 7.0
    want = M.of_rows(x)
    for cuts in ([], [50], [1, 2, 3, 199], [0, 0, 200]):
        state = M.empty(5)
        for part in np.split(x, cuts):
            state = M.merged(state, M.of_rows(part))
        assert np.allclose(state, want, rtol=1e-9, atol=1e-9)
    both = ~np.isnan(x[:, 0]) & ~np.isnan(x[:, 1])
    assert want[0, 0, 1] == both.sum() and want[5, 0, 1] == pytest.approx(np.cov(x[both, 0], x[both, 1], bias=True)[0, 1] * both.sum())


@pytest.mark.parametrize("parts", [1, 7])
def test_correlations_equal_pandas(spark, parts):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(300, 4))
    x[:, 1] += x[:, 0]
    x[:, 2] = x[:, 2] * 1e-3 + 1e6
    frame = pd.DataFrame(x, columns=list("abcd"))
    frame["const"] = 3.3
    frame["gap"] = np.where(rng.random(300) < 0.5, np.nan, x[:, 0] * 2 + 1)
    frame["none"] = np.nan
    frame["tied"] = np.where(np.isnan(frame["gap"]), rng.normal(size=300), 5.0)      # constant where gap is present
    rows = [tuple(None if i % 3 == 0 and isinstance(v, float) and np.isnan(v) else float(v) for v in r) for i, r in enumerate(frame.itertuples(index=False))]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in frame.columns)).repartition(parts)
    got = A.correlation_matrix(df, list(frame.columns))
    want = frame.corr(min_periods=1)
    out = got.collect()
    assert len(out) == 8 * 7 // 2
    for r in out:
        w = want.loc[r.a, r.b]
        if {r.a, r.b} & {"const", "none"} or {r.a, r.b} == {"gap", "tied"}:
            assert r.r is None, r
        else:
            assert r.r == pytest.approx(w, abs=1e-6), r
    plan = got._jdf.queryExecution().toString()
    assert "Generate" not in plan and "explode" not in plan.lower()
    none = A.correlation_matrix(df.where("a > 1e9"), ["a", "b"]).collect()
    assert [(r.a, r.b, r.r) for r in none] == [("a", "b", None)]
