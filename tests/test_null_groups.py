from __future__ import annotations

from decimal import Decimal

import pytest

from gridloom.operators import quality


@pytest.mark.parametrize("exact", [True, False])
def test_rows_of_a_null_key_are_judged(spark, exact):
    data = [(None, "a", Decimal(10 + k % 3)) for k in range(40)] + [(None, "a", Decimal(500)), ("m", None, Decimal(7))]
    df = spark.createDataFrame(data, "m string, n string, v decimal(12,4)")
    bounds = {r.m: r for r in quality.outlier_bounds(df, ["m", "n"], "v", exact=exact).collect()}
    assert set(bounds) == {None, "m"} and bounds[None].q1 == 10 and bounds["m"].q3 == 7
    found = quality.flag_outliers(df, ["m", "n"], "v", exact=exact).collect()
    assert [(r.m, r.v) for r in found] == [(None, Decimal(500))]
