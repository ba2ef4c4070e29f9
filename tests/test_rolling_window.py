import datetime as dt

import pytest

from claimscope.operators.features import rolling_window, window_bounds

D = dt.date
# Golden windows (year crossing, leap February, 1+1 months).
CASES = [
    (D(2026, 10, 1), 6, 3, D(2026, 2, 1), D(2026, 7, 31), D(2026, 8, 1), D(2026, 10, 31)),
    (D(2026, 2, 1), 6, 3, D(2025, 6, 1), D(2025, 11, 30), D(2025, 12, 1), D(2026, 2, 28)),
    (D(2024, 2, 1), 1, 1, D(2024, 1, 1), D(2024, 1, 31), D(2024, 2, 1), D(2024, 2, 29)),
]


@pytest.mark.parametrize("month,tr,te,a,b,c,d", CASES)
def test_window_bounds(month, tr, te, a, b, c, d):
    assert window_bounds(month, tr, te) == {"train_start": a, "train_end": b, "test_start": c, "test_end": d}


def test_rolling_window_columnwise(spark):
    df = spark.createDataFrame([(c[0],) for c in CASES], "current_data_month date")
    got = {r["current_data_month"]: r for r in rolling_window(df, 6, 3).collect()}
    for month, tr, te, a, b, c, d in CASES:
        if (tr, te) != (6, 3):
            continue
        r = got[month]
        assert (r.train_start, r.train_end, r.test_start, r.test_end) == (a, b, c, d)
    one = rolling_window(spark.createDataFrame([(D(2024, 2, 10),)], "current_data_month date"), 1, 1).first()
    assert (one.train_start, one.train_end, one.test_start, one.test_end) == CASES[2][3:]


def test_invalid_window():
    with pytest.raises(ValueError):
        window_bounds(D(2026, 1, 1), 0, 3)
