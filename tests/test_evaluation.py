import math
import random

import pytest

from offer_engine.operators import evaluation, uplift


def scored(spark, pairs):
    return spark.createDataFrame(pairs, "total_spent double, prediction double")


def test_metrics(spark):
    row = evaluation.regression_metrics(scored(spark, [(1.0, 2.0), (2.0, 2.0), (4.0, 5.0)])).first()
    assert math.isclose(row.mae, 2 / 3) and math.isclose(row.rmse, math.sqrt(2 / 3))
    # Squared correlation, not 1 - SSE / SST: deviations -4/3, -1/3, 5/3 and -1, -1, 2.
    assert math.isclose(row.r2, 5.0**2 / ((42 / 9) * 6))
    assert math.isclose(row.r2_score, 1 - 2 / (42 / 9))


def test_metrics_of_perfect_prediction(spark):
    row = evaluation.regression_metrics(scored(spark, [(1.0, 1.0), (3.0, 3.0)])).first()
    assert (row.mae, row.rmse) == (0.0, 0.0)
    assert math.isclose(row.r2, 1.0) and math.isclose(row.r2_score, 1.0)


@pytest.mark.parametrize("pairs", [[(1.0, 5.0), (3.0, 5.0)], [(1.0, 2.0)], [(2.0, 1.0), (2.0, 3.0)]])
def test_undefined_correlation_is_zero(spark, pairs):
    assert evaluation.regression_metrics(scored(spark, pairs)).first().r2 == 0.0


def test_metrics_of_no_rows(spark):
    row = evaluation.regression_metrics(scored(spark, [])).first()
    assert row.mae is None and row.r2 == 0.0


def test_segment_metrics_equal_the_single_ones(spark):
    rows = [("x", 1.0, 2.0), ("x", 2.0, 5.0), ("y", 4.0, 4.0), ("y", 5.0, 7.0), ("y", 0.0, 1.0)]
    df = spark.createDataFrame(rows, "offer_type string, total_spent double, prediction double")
    for row in evaluation.segment_metrics(df).collect():
        alone = evaluation.regression_metrics(df.filter(df.offer_type == row.offer_type)).first()
        for name in ("mae", "rmse", "r2", "r2_score"):
            assert math.isclose(row[name], alone[name])


PREDICTIONS = (
    "account_id string, pred_bogo double, pred_discount double, pred_informational double, "
    "pred_no_offer double"
)


def test_recommendation_and_ties(spark):
    rows = [
        ("best", 1.0, 2.0, 9.0, 3.0),
        ("tie", 4.0, 4.0, 4.0, 4.0),
        ("none", 1.0, 1.0, 1.0, 2.0),
        ("null", None, 2.0, None, 1.0),
        ("all null", None, None, None, None),
    ]
    out = uplift.add_uplift(uplift.recommend_offer(spark.createDataFrame(rows, PREDICTIONS)))
    got = {r.account_id: (r.recommended_offer, r.t, r.uplift) for r in out.collect()}
    assert got == {
        "best": ("informational", 1, 6.0),
        "tie": ("bogo", 1, 0.0),
        "none": ("no_offer", 0, 0.0),
        "null": ("discount", 1, 1.0),
        "all null": ("no_offer", 0, None),
    }


def arms(spark, rows):
    return spark.createDataFrame(rows, "account_id string, y double, t int, uplift double")


def brute_curve(rows, n_bins=100):
    """The definition, over a plain list with distinct scores."""
    rows = sorted(rows, key=lambda r: -r[3])
    n = len(rows)
    n_t = sum(r[2] for r in rows) or 1
    n_c = sum(1 - r[2] for r in rows) or 1
    overall = sum(r[1] * r[2] for r in rows) / n_t - sum(r[1] * (1 - r[2]) for r in rows) / n_c
    width, curve = max(n // n_bins, 1), []
    y_t = y_c = k_t = k_c = 0
    for i, (_, y, t, _) in enumerate(rows, 1):
        y_t, y_c, k_t, k_c = y_t + y * t, y_c + y * (1 - t), k_t + t, k_c + 1 - t
        if i % width == 0:
            real = y_t - y_c * (k_t / k_c if k_c else 0.0)
            curve.append((i / n, real, i / n * n_t * overall))
    return curve


def check(spark, rows, n_bins=100):
    out = evaluation.qini_curve(arms(spark, rows), "y", "t", "uplift", "account_id", n_bins)
    got, expected = [tuple(r) for r in out.collect()], brute_curve(rows, n_bins)
    assert len(got) == len(expected)
    for a, b in zip(got, expected):
        assert all(math.isclose(x, y, rel_tol=1e-9, abs_tol=1e-9) for x, y in zip(a, b))
    area = evaluation.auuc(out).first()[0]
    gaps = [(f, r - m) for f, r, m in expected]
    manual = sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(gaps, gaps[1:]))
    assert math.isclose(area, manual, rel_tol=1e-9, abs_tol=1e-9)


def random_rows(n, treated, seed=1):
    random.seed(seed)
    scores = random.sample(range(10 * n), n)
    return [
        (f"a{i}", round(random.random() * 50, 2), int(random.random() < treated), float(scores[i]))
        for i in range(n)
    ]


@pytest.mark.parametrize("n,treated", [(50, 0.5), (1999, 0.3), (400, 0.0), (400, 1.0), (1, 1.0)])
def test_curve_equals_the_definition(spark, n, treated):
    check(spark, random_rows(n, treated))


def test_other_bin_counts(spark):
    check(spark, random_rows(777, 0.5), n_bins=7)


def test_curve_of_equal_scores_ends_at_the_totals(spark):
    rows = [(f"a{i}", float(i), i % 2, 0.0) for i in range(200)]
    last = evaluation.qini_curve(arms(spark, rows), "y", "t", "uplift", "account_id").collect()[-1]
    assert last.frac == 1.0 and math.isclose(last.qini_real, last.qini_random)


def test_empty_curve(spark):
    out = evaluation.qini_curve(arms(spark, []), "y", "t", "uplift", "account_id")
    assert out.count() == 0 and evaluation.auuc(out).first()[0] == 0.0


def test_last_running_sums_are_the_totals(spark):
    df = arms(spark, random_rows(300, 0.4))
    totals = evaluation.qini_totals(df, "y", "t").first()
    last = evaluation.qini_cumulative(df, "y", "t", "uplift", "account_id").filter("rank = 300").first()
    assert (last.y_treat_cum, last.y_ctrl_cum) == (totals.y_treat_total, totals.y_ctrl_total)
    assert (last.n_treat_cum, last.n_ctrl_cum) == (totals.n_treat_total, totals.n_ctrl_total)


def test_missing_arm_counts_as_one(spark):
    totals = evaluation.qini_totals(arms(spark, random_rows(5, 1.0)), "y", "t").first()
    assert (totals.n_treat_total, totals.n_ctrl_total, totals.y_ctrl_total) == (5, 1, 0.0)
