import math

import numpy as np
import pytest

from basketlens.functions.special import chi2_tail, two_sided_p
from basketlens.operators import cox, survival as sv

FRAME = "segment_label string, duration int, event int"


def frame(spark, rows):
    return spark.createDataFrame([(g, int(d), int(e)) for g, d, e in rows], FRAME)


def curve(spark, rows):
    return [(r.duration, r.at_risk, round(r.survival, 6)) for r in
            sv.km_confidence(sv.km_curves(frame(spark, rows))).orderBy("duration").collect()]


def test_frame_counts_whole_days_and_is_strict(spark, shop, at):
    invoices, items = shop([
        ("1", 1, at(0, 0), [5]), ("2", 1, at(10, 0), [5]),
        ("3", 2, at(0, 1), [9]),                     # 47 hours before the snapshot of day 2 would be 1 day
        ("4", 3, at(9, 0), [1]), ("C5", 3, at(30), [-1]),
    ])
    customers = spark.createDataFrame([(1, "X"), (2, "Y"), (3, "X")], "customer_id bigint, country string")
    labels = spark.createDataFrame([(1, "A"), (2, "B"), (3, "B")], "customer_id bigint, segment_label string")
    lifecycle = sv.customer_lifecycle(invoices, items, customers)
    rows = {r.customer_id: r for r in sv.survival_frame(lifecycle, labels, 2, "X").collect()}
    # The snapshot is day 11, 00:00: cancellations do not move it.
    assert (rows[1].event, rows[1].duration, rows[1].is_uk) == (0, 11, 1)
    assert (rows[2].event, rows[2].duration, rows[2].is_uk) == (1, 0, 0)
    assert (rows[3].event, rows[3].duration, rows[3].monetary) == (0, 2, 1.0)
    assert rows[1].avg_order_value_signed_log == pytest.approx(math.log(6))
    strict = {r.customer_id: r.event for r in sv.survival_frame(lifecycle, labels, 10, "X").collect()}
    assert strict[2] == 0


def test_curve_with_censoring(spark):
    got = curve(spark, [("a", 3, 1), ("a", 5, 0), ("a", 5, 1), ("a", 8, 0)])
    assert got == [(0, 4, 1.0), (3, 4, 0.75), (5, 3, 0.5), (8, 1, 0.5)]


def test_deaths_on_day_zero_and_death_of_all(spark):
    assert curve(spark, [("a", 0, 1), ("a", 0, 1), ("a", 4, 1)]) == [(0, 3, round(1 / 3, 6)), (4, 1, 0.0)]
    assert curve(spark, [("a", 2, 0), ("a", 9, 0)]) == [(0, 2, 1.0), (2, 2, 1.0), (9, 1, 1.0)]


def test_median_and_bounds(spark):
    df = frame(spark, [("a", 1, 1), ("a", 2, 1), ("a", 3, 0), ("a", 4, 0), ("b", 5, 0), ("b", 6, 1)])
    curves = sv.km_curves(df)
    assert {r.segment_label: r.median_days for r in sv.km_median(curves).collect()} == {"a": 2, "b": 6}
    rows = {(r.segment_label, r.duration): r for r in sv.km_confidence(curves).collect()}
    assert (rows["a", 0].lower, rows["a", 0].upper) == (1.0, 1.0)
    se = math.sqrt(1 / 12) / abs(math.log(0.75))
    assert rows["a", 1].lower == pytest.approx(0.75 ** math.exp(1.959963984540054 * se))
    assert rows["a", 1].upper == pytest.approx(0.75 ** math.exp(-1.959963984540054 * se))
    assert rows["b", 6].survival == 0 and rows["b", 6].lower is None
    doc = {r.segment_label: r for r in sv.km_document(curves).collect()}
    assert doc["a"].n == 4 and doc["a"].days == [0, 1, 2, 3, 4] and doc["a"].survival == [1.0, 0.75, 0.5, 0.5, 0.5]


def brute_logrank(rows):
    names = sorted({g for g, _, _ in rows})
    z, v = np.zeros(len(names)), np.zeros((len(names),) * 2)
    for t in sorted({d for _, d, e in rows if e}):
        n_g = np.array([sum(g == k and d >= t for g, d, _ in rows) for k in names], float)
        d_g = np.array([sum(g == k and d == t and e for g, d, e in rows) for k in names], float)
        n, dead = n_g.sum(), d_g.sum()
        z += d_g - dead * n_g / n
        if n > 1:
            v += dead * (n - dead) / (n - 1) * (np.diag(n_g / n) - np.outer(n_g, n_g) / n ** 2)
    return z, v, z[:-1] @ np.linalg.pinv(v[:-1, :-1]) @ z[:-1]


def test_logrank_with_ties_across_groups_and_missing_times(spark):
    rng = np.random.default_rng(0)
    rows = [(g, int(rng.integers(0, 12)) + 3 * (g == "c"), int(rng.random() < 0.6)) for g in "abc" for _ in range(25)]
    z, v, statistic = brute_logrank(rows)
    table = sv.logrank(frame(spark, rows))
    got = table.orderBy("segment_label").collect()
    assert [r.observed - r.expected for r in got] == pytest.approx(list(z))
    assert np.array([r.covariance for r in got]) == pytest.approx(v)
    assert sum(r.observed for r in got) == pytest.approx(sum(r.expected for r in got))
    test = sv.logrank_test(table).first()
    assert test.statistic == pytest.approx(statistic) and test.degrees == 2
    assert test.p_value == pytest.approx(math.exp(-statistic / 2))
    single = sv.logrank_test(sv.logrank(frame(spark, [("a", 1, 1), ("a", 2, 0)]))).first()
    assert (single.statistic, single.degrees, single.p_value, single.differs) == (0.0, 0, 1.0, False)


def test_logrank_of_sixty_groups(spark):
    rng = np.random.default_rng(6)
    rows = [(f"g{i % 60:02d}", int(rng.integers(0, 9)), int(rng.random() < 0.7)) for i in range(400)]
    z, v, statistic = brute_logrank(rows)
    table = sv.logrank(frame(spark, rows))
    got = table.orderBy("segment_label").collect()
    assert [r.observed - r.expected for r in got] == pytest.approx(list(z))
    assert np.array([r.covariance for r in got]) == pytest.approx(v)
    test = sv.logrank_test(table).first()
    assert test.degrees == 59 and test.statistic == pytest.approx(statistic)


@pytest.mark.parametrize("degrees, point", [(1, 3.841459), (2, 5.991465), (3, 7.814728), (4, 9.487729), (9, 16.918978)])
def test_chi_square_five_percent_points(degrees, point):
    assert chi2_tail(point, degrees) == pytest.approx(0.05, abs=1e-7)


def test_normal_tail():
    assert two_sided_p(1.959963984540054) == pytest.approx(0.05)


def efron(x, duration, event, beta):
    """Log likelihood, gradient and information by the definition, death by death."""
    w = np.exp(x @ beta)
    p = x.shape[1]
    likelihood, gradient, information = 0.0, np.zeros(p), np.zeros((p, p))
    for t in np.unique(duration[event == 1]):
        risk, dead = duration >= t, (duration == t) & (event == 1)
        for l in range(dead.sum()):
            share = np.where(dead, 1 - l / dead.sum(), 1.0) * risk * w
            phi, phi1 = share.sum(), share @ x
            likelihood -= math.log(phi)
            gradient -= phi1 / phi
            information += (x.T * share) @ x / phi - np.outer(phi1, phi1) / phi ** 2
        likelihood += (x[dead] @ beta).sum()
        gradient += x[dead].sum(0)
    return likelihood, gradient, information


@pytest.fixture(scope="module")
def sample(spark):
    rng = np.random.default_rng(1)
    n = 240
    x = np.c_[rng.normal(2, 1, n), rng.integers(0, 2, n).astype(float)]
    duration = np.minimum(rng.exponential(6 * np.exp(-0.8 * (x[:, 0] - 2) + 0.5 * x[:, 1])), 9).astype(int)
    event = ((rng.random(n) < 0.8) & (duration < 9)).astype(int)
    rows = [(int(d), int(e), float(a), float(b)) for d, e, (a, b) in zip(duration, event, x)]
    return x, duration, event, spark.createDataFrame(rows, "duration int, event int, a double, b double").cache()


def test_step_sums_equal_the_definition_under_heavy_ties(sample, monkeypatch):
    x, duration, event, design = sample
    assert np.bincount(duration[event == 1]).max() > 20
    for piece in (cox.TIED_PIECE, 7):           # also when the tied deaths are cut into pieces
        monkeypatch.setattr(cox, "TIED_PIECE", piece)
        beta = np.array([0.3, -0.2])
        got = cox._unpack(cox.step_sums(design, ["a", "b"], beta).first(), 2)
        want = efron(x, duration, event, beta)
        assert got[0] == pytest.approx(want[0])
        assert got[1] == pytest.approx(want[1]) and got[2] == pytest.approx(want[2])


def test_fit_reaches_the_optimum_and_ignores_shifts(sample):
    x, duration, event, design = sample
    fit = cox.cox_fit(design)
    assert fit["converged"] and np.abs(fit["gradient"]).max() < 1e-6
    _, gradient, information = efron(x, duration, event, fit["coef"])
    assert np.abs(gradient).max() < 1e-6
    assert fit["covariance"] == pytest.approx(np.linalg.inv(information), rel=1e-6)
    shifted = cox.cox_fit(design.selectExpr("duration", "event", "a + 100 as a", "b - 3 as b"))
    assert shifted["coef"] == pytest.approx(fit["coef"], rel=1e-6)


def test_tied_deaths_are_dealt_out_before_they_are_summed(sample):
    plan = cox.step_sums(sample[3], ["a", "b"], [0.0, 0.0])._jdf.queryExecution().executedPlan().toString()
    lines = [line for line in plan.splitlines() if "Generate explode" in line or "Exchange hashpartitioning(duration" in line
             and "piece" in line]
    assert "Exchange" in lines[0] and "Generate" in lines[1] and str(cox.PIECE_PARTITIONS) in lines[0]


def test_divergent_fits_are_errors(spark):
    apart = [(d, 1, 0.0) for d in range(1, 15)] + [(30, 0, 1.0)] * 15
    with pytest.raises(ArithmeticError, match="'x'"):
        cox.cox_fit(spark.createDataFrame(apart, "duration int, event int, x double"))
    broken = [(1, 1, 0.5), (2, 0, float("nan")), (3, 1, 1.5)]
    with pytest.raises(ArithmeticError, match="not finite"):
        cox.cox_fit(spark.createDataFrame(broken, "duration int, event int, x double"))


def test_summary_of_extreme_coefficients_has_infinities(spark):
    fitted = spark.createDataFrame([("x", 900.0, 0.1, -1.0, True, 9)],
                                   "covariate string, coef double, se double, log_likelihood double, converged boolean, steps int")
    row = cox.cox_summary(fitted).first()
    assert row["exp(coef)"] == math.inf and row.converged and row.steps == 9


def test_summary_columns_and_arithmetic(spark, sample):
    summary = cox.cox_summary(cox.cox_ph(sample[3]))
    assert summary.columns[:4] == ["covariate", "coef", "exp(coef)", "se(coef)"]
    row = summary.filter("covariate = 'a'").first()
    assert row["exp(coef)"] == pytest.approx(math.exp(row.coef)) and row.z == pytest.approx(row.coef / row["se(coef)"])
    assert row["-log2(p)"] == pytest.approx(-math.log2(row.p))
    ratio = cox.cox_hazard_ratios(summary).filter("covariate = 'a'").first()
    assert ratio.hazard_ratio == pytest.approx(row["exp(coef)"], abs=5e-5)


def test_design_names_and_failures(spark):
    rows = [("Champions", 1, 1, 0.5, 1.0, 0), ("At Risk / Churned", 2, 0, 0.1, 2.0, 1), ("New / Occasional", 3, 1, 0.2, 2.0, 1)]
    df = spark.createDataFrame(rows, FRAME + ", log_frequency double, avg_order_value_signed_log double, is_uk int")
    design = cox.cox_design(df)
    assert design.columns[5:] == ["segment_At_Risk__Churned", "segment_New__Occasional"]
    with pytest.raises(ValueError, match="reference"):
        cox.cox_design(df.filter("segment_label <> 'Champions'"))
    with pytest.raises(ValueError, match="without variation"):
        cox.cox_fit(cox.cox_design(df.filter("segment_label <> 'New / Occasional'"), levels=[
            "Champions", "At Risk / Churned", "New / Occasional"]))
