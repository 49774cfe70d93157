"""Transitions, profiles, fits and distances on inputs whose answers were worked out by hand."""

import math

import numpy as np
import pytest

from eventweir.operators import distances as D
from eventweir.operators import fitting
from eventweir.operators import transitions as X

E = "us long, stream_id string, event_type string"


def events(spark, rows):
    return spark.createDataFrame([(int(t * 1e6), s, k) for t, s, k in rows], E)


@pytest.fixture(scope="module")
def small(spark):
    return events(spark, [(0, "s1", "A"), (1, "s1", "B"), (3, "s1", "C"), (0, "s2", "A"), (1.5, "s2", "B"), (4.5, "s2", "C"), (0, "s3", "A"), (9, "s3", "D")])


def test_transitions_and_profile(small):
    p = {(r["source"], r["target"]): (r["n"], r["probability"]) for r in X.transition_probs(small).collect()}
    assert p == {("A", "B"): (2, 0.666666667), ("A", "D"): (1, 0.333333333), ("B", "C"): (2, 1.0)}
    assert [tuple(r) for r in X.second_order_probs(small).collect()] == [("A", "B", "C", 2, 1.0)]
    assert X.delta_profile(small).first().asDict() == {"n": 5, "min_delta": 1.0, "p05": 1.1, "p50": 2.0, "p95": 7.8, "max_delta": 9.0, "mean_delta": 3.3}
    assert {r["length"]: r["n"] for r in X.sequence_length_hist(small).collect()} == {"2": 1, "3": 2}


def test_zero_gaps_are_dropped_not_bridged(spark):
    e = events(spark, [(0, "s", "A"), (0, "s", "B"), (1, "s", "C")])
    assert [(r["source"], r["target"]) for r in X.transition_probs(e).collect()] == [("B", "C")]
    assert X.second_order_probs(e).count() == 0
    assert X.delta_profile(e.limit(0)).first()["n"] == 0


def test_start_events_and_smoothing(small):
    assert {r["event_type"]: r["weight"] for r in X.start_events(small).collect()} == {"A": 3}
    w = {(r["source"], r["target"]): r["weight"] for r in X.smoothed_weights(X.transition_probs(small), 0.5).collect()}
    assert w[("B", "A")] == 0.5 and w[("A", "B")] == pytest.approx(1.166666667) and w[("B", "C")] == 1.0


def test_fit_edges():
    one = np.ones(2)
    assert fitting.best_fit(np.array([0.5, 0.7]), one, 5)["status"] == "insufficient_samples"
    got = fitting.best_fit(np.array([1.0]), np.array([5.0]), 5)
    assert (got["regime"], got["p1"], got["status"]) == ("deterministic_backoff", 1.0, "zero_variance_samples")


@pytest.mark.parametrize("name", ["exponential", "gamma", "lognormal", "weibull"])
def test_fit_recovers_the_family(name):
    r = np.random.default_rng(5)
    x = {"exponential": r.exponential(2.0, 6000), "gamma": r.gamma(4.0, 0.5, 6000), "lognormal": r.lognormal(0.3, 0.9, 6000), "weibull": 1.2 * r.weibull(2.5, 6000)}[name]
    got = fitting.best_fit(np.sort(x), np.ones(len(x)), 20)
    if name == "exponential":  # gamma and Weibull hold it too, with shape 1
        assert got["regime"] in ("exponential", "gamma", "weibull") and (got["regime"] == "exponential" or got["p1"] == pytest.approx(1.0, abs=0.05))
    else:
        assert got["regime"] == name
    want = {"gamma": (4.0, 0.5), "lognormal": (0.3, 0.9), "weibull": (2.5, 1.2)}.get(name)
    if want:
        assert (got["p1"], got["p2"]) == pytest.approx(want, rel=0.08)


def test_special_functions():
    assert fitting.digamma(1.0) == pytest.approx(-0.5772156649015329, abs=1e-10)
    assert fitting.trigamma(1.0) == pytest.approx(math.pi**2 / 6, abs=1e-9)
    assert fitting.lower_gamma(1.0, np.array([0.5, 3.0])) == pytest.approx(1 - np.exp([-0.5, -3.0]), abs=1e-12)


def test_back_off(small):
    got = {(r["source"], r["target"]): r["backoff_source"] for r in fitting.calibrate(small, 3).collect()}
    assert got[("A", "D")] == "event_type" and got[("A", "B")] == "event_type" and got[("B", "C")] == "domain"


def test_population_report(spark):
    rows = []
    for i in range(6):
        rows += [(10 * i, f"r{i}", "E5", "real"), (10 * i + 0.5, f"r{i}", "E11", "real"), (10 * i + 1.5, f"r{i}", "E21", "real")]
        rows += [(0, f"g{i}", "A", "generic"), (4, f"g{i}", "B", "generic"), (9, f"g{i}", "C", "generic")]
        rows += [(0, f"c{i}", "E5", "calibrated"), (0.5, f"c{i}", "E11", "calibrated"), (1.5, f"c{i}", "E21", "calibrated")]
    e = spark.createDataFrame([(int(t * 1e6), s, k, p) for t, s, k, p in rows], E + ", population string")
    got = {(r["metric"], r["comparison"]): r["value"] for r in D.comparison_report(e).collect()}
    assert got[("inter_event_time_ks", "generic_vs_real")] == 1.0 and got[("inter_event_time_wasserstein", "generic_vs_real")] == 3.75
    assert got[("event_type_frequency_l1", "generic_vs_real")] == 2.0 and got[("transition_frequency_l1", "generic_vs_real")] == 2.0
    assert all(v == 0 for (m, c), v in got.items() if c == "calibrated_vs_real") and got[("sequence_length_ks", "generic_vs_real")] == 0
    assert {r["population"]: r["burstiness"] for r in D.burstiness(e).collect()} == {"real": -0.5, "generic": -0.8, "calibrated": -0.5}
    assert all(r["repeated_ratio"] == 0 for r in D.repeated_ratio(e).collect())
    assert all(r["improved"] == (r["metric"].split("_")[0] != "sequence") for r in D.calibration_effect(D.comparison_report(e)).collect())


def test_empty_side_is_no_distance(spark):
    v = spark.createDataFrame([("a", 1.0)], "population string, x double")
    assert tuple(D.ks_wasserstein(v, "a", "b").first()) == (0.0, 0.0)
