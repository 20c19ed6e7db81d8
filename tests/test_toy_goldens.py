"""FIXTURES F1: exact fractions on five toy journeys."""

import pytest
from pyspark.sql import functions as F

from creditpath.plans.attribution import AttributionPlan

EPS = 1e-12


def _by(df, key, val):
    return {r[key]: r[val] for r in df.collect()}


def test_touch_models(toy_touches):
    p = AttributionPlan(toy_touches)
    ft = _by(p.first_touch, "channel", "attribution_percent")
    lt = _by(p.last_touch, "channel", "attribution_percent")
    for shares in (ft, lt):
        assert set(shares) == {"Social", "Email", "Search"}
        for v in shares.values():
            assert v == pytest.approx(1 / 3, abs=EPS)


def test_matrix(toy_touches):
    p = AttributionPlan(toy_touches)
    m = {(r.start_state, r.end_state): r.transition_probability for r in p.matrix.collect()}
    assert m[("Start", "Social")] == pytest.approx(2 / 5)
    assert m[("Start", "Email")] == pytest.approx(2 / 5)
    assert m[("Start", "Search")] == pytest.approx(1 / 5)
    for e in ("Email", "Social", "Null", "Conversion"):
        assert m[("Social", e)] == pytest.approx(1 / 4)
    for e in ("Social", "Null", "Conversion"):
        assert m[("Email", e)] == pytest.approx(1 / 3)
    assert m[("Search", "Conversion")] == pytest.approx(1.0)
    sums = _by(p.row_sums, "start_state", "transition_probability_sum")
    assert all(v == 1.0 for v in sums.values())


@pytest.mark.parametrize(
    "policy,expected",
    [
        ("absorbing", {None: 3 / 5, "Email": 1 / 3, "Search": 2 / 5, "Social": 1 / 3}),
        ("simple_path", {None: 1 / 2, "Email": 3 / 10, "Search": 3 / 10, "Social": 1 / 3}),
        ("memo_walk", {None: 7 / 15, "Email": 3 / 10, "Search": 4 / 15, "Social": 1 / 3}),
    ],
)
def test_conversion_probability(toy_touches, policy, expected):
    p = AttributionPlan(toy_touches)
    got = _by(p.conversion_probability(policy), "removed_channel", "conversion_probability")
    assert set(got) == set(expected)
    for k, v in expected.items():
        assert got[k] == pytest.approx(v, abs=1e-12), (policy, k)


@pytest.mark.parametrize(
    "policy,effect,share",
    [
        ("absorbing", (4 / 9, 1 / 3, 4 / 9), (4 / 11, 3 / 11, 4 / 11)),
        ("simple_path", (2 / 5, 2 / 5, 1 / 3), (6 / 17, 6 / 17, 5 / 17)),
        ("memo_walk", (5 / 14, 3 / 7, 2 / 7), (1 / 3, 2 / 5, 4 / 15)),
    ],
)
def test_removal_effect_and_share(toy_touches, policy, effect, share):
    p = AttributionPlan(toy_touches)
    rows = {r.channel: r for r in p.removal_effect(policy).collect()}
    for ch, e, s in zip(("Email", "Search", "Social"), effect, share):
        assert rows[ch].removal_effect == pytest.approx(e, abs=1e-12)
        assert rows[ch].attribution_percent == pytest.approx(s, abs=1e-12)
    total = sum(r.attribution_percent for r in rows.values())
    assert total == pytest.approx(1.0)


def test_markov_rows_and_report(toy_touches):
    p = AttributionPlan(toy_touches)
    rows = p.markov_attribution().collect()
    assert {r.attribution_model for r in rows} == {"markov_chain"}
    pivot = p.attribution_pivot().orderBy("channel").collect()
    assert [r.channel for r in pivot] == ["Email", "Search", "Social"]
    assert all(r.first_touch is not None and r.markov_chain is not None for r in pivot)


def test_rounded_two_steps(toy_touches):
    """digits=2 rounds the effect first and the share after (banker's rounding)."""
    p = AttributionPlan(toy_touches, digits=2)
    rows = {r.channel: r for r in p.removal_effect("absorbing").collect()}
    assert rows["Email"].removal_effect == 0.44
    assert rows["Search"].removal_effect == 0.33
    assert rows["Email"].attribution_percent == round(0.44 / (0.44 + 0.33 + 0.44), 2)


def test_user_journey_rows(toy_touches):
    p = AttributionPlan(toy_touches)
    uj = {(r.uid, r.seq): r for r in p.user_journey.collect()}
    assert [uj["u1", k].channel for k in (1, 2)] == ["Social", "Email"] and uj["u1", 1].conversion == 1
    assert uj["u4", 2].first_interaction == "Email" and uj["u4", 2].last_interaction == "Social"
    assert [uj["u3", k].visit_order for k in (1, 2)] == [1, 2]
    pt = p.path_transitions.where("uid = 'u3'").collect()
    assert sorted(r.transition for r in pt) == ["Social > Null", "Social > Social", "Start > Social"]


def test_sql_views_and_function(spark, toy_touches):
    from creditpath.plans.attribution import register_views

    names = register_views(AttributionPlan(toy_touches), prefix="toy_")
    assert "toy_transition_matrix" in names
    pairs = spark.sql("SELECT transition_array('Start > Social > Email > Conversion') AS t").first().t
    assert sorted(pairs) == ["Email > Conversion", "Social > Email", "Start > Social"]
    assert spark.sql("SELECT transition_array('Start') AS t").first().t == []
    total = spark.sql("SELECT round(sum(transition_probability), 6) AS s FROM toy_transition_matrix "
                      "WHERE start_state = 'Start'").first().s
    assert total == 1.0
