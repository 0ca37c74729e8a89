import math

import pytest

from fixtures import AS_OF, by_key, interactions, offers, profile, rows_of
from offer_engine import config as C
from offer_engine.operators import attribution, dataset, features, ingest
from offer_engine.plans import campaign


def inputs(spark):
    events = ingest.flatten_interactions(interactions(spark))
    profiles = ingest.clean_profile(profile(spark), AS_OF)
    return events, profiles, ingest.per_offer(offers(spark))


def known(spark):
    events, profiles, _ = inputs(spark)
    return attribution.attribute_offers(events).join(
        profiles.select("account_id"), "account_id", "left_semi"
    )


def test_transaction_features(spark):
    got = by_key(features.transaction_features(known(spark)), "account_id")
    a1 = got[("a1",)]
    assert (a1.transaction_frequency, a1.total_spend, a1.avg_transaction_value) == (2, 30.0, 15.0)
    assert (a1.max_transaction, a1.min_transaction) == (20.5, 9.5)
    assert math.isclose(a1.transaction_value_std, math.sqrt(60.5))
    a2 = got[("a2",)]
    # Two transactions, one without an amount: no deviation from a single value.
    assert (a2.transaction_frequency, a2.transaction_value_std) == (2, None)
    a6 = got[("a6",)]
    assert (a6.total_spend, a6.avg_transaction_value, a6.max_transaction) == (0.0, None, None)


def test_offer_features_guard_zero_denominators(spark):
    got = by_key(features.offer_features(known(spark)), "account_id")
    a1 = got[("a1",)]
    assert (a1.offers_received_count, a1.offers_viewed_count, a1.offers_completed_count) == (2, 1, 1)
    assert (a1.view_rate, a1.completion_rate_after_view) == (0.5, 1.0)
    assert got[("a6",)].completion_rate_after_view == 0.0
    assert got[("a6",)].overall_completion_rate == 1.0


def test_reward_features(spark):
    got = by_key(features.reward_features(known(spark)), "account_id")
    assert got[("a1",)].total_rewards_earned == 10.0
    assert got[("a2",)].total_rewards_earned == 0.0
    assert got[("a2",)].avg_reward_per_completion is None


@pytest.mark.parametrize("week,first,second", [(168, 1, 1), (7, 0, 0), (400, 2, 0)])
def test_time_features(spark, week, first, second):
    got = by_key(features.time_features(known(spark), week), "account_id")
    a3 = got[("a3",)]
    assert (a3.transactions_first_week, a3.transactions_second_week) == (first, second)
    assert (a3.first_transaction_time, a3.last_transaction_time) == (168.0, 336.0)
    assert a3.customer_activity_span == 334.0
    assert got[("a6",)].last_transaction_time is None


def test_offer_type_features(spark):
    _, _, per_offer = inputs(spark)
    got = by_key(features.offer_type_features(known(spark), per_offer), "account_id")
    assert got[("a1",)].bogo_completion_rate == 1.0
    assert got[("a1",)].discount_completion_rate == 0.0
    assert got[("a2",)].informational_view_rate == 1.0
    # Only an offer nobody knows.
    assert ("a3",) not in got


def test_channel_features(spark):
    _, _, per_offer = inputs(spark)
    got = by_key(features.channel_features(known(spark), per_offer), "account_id")
    # web: received o1 and o2, completed o1.
    assert got[("a1",)].web_engagement == 0.5 and got[("a1",)].mobile_engagement == 1.0
    # Offers without channels do not count.
    assert ("a4",) not in got


def test_one_pass_equals_the_six_joined_sets(spark):
    events, profiles, per_offer = inputs(spark)
    rows = known(spark)
    joined = features.join_feature_sets(
        features.channel_features(rows, per_offer),
        features.offer_type_features(rows, per_offer),
        features.time_features(rows),
        features.reward_features(rows),
        features.transaction_features(rows),
        features.offer_features(rows),
    )
    one_pass = campaign.customer_features(events, profiles, per_offer)
    assert one_pass.columns == joined.columns

    def rounded(df):
        return [
            tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in rows_of(df)
        ]

    assert rounded(one_pass) == rounded(joined)


def test_equal_amounts_have_no_deviation(spark):
    rows = [(i, "a", "transaction", float(i), f"o{i % 3}", 0.1, None) for i in range(9)]
    rows.append((10, "a", "offer received", 0.0, "o1", None, None))
    events = spark.createDataFrame(
        rows, "event_id long, account_id string, event string, time_since_test_start double, "
        "offer_id string, amount double, reward double",
    )
    _, profiles, per_offer = inputs(spark)
    rollup = dataset.account_offer_rollup(events)
    everyone = events.select("account_id").distinct()
    row = features.customer_features(rollup, everyone, per_offer).first()
    assert abs(row.transaction_value_std) < 1e-9


def model_table(spark):
    events, profiles, _ = inputs(spark)
    return campaign.consolidated(events, profiles, ingest.explode_channels(offers(spark)))


def test_fill_features(spark):
    filled = features.fill_features(features.encode_gender(model_table(spark)))
    for row in filled.collect():
        assert all(row[c] is not None for c in C.FEATURES)
    unknown = filled.filter("account_id = 'a3'").first()
    assert unknown.offer_type == C.NO_OFFER_TYPE
    assert (unknown.credit_card_limit, unknown.registered_on_days) == (-1.0, -1)
    assert unknown.min_value == 0 and unknown.has_web == 0


def test_drop_rows_with_missing_features(spark):
    encoded = features.encode_gender(model_table(spark))
    accounts = {r.account_id for r in features.fill_features(encoded, on_null="drop").collect()}
    assert accounts == {"a1", "a2"}


def test_vector(spark):
    row = campaign.prepared(model_table(spark)).filter("offer_id = 'o2'").first()
    assert list(row.features.toArray()) == [float(row[c]) for c in C.FEATURES]
