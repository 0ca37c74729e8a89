import math
import random

from fixtures import AS_OF, by_key, interactions, offers, profile
from offer_engine.operators import attribution, dataset, ingest, reports


def inputs(spark):
    events = ingest.flatten_interactions(interactions(spark))
    return (
        events,
        attribution.attribute_offers(events),
        ingest.clean_profile(profile(spark), AS_OF),
        ingest.per_offer(offers(spark)),
        ingest.explode_channels(offers(spark)),
    )


def test_daily_activity_is_ordered_and_skips_null_times(spark):
    events, *_ = inputs(spark)
    rows = reports.daily_activity(events).collect()
    days = [r.day for r in rows]
    assert days == sorted(days) and None not in days
    assert {r.day: r.transactions for r in rows}[12] == 2
    assert {r.day: r.offers_received for r in rows}[7] == 1


def test_completions_count_once_per_channel(spark):
    events, _, _, per_offer, per_channel = inputs(spark)
    got = by_key(reports.completions_by_type_day(events, per_channel), "offer_type", "day")
    assert got["bogo", 12]["completions"] == 4 and got["bogo", 12]["total_rewards"] == 40.0
    assert got["discount", 4]["completions"] == 1
    single = by_key(reports.completions_by_type_day(events, per_offer), "offer_type", "day")
    assert single["bogo", 12]["completions"] == 1 and single["bogo", 12]["total_rewards"] == 10.0


def test_completions_equal_the_plain_join(spark):
    events, _, _, _, per_channel = inputs(spark)
    plain = spark.sql(
        """SELECT o.offer_type, cast(floor(time_since_test_start) as bigint) AS day,
             count(*) AS n, sum(reward) AS r
           FROM {t} t JOIN {o} o ON t.offer_id = o.offer_id
           WHERE event = 'offer completed' AND time_since_test_start IS NOT NULL GROUP BY 1, 2""",
        t=events,
        o=per_channel,
    )
    got = reports.completions_by_type_day(events, per_channel)
    assert {tuple(r) for r in plain.collect()} == {tuple(r) for r in got.collect()}


def test_demographics(spark):
    _, _, profiles, *_ = inputs(spark)
    got = by_key(reports.demographics(profiles), "gender", "age_group")
    assert set(got) == {
        ("F", "18-29"), ("F", "40-49"), ("M", "18-29"), ("O", "30-39"), ("X", "60-69")
    }
    assert got["O", "30-39"]["customers"] == 1
    assert got["O", "30-39"]["avg_credit_limit"] is None
    assert got["F", "40-49"]["avg_credit_limit"] == 900.0


def test_demographics_count_accounts_once(spark):
    _, _, profiles, *_ = inputs(spark)
    twice = reports.demographics(profiles.unionByName(profiles))
    once = reports.demographics(profiles)
    assert twice.collect() == once.collect()


def test_funnel_keeps_types_without_events_and_null_rates(spark):
    events, _, _, per_offer, per_channel = inputs(spark)
    got = by_key(reports.funnel_by_type(per_channel, events), "offer_type")
    bogo = got[("bogo",)]
    assert (bogo["received"], bogo["viewed"], bogo["completed"]) == (3, 1, 2)
    assert bogo["%_completed_rate"] == 100 * 2 / 3
    none = reports.funnel_by_type(per_offer, events.filter("offer_id = 'o1'"))
    row = by_key(none, "offer_type")[("discount",)]
    assert row["received"] == 0 and row["%_viewed_rate"] is None


def test_funnel_is_ordered(spark):
    events, _, _, _, per_channel = inputs(spark)
    received = [r.received for r in reports.funnel_by_type(per_channel, events).collect()]
    assert received == sorted(received, reverse=True)


def test_offer_performance(spark):
    _, filled, profiles, per_offer, _ = inputs(spark)
    out = reports.offer_performance(filled, profiles, per_offer)
    got = by_key(out, "offer_id")
    # Informational and unknown offers are left out; zz and a5 have no profile.
    assert set(got) == {("o1",), ("o2",), ("o4",)}
    assert got[("o1",)]["completion_rate_pct"] == 100.0
    assert got[("o2",)]["completion_rate_pct"] == 0.0
    rates = [r.completion_rate_pct for r in out.collect()]
    assert rates == sorted(rates, reverse=True)


def test_spend_per_account_is_null_without_amounts(spark):
    events, _, profiles, *_ = inputs(spark)
    got = by_key(reports.spend_per_account(events, profiles), "account_id")
    assert got[("a1",)]["total_amount"] == 30.0
    assert got[("a6",)]["total_amount"] is None
    assert ("zz",) not in got


def test_segment_offer_completion_equals_the_enriched_form(spark):
    _, filled, profiles, per_offer, _ = inputs(spark)
    enriched = dataset.enriched_events(filled, profiles, per_offer)
    plain = spark.sql(
        """WITH b AS (SELECT account_id, sum(if(event = 'transaction', amount, 0)) AS spent
             FROM {e} WHERE age IS NOT NULL GROUP BY 1),
           f AS (SELECT b.account_id, e.offer_type,
               CASE WHEN coalesce(spent, 0) >= 25 THEN 'High' WHEN coalesce(spent, 0) >= 10
                 THEN 'Medium' ELSE 'Low Spender' END AS segment,
               max(if(event = 'offer received', 1, 0)) AS r,
               max(if(event = 'offer completed', 1, 0)) AS c
             FROM b JOIN {e} e ON b.account_id = e.account_id WHERE offer_type IS NOT NULL
             GROUP BY 1, 2, 3)
           SELECT segment, offer_type, sum(r), sum(c),
             round(CASE WHEN sum(r) <> 0 THEN 100.0D * sum(c) / sum(r) END, 2) FROM f GROUP BY 1, 2""",
        e=enriched,
    )
    got = reports.segment_offer_completion(
        filled, profiles, per_offer, ((25, "High"), (10, "Medium"))
    )
    assert {tuple(r) for r in got.collect()} == {tuple(r) for r in plain.collect()}
    assert [tuple(r)[:2] for r in got.collect()] == sorted(tuple(r)[:2] for r in got.collect())


def totals(spark, values):
    rows = [(f"a{i}", v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "account_id string, total_amount double")


def test_exact_quantiles(spark):
    random.seed(1)
    values = [round(random.expovariate(0.01), 2) for _ in range(997)] + [None] * 5 + [7.0] * 500
    got = {
        r["Percentile"]: r["Total Amount"]
        for r in reports.spend_quantiles(totals(spark, values)).collect()
    }
    known = sorted(v for v in values if v is not None)
    at = lambda q: known[max(math.ceil(q * len(known)), 1) - 1]
    assert got == {
        "Min": at(0), "25th Percentile": at(0.25), "Median": at(0.5),
        "75th Percentile": at(0.75), "Max": at(1),
    }


def test_approximate_quantiles_are_within_the_error(spark):
    values = [float(i) for i in range(1, 1001)]
    got = {
        r["Percentile"]: r["Total Amount"]
        for r in reports.spend_quantiles(totals(spark, values), error=0.01).collect()
    }
    for label, q in (("25th Percentile", 0.25), ("Median", 0.5), ("75th Percentile", 0.75)):
        assert abs(got[label] - q * 1000) <= 10


def test_quantiles_of_one_and_of_no_account(spark):
    one = reports.spend_quantiles(totals(spark, [3.5])).collect()
    assert {r["Total Amount"] for r in one} == {3.5} and len(one) == 5
    assert reports.spend_quantiles(totals(spark, [])).count() == 0
