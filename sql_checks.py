"""The registered queries as SQL, written from their definitions and not from the Spark code."""

INTERACTIONS = """
interactions AS (
  SELECT event_id, CAST(user_id AS VARCHAR) AS account_id,
    CASE event_type WHEN 'signup' THEN 'offer received' WHEN 'view' THEN 'offer viewed'
      WHEN 'click' THEN 'offer completed' WHEN 'purchase' THEN 'transaction'
      ELSE 'other' END AS event,
    CAST(date_sub('hour', TIMESTAMP '2024-01-01', ts) AS DOUBLE) / 24.0 AS time_since_test_start,
    CASE WHEN event_type IN ('signup', 'view', 'click')
      THEN json_extract_string(props, '$.k') END AS offer_id,
    CASE WHEN event_type = 'purchase' THEN value END AS amount,
    CASE WHEN event_type = 'click' THEN value END AS reward
  FROM events)"""

OFFERS = """
offers AS (
  SELECT CAST(p_partkey AS VARCHAR) AS offer_id,
    list_filter(['web', 'email', 'mobile', 'social'],
      lambda x, i: ((p_size >> (i - 1)) & 1) = 1) AS channels,
    CAST(p_size % 21 AS BIGINT) AS min_value,
    CAST(3 + p_partkey % 8 AS DOUBLE) AS duration,
    CASE p_partkey % 3 WHEN 0 THEN 'bogo' WHEN 1 THEN 'discount'
      ELSE 'informational' END AS offer_type,
    CAST(p_partkey % 5 AS BIGINT) AS discount_value
  FROM part)"""

OFFER_CHANNELS = OFFERS + """,
offer_channels AS (
  SELECT offer_id, unnest(channels) AS channels, min_value, duration, offer_type, discount_value
  FROM offers)"""

CHANNEL_ROWS = OFFER_CHANNELS + """,
channel_rows AS (
  SELECT offer_id, min_value, duration, offer_type, discount_value,
    CAST(channels = 'web' AS INTEGER) AS has_web,
    CAST(channels = 'email' AS INTEGER) AS has_email,
    CAST(channels = 'mobile' AS INTEGER) AS has_mobile,
    CAST(channels = 'social' AS INTEGER) AS has_social
  FROM offer_channels)"""

RAW_PROFILE = """
raw_profile AS (
  SELECT CAST(c_custkey AS VARCHAR) AS id, 18 + c_custkey % 60 AS age,
    strftime(DATE '2013-01-01' + CAST(c_custkey % 1800 AS INTEGER), '%Y%m%d') AS registered_on,
    CASE c_mktsegment WHEN 'HOUSEHOLD' THEN 'F' WHEN 'BUILDING' THEN 'F'
      WHEN 'MACHINERY' THEN 'M' WHEN 'FURNITURE' THEN 'O' END AS gender,
    c_acctbal AS credit_card_limit
  FROM customer)"""

PROFILE = RAW_PROFILE + """,
profile AS (
  SELECT id AS account_id, age,
    CAST(strptime(registered_on, '%Y%m%d') AS DATE) AS registered_on, gender, credit_card_limit,
    CAST(date_diff('day', CAST(strptime(registered_on, '%Y%m%d') AS DATE), DATE '2024-02-01')
      AS INTEGER) AS registered_on_days
  FROM raw_profile WHERE gender IS NOT NULL)"""

ATTRIBUTED = INTERACTIONS + """,
attributed AS (
  SELECT event_id, account_id, event, time_since_test_start,
    coalesce(offer_id, lag(offer_id) OVER (
      PARTITION BY account_id, time_since_test_start ORDER BY event, event_id)) AS offer_id,
    amount, reward
  FROM interactions)"""

OFFER_EVENTS = """
offer_events AS (
  SELECT account_id, offer_id, cnt_received, cnt_viewed, cnt_completed,
    CASE WHEN cnt_viewed > 0 AND cnt_completed > 0 THEN 1 ELSE 0 END AS is_converted_valid
  FROM (
    SELECT account_id, coalesce(offer_id, 'no offer') AS offer_id,
      count(*) FILTER (WHERE event = 'offer received') AS cnt_received,
      count(*) FILTER (WHERE event = 'offer viewed') AS cnt_viewed,
      count(*) FILTER (WHERE event = 'offer completed') AS cnt_completed
    FROM attributed GROUP BY 1, 2))"""

SPEND = """
spend AS (
  SELECT account_id, count(amount) AS total_transactions,
    CAST(sum(amount) AS DOUBLE) AS total_spent,
    CAST(sum(amount) AS DOUBLE) / count(amount) AS avg_ticket,
    max(amount) AS max_spent
  FROM interactions WHERE event = 'transaction' GROUP BY 1)"""

CONSOLIDATED = ",".join([ATTRIBUTED, OFFER_EVENTS, SPEND, PROFILE, CHANNEL_ROWS]) + """,
consolidated AS (
  SELECT e.account_id, e.offer_id, cnt_received, cnt_viewed, cnt_completed, is_converted_valid,
    p.age, p.registered_on, p.gender, p.credit_card_limit, p.registered_on_days,
    o.min_value, o.duration, o.offer_type, o.discount_value,
    o.has_web, o.has_email, o.has_mobile, o.has_social,
    coalesce(s.total_transactions, 0) AS total_transactions,
    coalesce(s.total_spent, 0.0::DOUBLE) AS total_spent,
    coalesce(s.avg_ticket, 0.0::DOUBLE) AS avg_ticket,
    coalesce(s.max_spent, 0.0::DOUBLE) AS max_spent
  FROM offer_events e JOIN profile p ON e.account_id = p.account_id
  LEFT JOIN channel_rows o ON e.offer_id = o.offer_id
  LEFT JOIN spend s ON e.account_id = s.account_id)"""

ENRICHED = ",".join([ATTRIBUTED, PROFILE, OFFERS]) + """,
enriched AS (
  SELECT t.*, p.age, p.registered_on, p.gender, p.credit_card_limit, p.registered_on_days,
    o.channels, o.min_value, o.duration, o.offer_type, o.discount_value
  FROM attributed t JOIN profile p ON t.account_id = p.account_id
  LEFT JOIN offers o ON t.offer_id = o.offer_id)"""

SPLITS = CONSOLIDATED + """,
splits AS (
  SELECT account_id, offer_id, coalesce(offer_type, 'no_offer') AS offer_type,
    coalesce(has_web, 0) AS has_web, coalesce(has_email, 0) AS has_email,
    coalesce(has_mobile, 0) AS has_mobile, coalesce(has_social, 0) AS has_social,
    total_spent,
    CASE WHEN CAST(('0x' || substr(md5(account_id || '#42'), 1, 8)) AS BIGINT) % 10000 < 8000
      THEN 'train' ELSE 'test' END AS split
  FROM consolidated)"""

PREDICTIONS = """
    CAST(CAST(account_id AS BIGINT) * 7 % 101 AS DOUBLE) AS pred_bogo,
    CAST(CAST(account_id AS BIGINT) * 13 % 101 AS DOUBLE) AS pred_discount,
    CAST(CAST(account_id AS BIGINT) * 17 % 101 AS DOUBLE) AS pred_informational,
    CAST(CAST(account_id AS BIGINT) * 29 % 101 AS DOUBLE) AS pred_no_offer"""

RECOMMEND = f"""
customers AS (
  SELECT p.account_id, coalesce(s.total_spent, 0.0::DOUBLE) AS total_spent
  FROM profile p LEFT JOIN spend s ON p.account_id = s.account_id),
predicted AS (SELECT account_id, total_spent, {PREDICTIONS} FROM customers),
best AS (
  SELECT *, greatest(pred_bogo, pred_discount, pred_informational, pred_no_offer)
    AS max_prediction FROM predicted),
recommended AS (
  SELECT *, CASE max_prediction WHEN pred_bogo THEN 'bogo' WHEN pred_discount THEN 'discount'
    WHEN pred_informational THEN 'informational' ELSE 'no_offer' END AS recommended_offer
  FROM best)"""

UPLIFT = ",".join([INTERACTIONS, SPEND, PROFILE, RECOMMEND]) + """,
uplift_rows AS (
  SELECT account_id, total_spent,
    CASE WHEN recommended_offer = 'no_offer' THEN 0 ELSE 1 END AS t,
    max_prediction - pred_no_offer AS uplift
  FROM recommended)"""

RANKED = UPLIFT + """,
ranked AS (
  SELECT *, row_number() OVER (ORDER BY uplift DESC,
    CAST(('0x' || substr(md5(account_id), 1, 8)) AS BIGINT), account_id) AS rank
  FROM uplift_rows)"""

CUMULATIVE = RANKED + """,
cumulative AS (
  SELECT *,
    CAST(sum(CASE WHEN t = 1 THEN total_spent ELSE 0 END)
      OVER running AS DOUBLE) AS y_treat_cum,
    CAST(sum(CASE WHEN t = 0 THEN total_spent ELSE 0 END)
      OVER running AS DOUBLE) AS y_ctrl_cum,
    CAST(sum(t) OVER running AS BIGINT) AS n_treat_cum,
    CAST(sum(1 - t) OVER running AS BIGINT) AS n_ctrl_cum
  FROM ranked
  WINDOW running AS (ORDER BY rank ROWS UNBOUNDED PRECEDING))"""

TOTALS = """
totals AS (
  SELECT count(*) AS n,
    CAST(sum(CASE WHEN t = 1 THEN total_spent ELSE 0 END) AS DOUBLE)
      AS y_treat_total,
    CAST(sum(CASE WHEN t = 0 THEN total_spent ELSE 0 END) AS DOUBLE)
      AS y_ctrl_total,
    CAST(greatest(sum(t), 1) AS BIGINT) AS n_treat_total,
    CAST(greatest(sum(1 - t), 1) AS BIGINT) AS n_ctrl_total
  FROM uplift_rows)"""

CURVE = ",".join([CUMULATIVE, TOTALS]) + """,
curve AS (
  SELECT rank / n AS frac,
    y_treat_cum - y_ctrl_cum
      * CASE WHEN n_ctrl_cum > 0 THEN n_treat_cum / n_ctrl_cum ELSE 0.0::DOUBLE END AS qini_real,
    (rank / n) * n_treat_total
      * (y_treat_total / n_treat_total - y_ctrl_total / n_ctrl_total) AS qini_random
  FROM cumulative, totals WHERE rank % greatest(n // 100, 1) = 0)"""

METRICS = """
    round(avg(abs(total_spent - prediction)), 6) AS mae,
    round(sqrt(avg((total_spent - prediction) ** 2)), 6) AS rmse,
    round(CASE WHEN stddev_pop(total_spent) * stddev_pop(prediction) = 0 THEN 0
      ELSE coalesce(corr(total_spent, prediction) ** 2, 0) END, 6) AS r2,
    round(CASE WHEN var_pop(total_spent) = 0 THEN NULL ELSE
      1 - avg((total_spent - prediction) ** 2) / var_pop(total_spent) END, 6) AS r2_score"""

KNOWN = ",".join([ATTRIBUTED, PROFILE]) + """,
known AS (SELECT * FROM attributed WHERE account_id IN (SELECT account_id FROM profile))"""

TRANSACTION_FEATURES = """
transaction_features AS (
  SELECT account_id, count(*) FILTER (WHERE event = 'transaction') AS transaction_frequency,
    coalesce(CAST(sum(amount) FILTER (WHERE event = 'transaction')
      AS DOUBLE), 0.0::DOUBLE) AS total_spend,
    CASE WHEN count(amount) > 0 THEN CAST(sum(amount) AS DOUBLE)
      / count(amount) END AS avg_transaction_value,
    round(stddev_samp(amount), 6) AS transaction_value_std,
    max(amount) AS max_transaction, min(amount) AS min_transaction
  FROM known GROUP BY 1)"""

OFFER_FEATURES = """
offer_features AS (
  SELECT *,
    CASE WHEN offers_received_count > 0
      THEN offers_viewed_count / offers_received_count ELSE 0.0::DOUBLE END AS view_rate,
    CASE WHEN offers_viewed_count > 0
      THEN offers_completed_count / offers_viewed_count ELSE 0.0::DOUBLE END
      AS completion_rate_after_view,
    CASE WHEN offers_received_count > 0
      THEN offers_completed_count / offers_received_count ELSE 0.0::DOUBLE END
      AS overall_completion_rate
  FROM (
    SELECT account_id,
      count(*) FILTER (WHERE event = 'offer received') AS offers_received_count,
      count(*) FILTER (WHERE event = 'offer viewed') AS offers_viewed_count,
      count(*) FILTER (WHERE event = 'offer completed') AS offers_completed_count
    FROM known GROUP BY 1))"""

REWARD_FEATURES = """
reward_features AS (
  SELECT account_id,
    coalesce(CAST(sum(reward) AS DOUBLE), 0.0::DOUBLE)
      AS total_rewards_earned,
    CASE WHEN count(reward) > 0 THEN CAST(sum(reward) AS DOUBLE)
      / count(reward) END AS avg_reward_per_completion
  FROM known GROUP BY 1)"""


def _time_features(week: int) -> str:
    return f"""
time_features AS (
  SELECT account_id,
    max(CASE WHEN event = 'transaction' THEN time_since_test_start END) AS last_transaction_time,
    min(CASE WHEN event = 'transaction' THEN time_since_test_start END) AS first_transaction_time,
    max(time_since_test_start) - min(time_since_test_start) AS customer_activity_span,
    count(*) FILTER (WHERE event = 'transaction' AND time_since_test_start <= {week})
      AS transactions_first_week,
    count(*) FILTER (WHERE event = 'transaction' AND time_since_test_start > {week}
      AND time_since_test_start <= {2 * week}) AS transactions_second_week
  FROM known GROUP BY 1)"""


OFFER_TYPE_FEATURES = """
offer_type_features AS (
  SELECT account_id,
    max(CASE WHEN offer_type = 'bogo' AND received > 0 THEN completed / received
      ELSE 0.0::DOUBLE END) AS bogo_completion_rate,
    max(CASE WHEN offer_type = 'discount' AND received > 0 THEN completed / received
      ELSE 0.0::DOUBLE END) AS discount_completion_rate,
    max(CASE WHEN offer_type = 'informational' AND received > 0 THEN viewed / received
      ELSE 0.0::DOUBLE END) AS informational_view_rate
  FROM (
    SELECT k.account_id, o.offer_type,
      count(*) FILTER (WHERE event = 'offer received') AS received,
      count(*) FILTER (WHERE event = 'offer viewed') AS viewed,
      count(*) FILTER (WHERE event = 'offer completed') AS completed
    FROM known k JOIN offers o ON k.offer_id = o.offer_id GROUP BY 1, 2)
  GROUP BY 1)"""

CHANNEL_FEATURES = """
channel_features AS (
  SELECT account_id,
    max(CASE WHEN channels = 'email' AND received > 0 THEN completed / received
      ELSE 0.0::DOUBLE END) AS email_engagement,
    max(CASE WHEN channels = 'mobile' AND received > 0 THEN completed / received
      ELSE 0.0::DOUBLE END) AS mobile_engagement,
    max(CASE WHEN channels = 'social' AND received > 0 THEN completed / received
      ELSE 0.0::DOUBLE END) AS social_engagement,
    max(CASE WHEN channels = 'web' AND received > 0 THEN completed / received
      ELSE 0.0::DOUBLE END) AS web_engagement
  FROM (
    SELECT k.account_id, o.channels,
      count(*) FILTER (WHERE event = 'offer received') AS received,
      count(*) FILTER (WHERE event = 'offer completed') AS completed
    FROM known k JOIN offer_channels o ON k.offer_id = o.offer_id GROUP BY 1, 2)
  GROUP BY 1)"""


def _segments(medium: int, high: int) -> str:
    return f"WITH {ENRICHED}" + f""",
behavior AS (
  SELECT account_id, CAST(sum(CASE WHEN event = 'transaction'
      THEN amount ELSE 0 END) AS DOUBLE) AS total_spent
  FROM enriched WHERE age IS NOT NULL GROUP BY 1),
flags AS (
  SELECT b.account_id,
    CASE WHEN total_spent >= {high} THEN 'High Spender'
      WHEN total_spent >= {medium} THEN 'Medium Spender' ELSE 'Low Spender' END
      AS spending_segment,
    e.offer_type,
    max(CASE WHEN event = 'offer received' THEN 1 ELSE 0 END) AS received,
    max(CASE WHEN event = 'offer completed' THEN 1 ELSE 0 END) AS completed
  FROM behavior b JOIN enriched e ON b.account_id = e.account_id
  WHERE e.offer_id IS NOT NULL AND e.offer_type IS NOT NULL GROUP BY 1, 2, 3)
SELECT spending_segment, offer_type, CAST(sum(received) AS BIGINT) AS total_received,
  CAST(sum(completed) AS BIGINT) AS total_completed,
  round(CASE WHEN sum(received) <> 0 THEN 100.0::DOUBLE * sum(completed) / sum(received) END, 2)
    AS completion_rate_pct
FROM flags GROUP BY 1, 2"""


_HAS_MODEL = "offer_type IN (SELECT offer_type FROM splits WHERE split = 'train')"
_FOREST_FEATURES = (
    "age,gender_idx,credit_card_limit,registered_on_days,total_transactions,avg_ticket,max_spent,"
    "min_value,duration,discount_value,has_web,has_email,has_mobile,has_social"
)
_IN_RANGE = ", ".join(
    f"CASE WHEN '{s}' IN (SELECT offer_type FROM splits WHERE split = 'train') THEN true END"
    f" AS {s}_in_range"
    for s in ("informational", "bogo", "discount", "no_offer")
)

#: Columns that hold sums of money or means of them, which both sides round: the last bits of a
#: sum of doubles depend on the order of the rows.
SPENT = ("total_spent", "avg_ticket")
SPEND_FEATURES = ("total_spend", "avg_transaction_value")
REWARD_SUMS = ("total_rewards_earned", "avg_reward_per_completion")
MONEY = {
    "consolidated": SPENT,
    "consolidated_heavy": SPENT,
    "one_row_per_account": SPENT,
    "user_spend_stats": SPENT,
    "completions_by_type_day": ("total_rewards",),
    "demographics": ("avg_credit_limit",),
    "spend_per_account": ("total_amount",),
    "spend_quantiles": ("Total Amount",),
    "transaction_features": SPEND_FEATURES,
    "reward_features": REWARD_SUMS,
    "customer_features": (*SPEND_FEATURES, *REWARD_SUMS),
    "prepare_features": ("avg_ticket",),
    "recommend_offer": ("total_spent",),
    "uplift": ("total_spent",),
    "uplift_rank": ("total_spent",),
    "train_forest": ("total_spent",),
    "tlearner_score": ("total_spent",),
    "qini_cumulative": ("total_spent", "y_treat_cum", "y_ctrl_cum"),
    "qini_totals": ("y_treat_total", "y_ctrl_total"),
}
DIGITS = 6


def _rounded(name: str, sql: str) -> str:
    columns = ", ".join(f'round("{c}", {DIGITS}) AS "{c}"' for c in MONEY.get(name, ()))
    return f"SELECT * REPLACE ({columns}) FROM ({sql})" if columns else sql


DEFINITIONS = {
    "train_forest": f"""WITH {SPLITS}
SELECT account_id, offer_id, total_spent, true AS in_range
FROM splits WHERE split = 'test' AND offer_type = 'bogo'""",
    "train_segments": f"""WITH {SPLITS}
SELECT offer_type, count(*) AS n, true AS consistent
FROM splits WHERE split = 'test' AND {_HAS_MODEL} GROUP BY 1""",
    "model_runs": f"""WITH {SPLITS}
SELECT DISTINCT 'rf_model_' || offer_type AS model, 1 AS version, 100 AS num_trees,
  15 AS max_depth, '{_FOREST_FEATURES}' AS features
FROM splits WHERE split = 'train'""",
    "tlearner_score": f"""WITH {SPLITS}
SELECT account_id, min(total_spent) AS total_spent, {_IN_RANGE} FROM splits GROUP BY 1""",
    "evaluate_saved": f"""WITH {SPLITS}
SELECT offer_type, count(*) AS n, true AS consistent
FROM splits WHERE split = 'test' AND {_HAS_MODEL} GROUP BY 1""",
    "recorded_sample": f"""WITH {SPLITS}
SELECT 'rf_model_' || offer_type AS model, 1 AS version, least(count(*), 10) AS "rows",
  least(count(*), 10) * len(string_split('{_FOREST_FEATURES}', ',')) AS "values", true AS in_range
FROM splits WHERE split = 'train' GROUP BY offer_type""",
    "campaign_report": f"""WITH {SPLITS}
SELECT offer_type, nullif(count(*) FILTER (WHERE split = 'test' AND {_HAS_MODEL}), 0) AS n,
  count(DISTINCT account_id) AS accounts,
  CASE WHEN {_HAS_MODEL} THEN 1 END AS model_version,
  CASE WHEN count(*) FILTER (WHERE split = 'test' AND {_HAS_MODEL}) > 0 THEN true END AS consistent
FROM splits GROUP BY 1""",
    "consolidated": f"WITH {CONSOLIDATED} SELECT * FROM consolidated",
    "json_scan": f"WITH {INTERACTIONS} SELECT * FROM interactions",
    "table_roundtrip": f"WITH {INTERACTIONS} SELECT * FROM interactions",
    "flatten_interactions": f"WITH {INTERACTIONS} SELECT * FROM interactions",
    "clean_profile": f"WITH {PROFILE} SELECT * FROM profile",
    "explode_channels": f"WITH {OFFER_CHANNELS} SELECT * FROM offer_channels",
    "offer_channel_rows": f"WITH {CHANNEL_ROWS} SELECT * FROM channel_rows",
    "offer_channel_flags": f"""WITH {OFFERS}
SELECT offer_id, min_value, duration, offer_type, discount_value,
  CAST(list_contains(channels, 'web') AS INTEGER) AS has_web,
  CAST(list_contains(channels, 'email') AS INTEGER) AS has_email,
  CAST(list_contains(channels, 'mobile') AS INTEGER) AS has_mobile,
  CAST(list_contains(channels, 'social') AS INTEGER) AS has_social
FROM offers""",
    "attribute_offers": f"WITH {ATTRIBUTED} SELECT * FROM attributed",
    "extract_transactions": f"""WITH {ATTRIBUTED}
SELECT account_id, event, time_since_test_start, offer_id, amount, reward FROM attributed""",
    "offer_events": f"WITH {ATTRIBUTED}, {OFFER_EVENTS} SELECT * FROM offer_events",
    "user_spend_stats": f"WITH {INTERACTIONS}, {SPEND} SELECT * FROM spend",
    "enriched_events": f"WITH {ENRICHED} SELECT * FROM enriched",
    "daily_activity": f"""WITH {INTERACTIONS}
SELECT CAST(floor(time_since_test_start) AS BIGINT) AS day,
  count(*) FILTER (WHERE event = 'transaction') AS transactions,
  count(*) FILTER (WHERE event = 'offer received') AS offers_received,
  count(*) FILTER (WHERE event = 'offer viewed') AS offers_viewed,
  count(*) FILTER (WHERE event = 'offer completed') AS offers_completed
FROM interactions WHERE time_since_test_start IS NOT NULL GROUP BY 1""",
    "completions_by_type_day": f"""WITH {INTERACTIONS}, {OFFER_CHANNELS}
SELECT o.offer_type, CAST(floor(t.time_since_test_start) AS BIGINT) AS day,
  count(*) AS completions,
  CAST(sum(t.reward) AS DOUBLE) AS total_rewards
FROM interactions t JOIN offer_channels o ON t.offer_id = o.offer_id
WHERE t.event = 'offer completed' AND o.offer_type IS NOT NULL
  AND t.time_since_test_start IS NOT NULL
GROUP BY 1, 2""",
    "demographics": f"""WITH {PROFILE}
SELECT gender,
  CASE WHEN age < 30 THEN '18-29' WHEN age < 40 THEN '30-39' WHEN age < 50 THEN '40-49'
    WHEN age < 60 THEN '50-59' WHEN age < 70 THEN '60-69' ELSE '70+' END AS age_group,
  count(DISTINCT account_id) AS customers,
  CAST(sum(credit_card_limit) AS DOUBLE) / count(credit_card_limit)
    AS avg_credit_limit
FROM profile WHERE gender IS NOT NULL AND age IS NOT NULL GROUP BY 1, 2""",
    "funnel_by_type": f"""WITH {INTERACTIONS}, {OFFER_CHANNELS}, counts AS (
  SELECT o.offer_type,
    count(DISTINCT CASE WHEN t.event = 'offer received' THEN t.account_id END) AS received,
    count(DISTINCT CASE WHEN t.event = 'offer viewed' THEN t.account_id END) AS viewed,
    count(DISTINCT CASE WHEN t.event = 'offer completed' THEN t.account_id END) AS completed
  FROM offer_channels o LEFT JOIN interactions t ON o.offer_id = t.offer_id
  WHERE o.offer_type IS NOT NULL GROUP BY 1)
SELECT *,
  CASE WHEN received <> 0 THEN 100 * viewed / received END AS "%_viewed_rate",
  CASE WHEN received <> 0 THEN 100 * completed / received END AS "%_completed_rate"
FROM counts""",
    "offer_performance": f"""WITH {ENRICHED}, perf AS (
  SELECT offer_id, max(offer_type) AS offer_type, max(discount_value) AS discount_value,
    max(min_value) AS min_value,
    count(DISTINCT CASE WHEN event = 'offer received' THEN account_id END) AS received,
    count(DISTINCT CASE WHEN event = 'offer completed' THEN account_id END) AS completed
  FROM enriched WHERE offer_id IS NOT NULL AND offer_type <> 'informational' GROUP BY 1)
SELECT offer_id, offer_type, discount_value, min_value,
  round(CASE WHEN received <> 0 THEN 100.0::DOUBLE * completed / received END, 2)
    AS completion_rate_pct
FROM perf""",
    "spend_per_account": f"""WITH {ENRICHED}
SELECT account_id, CAST(sum(amount) AS DOUBLE) AS total_amount
FROM enriched GROUP BY 1""",
    "spend_quantiles": f"""WITH {ENRICHED}, totals AS (
  SELECT account_id, CAST(sum(amount) AS DOUBLE) AS total_amount
  FROM enriched GROUP BY 1)
SELECT 'Min' AS "Percentile", min(total_amount) AS "Total Amount" FROM totals
UNION ALL SELECT '25th Percentile', quantile_disc(total_amount, 0.25) FROM totals
UNION ALL SELECT 'Median', quantile_disc(total_amount, 0.5) FROM totals
UNION ALL SELECT '75th Percentile', quantile_disc(total_amount, 0.75) FROM totals
UNION ALL SELECT 'Max', max(total_amount) FROM totals""",
    "segment_offer_completion": _segments(90, 161),
    "segment_offer_completion_500_750": _segments(500, 750),
    "transaction_features": f"""WITH {KNOWN}, {TRANSACTION_FEATURES}
SELECT * FROM transaction_features""",
    "offer_features": f"WITH {KNOWN}, {OFFER_FEATURES} SELECT * FROM offer_features",
    "reward_features": f"WITH {KNOWN}, {REWARD_FEATURES} SELECT * FROM reward_features",
    "time_features": f"WITH {KNOWN}, {_time_features(168)} SELECT * FROM time_features",
    "time_features_days": f"WITH {KNOWN}, {_time_features(7)} SELECT * FROM time_features",
    "offer_type_features": f"""WITH {KNOWN}, {OFFERS}, {OFFER_TYPE_FEATURES}
SELECT * FROM offer_type_features""",
    "channel_features": f"""WITH {KNOWN}, {OFFER_CHANNELS}, {CHANNEL_FEATURES}
SELECT * FROM channel_features""",
    "customer_features": f"""WITH {KNOWN}, {OFFER_CHANNELS}, {TRANSACTION_FEATURES},
{OFFER_FEATURES}, {REWARD_FEATURES}, {_time_features(7)}, {OFFER_TYPE_FEATURES},
{CHANNEL_FEATURES}
SELECT * FROM channel_features JOIN offer_type_features USING (account_id)
JOIN time_features USING (account_id) JOIN reward_features USING (account_id)
JOIN transaction_features USING (account_id) JOIN offer_features USING (account_id)""",
    "encode_gender": f"""WITH {RAW_PROFILE}
SELECT id, gender, CAST(CASE gender WHEN 'F' THEN 0 WHEN 'M' THEN 1 WHEN 'O' THEN 2 END
  AS DOUBLE) AS gender_idx
FROM raw_profile""",
    "prepare_features": f"""WITH {CONSOLIDATED}
SELECT account_id, offer_id, coalesce(offer_type, 'no_offer') AS offer_type,
  coalesce(age, -1) AS age,
  CAST(CASE gender WHEN 'F' THEN 0 WHEN 'M' THEN 1 WHEN 'O' THEN 2 ELSE -1 END AS DOUBLE)
    AS gender_idx,
  coalesce(credit_card_limit, -1.0::DOUBLE) AS credit_card_limit,
  coalesce(registered_on_days, -1) AS registered_on_days,
  total_transactions, avg_ticket, max_spent,
  coalesce(min_value, 0) AS min_value, coalesce(duration, 0.0::DOUBLE) AS duration,
  coalesce(discount_value, 0) AS discount_value, coalesce(has_web, 0) AS has_web,
  coalesce(has_email, 0) AS has_email, coalesce(has_mobile, 0) AS has_mobile,
  coalesce(has_social, 0) AS has_social
FROM consolidated""",
    "segment_split": f"""WITH {SPLITS}
SELECT account_id, offer_id, offer_type, has_web, has_email, has_mobile, has_social, split
FROM splits""",
    "union_test_splits": f"""WITH {SPLITS}
SELECT account_id, offer_id, offer_type, has_web, has_email, has_mobile, has_social
FROM splits WHERE split = 'test'""",
    "distinct_accounts": f"WITH {CONSOLIDATED} SELECT DISTINCT account_id FROM consolidated",
    "one_row_per_account": f"""WITH {CONSOLIDATED}
SELECT * EXCLUDE (n) FROM (
  SELECT *, row_number() OVER (PARTITION BY account_id ORDER BY offer_id NULLS FIRST,
    has_web NULLS FIRST, has_email NULLS FIRST, has_mobile NULLS FIRST,
    has_social NULLS FIRST) AS n
  FROM consolidated) WHERE n = 1""",
    "regression_metrics": f"""WITH {CONSOLIDATED}, scored AS (
  SELECT *, CAST(CAST(account_id AS BIGINT) * 7 % 101 AS DOUBLE) AS prediction
  FROM consolidated)
SELECT {METRICS} FROM scored""",
    "segment_metrics": f"""WITH {SPLITS}, scored AS (
  SELECT *, CAST(CAST(account_id AS BIGINT) * 7 % 101 AS DOUBLE) AS prediction
  FROM splits WHERE split = 'test')
SELECT offer_type, count(*) AS n, {METRICS} FROM scored GROUP BY 1""",
    "recommend_offer": f"""WITH {INTERACTIONS}, {SPEND}, {PROFILE}, {RECOMMEND}
SELECT * FROM recommended""",
    "uplift": f"""WITH {SPLITS}, {RECOMMEND}
SELECT s.account_id, s.offer_id, s.offer_type, s.has_web, s.has_email, s.has_mobile,
  s.has_social, s.total_spent, r.max_prediction, r.recommended_offer,
  CASE WHEN r.recommended_offer = 'no_offer' THEN 0 ELSE 1 END AS t,
  r.max_prediction - r.pred_no_offer AS uplift
FROM splits s JOIN recommended r ON s.account_id = r.account_id WHERE s.split = 'test'""",
    "uplift_rank": f"WITH {RANKED} SELECT account_id, total_spent, t, uplift, rank FROM ranked",
    "qini_cumulative": f"WITH {CUMULATIVE} SELECT * FROM cumulative",
    "qini_totals": f"WITH {UPLIFT}, {TOTALS} SELECT * FROM totals",
    "qini_curve": f"""WITH {CURVE}
SELECT round(frac, 6) AS frac, round(qini_real, 6) AS qini_real,
  round(qini_random, 6) AS qini_random
FROM curve""",
    "auuc": f"""WITH {CURVE}, steps AS (
  SELECT frac - lag(frac) OVER (ORDER BY frac) AS width,
    ((qini_real - qini_random) + lag(qini_real - qini_random) OVER (ORDER BY frac)) / 2 AS height
  FROM curve)
SELECT round(coalesce(sum(width * height), 0), 6) AS auuc FROM steps""",
}

# Other ways to the same rows.
DEFINITIONS |= {
    "attribute_offers_heavy": DEFINITIONS["attribute_offers"],
    "consolidated_heavy": DEFINITIONS["consolidated"],
    "ingest_offers": DEFINITIONS["explode_channels"],
    "ingest_profile": DEFINITIONS["clean_profile"],
    "ingest_transactions": DEFINITIONS["flatten_interactions"],
    "spend_quantiles_approx": """SELECT unnest(['Min', '25th Percentile', 'Median', '75th Percentile', 'Max'])
  AS "Percentile", true AS within_error""",
}
ORACLE = {name: _rounded(name, sql) for name, sql in DEFINITIONS.items()}
