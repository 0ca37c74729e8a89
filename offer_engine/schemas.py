"""Schemas of the three raw JSON inputs."""

from pyspark.sql import types as T

OFFERS = T.StructType(
    [
        T.StructField("channels", T.ArrayType(T.StringType())),
        T.StructField("min_value", T.LongType()),
        T.StructField("duration", T.DoubleType()),
        T.StructField("id", T.StringType()),
        T.StructField("offer_type", T.StringType()),
        T.StructField("discount_value", T.LongType()),
    ]
)

PROFILE = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("age", T.LongType()),
        T.StructField("registered_on", T.StringType()),
        T.StructField("gender", T.StringType()),
        T.StructField("credit_card_limit", T.DoubleType()),
    ]
)

INTERACTION_VALUE = T.StructType(
    [
        T.StructField("offer id", T.StringType()),
        T.StructField("offer_id", T.StringType()),
        T.StructField("amount", T.DoubleType()),
        T.StructField("reward", T.DoubleType()),
    ]
)

INTERACTIONS = T.StructType(
    [
        T.StructField("account_id", T.StringType()),
        T.StructField("event", T.StringType()),
        T.StructField("time_since_test_start", T.DoubleType()),
        T.StructField("value", INTERACTION_VALUE),
    ]
)

# The same log when the producer numbers its rows.
NUMBERED_INTERACTIONS = T.StructType(
    [T.StructField("event_id", T.LongType()), *INTERACTIONS.fields]
)
