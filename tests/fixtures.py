"""Hand-written inputs with the edge rows of every job."""

import datetime as dt

from offer_engine import schemas

AS_OF = dt.date(2024, 2, 1)

OFFER_ROWS = [
    (["web", "email", "mobile", "social"], 10, 7.0, "o1", "bogo", 10),
    (["web"], 5, 5.0, "o2", "discount", 3),
    ([], 0, 3.0, "o3", "informational", 0),
    (None, 0, 4.0, "o4", "bogo", 1),
    (["email", "social"], 20, 10.0, "o5", "informational", 0),
]

PROFILE_ROWS = [
    ("a1", 17, "20170101", "F", 1000.0),
    ("a2", 29, "20170102", "M", 2000.0),
    ("a3", 30, "not a date", "O", None),
    ("a4", 69, "20180101", "X", 500.0),
    ("a5", 70, "20180101", None, 700.0),
    ("a6", None, "20180101", "F", 800.0),
    ("a7", 45, "20240201", "F", 900.0),
]

RECEIVED, VIEWED, COMPLETED, PAID = (
    "offer received",
    "offer viewed",
    "offer completed",
    "transaction",
)

# event_id, account, event, time, "offer id", offer_id, amount, reward
EVENT_ROWS = [
    (1, "a1", RECEIVED, 0.0, "o1", None, None, None),
    (2, "a1", VIEWED, 6.0, "o1", None, None, None),
    # A completion and two payments at one instant: only the first payment is attributed.
    (3, "a1", COMPLETED, 12.0, None, "o1", None, 10.0),
    (4, "a1", PAID, 12.0, None, None, 20.5, None),
    (5, "a1", PAID, 12.0, None, None, 9.5, None),
    # Both spellings set: offer_id wins.
    (6, "a1", RECEIVED, 24.0, "o9", "o2", None, None),
    # Received and viewed at one instant, viewed without an offer.
    (7, "a2", RECEIVED, 1.0, "o5", None, None, None),
    (8, "a2", VIEWED, 1.0, None, None, None, None),
    (9, "a2", PAID, 200.0, None, None, 100.0, None),
    (10, "a2", PAID, 400.0, None, None, None, None),
    # Unknown offer, unknown event.
    (11, "a3", RECEIVED, 2.0, "missing", None, None, None),
    (12, "a3", "signed up", 2.5, None, None, None, None),
    (13, "a3", PAID, 168.0, None, None, 5.0, None),
    (14, "a3", PAID, 336.0, None, None, 7.0, None),
    # No profile, null gender, no age.
    (15, "zz", RECEIVED, 3.0, "o1", None, None, None),
    (16, "a5", COMPLETED, 4.0, None, "o2", None, 3.0),
    (17, "a6", RECEIVED, 5.0, "o1", None, None, None),
    (18, "a6", COMPLETED, 6.0, None, "o1", None, 10.0),
    (19, "a4", RECEIVED, 7.5, "o3", None, None, None),
    (20, "a4", RECEIVED, None, "o4", None, None, None),
]


def offers(spark):
    return spark.createDataFrame(OFFER_ROWS, schemas.OFFERS)


def profile(spark):
    return spark.createDataFrame(PROFILE_ROWS, schemas.PROFILE)


def interactions(spark):
    rows = [(i, a, e, t, (o1, o2, amt, rew)) for i, a, e, t, o1, o2, amt, rew in EVENT_ROWS]
    return spark.createDataFrame(rows, schemas.NUMBERED_INTERACTIONS)


def rows_of(df, *columns):
    """Rows as sorted tuples; nulls first."""
    picked = df.select(*columns) if columns else df
    return sorted(
        (tuple(r) for r in picked.collect()),
        key=lambda r: tuple((v is not None, str(v)) for v in r),
    )


def by_key(df, *key):
    return {tuple(r[k] for k in key): r for r in df.collect()}
