"""Schemas of the activity log, the user table and the scoring tables."""

from __future__ import annotations

from pyspark.sql import types as T

# The log's field names and the states and pages it reports.
LOGGED_IN = "Logged In"
PLAY_PAGE = "NextSong"
THUMBS_UP = "Thumbs Up"
THUMBS_DOWN = "Thumbs Down"
ADD_FRIEND = "Add Friend"
SUBMIT_DOWNGRADE = "Submit Downgrade"
CANCELLATION = "Cancellation Confirmation"

TRIGGER_PAGES = (SUBMIT_DOWNGRADE, THUMBS_DOWN)

PROFILE_COLUMNS = (
    "location",
    "userAgent",
    "lastName",
    "firstName",
    "gender",
    "registration",
)

CATEGORICAL_COLUMNS = ("gender", "last_level", "os", "browser")

NUMERIC_FEATURES = (
    "total_songs",
    "total_listen_time",
    "num_artists",
    "num_thumbs_up",
    "num_thumbs_down",
    "num_sessions",
    "num_friends_added",
    "num_downgrades",
    "tenure",
    "avg_songs_per_session",
)

# The log as it lies in JSON lines: epoch milliseconds, nothing parsed.
RAW_LOG = T.StructType(
    [
        T.StructField("userId", T.LongType()),
        T.StructField("ts", T.LongType()),
        T.StructField("registration", T.LongType()),
        T.StructField("auth", T.StringType()),
        T.StructField("page", T.StringType()),
        T.StructField("sessionId", T.LongType()),
        T.StructField("song", T.StringType()),
        T.StructField("artist", T.StringType()),
        T.StructField("length", T.DoubleType()),
        T.StructField("level", T.StringType()),
        T.StructField("gender", T.StringType()),
        T.StructField("location", T.StringType()),
        T.StructField("firstName", T.StringType()),
        T.StructField("lastName", T.StringType()),
        T.StructField("userAgent", T.StringType()),
    ]
)

# The log as every operator takes it.  ``tie`` orders events of one user that
# share a timestamp.
ACTIVITY_LOG = T.StructType(
    [
        T.StructField("userId", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("tie", T.LongType()),
    ]
    + [
        T.StructField(f.name, T.TimestampNTZType() if f.name == "registration" else f.dataType)
        for f in RAW_LOG.fields
        if f.name not in ("userId", "ts")
    ]
)

# One scoring request, the required fields, then the optional ones with defaults.
REQUIRED_REQUEST_FIELDS = (
    ("tenure", T.LongType()),
    ("total_songs", T.LongType()),
    ("total_listen_time", T.DoubleType()),
    ("num_artists", T.LongType()),
    ("num_thumbs_up", T.LongType()),
    ("num_thumbs_down", T.LongType()),
    ("num_sessions", T.LongType()),
    ("num_friends_added", T.LongType()),
    ("num_downgrades", T.LongType()),
    ("avg_songs_per_session", T.DoubleType()),
)
# The request's names of dummies and the columns that featurize gives them.
REQUEST_DUMMIES = {
    "gender_Male": "gender_M",
    "last_level_paid": "last_level_paid",
    "os_Linux": "os_Linux",
    "os_Mac_OS_X": "os_Mac OS X",
    "os_Windows": "os_Windows",
}
OPTIONAL_REQUEST_FIELDS = (
    ("gender_Male", False),
    ("last_level_paid", True),
    ("os_Linux", False),
    ("os_Mac_OS_X", False),
    ("os_Windows", False),
)
SCORING_REQUEST = T.StructType(
    [T.StructField(name, kind) for name, kind in REQUIRED_REQUEST_FIELDS]
    + [T.StructField(name, T.BooleanType()) for name, _ in OPTIONAL_REQUEST_FIELDS]
)
