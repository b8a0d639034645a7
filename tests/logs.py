"""Generated logs for equivalence and skew tests."""

import random
from datetime import datetime, timedelta

from stayline.schemas import ACTIVITY_LOG

PAGES = ("NextSong", "NextSong", "Thumbs Up", "Thumbs Down", "Submit Downgrade", "Add Friend", "Home")


def random_log(spark, seed=7, users=40, events=1500, hot_share=0.35):
    """A log with null attributes and keys, returning users and one heavy user."""
    rng = random.Random(seed)
    start = datetime(2020, 1, 1)
    stop_day = {u: rng.uniform(5, 90) for u in range(users)}
    agents = ["a0", "a1", "a2"]
    rows = []
    for i in range(events):
        user = 0 if rng.random() < hot_share else rng.randrange(users)
        ts = start + timedelta(days=rng.uniform(0, stop_day[user]), microseconds=i)
        page = rng.choice(PAGES)
        play = page == "NextSong"
        maybe = lambda value, share=0.6: value if rng.random() < share else None
        rows.append(
            {
                "userId": None if rng.random() < 0.03 else user,
                "ts": ts,
                "tie": i,
                "registration": maybe(start - timedelta(days=user % 9)),
                "auth": "Logged Out" if rng.random() < 0.05 else "Logged In",
                "page": page,
                "sessionId": int((ts - start).days),
                "song": f"s{i % 50}" if play else None,
                "artist": f"a{rng.randrange(30)}" if play else None,
                "length": float(rng.randrange(1, 400)) if play else None,
                "level": maybe(rng.choice(["free", "paid"])),
                "gender": None if user % 7 == 3 else maybe("MF"[user % 2]),
                "location": maybe(f"city{user % 4}"),
                "firstName": maybe(f"f{user}"),
                "lastName": maybe(f"l{user}"),
                "userAgent": maybe(rng.choice(agents)),
            }
        )
    fields = ACTIVITY_LOG.fieldNames()
    return spark.createDataFrame([tuple(r[f] for f in fields) for r in rows], ACTIVITY_LOG)


def rows_of(df, *cols):
    return sorted(map(repr, (tuple(r) for r in df.select(*cols or df.columns).collect())))
