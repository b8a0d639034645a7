"""The golden log: twelve events, five users that survive cleaning."""

from stayline.schemas import RAW_LOG

DAY = 86_400_000
DAY0 = 1_538_352_000_000

MAC = "Mozilla/5.0 (Macintosh; Intel Mac OS X 10_9_4) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/36.0.1985.125 Safari/537.36"
WIN = "Mozilla/5.0 (Windows NT 6.1; WOW64; rv:31.0) Gecko/20100101 Firefox/31.0"
IOS = "Mozilla/5.0 (iPhone; CPU iPhone OS 7_1_2 like Mac OS X) AppleWebKit/537.51.2 (KHTML, like Gecko) Version/7.0 Mobile/11D257 Safari/9537.53"

# user, day, page, session, level, gender, agent, registration day, song, artist, length, auth
EVENTS = [
    (1, 0, "NextSong", 10, "free", None, MAC, -30, "A", "X", 200.0, "Logged In"),
    (1, 1, "NextSong", 10, "paid", "M", None, -30, "B", "X", 100.0, "Logged In"),
    (1, 1.5, "Thumbs Down", 11, None, None, None, -30, None, None, None, "Logged In"),
    (2, 2, "Submit Downgrade", 20, "paid", "F", WIN, -10, None, None, None, "Logged In"),
    (2, 60, "NextSong", 21, "free", "F", WIN, -10, "A", "X", 50.0, "Logged In"),
    (3, 3, "NextSong", 30, "free", "M", MAC, -1.5, "C", "Y", 75.0, "Logged In"),
    (4, 30, "Thumbs Down", 40, "free", "F", MAC, 0, None, None, None, "Logged In"),
    (5, 90, "Thumbs Down", 50, "free", None, WIN, 0, None, None, None, "Logged In"),
    (None, 95, "Thumbs Up", 60, "free", "M", WIN, 0, None, None, None, "Logged In"),
    (6, 99, "Home", 70, "free", "M", WIN, 0, None, None, None, "Logged Out"),
    (7, 40, "Add Friend", None, "paid", "F", WIN, 41.5, None, None, None, "Logged In"),
    (7, 41, "Home", None, "paid", "F", IOS, 41.5, None, None, None, "Logged In"),
]


def raw_rows():
    rows = []
    for user, day, page, session, level, gender, agent, reg, song, artist, length, auth in EVENTS:
        rows.append(
            {
                "userId": user,
                "ts": DAY0 + int(day * DAY),
                "registration": DAY0 + int(reg * DAY),
                "auth": auth,
                "page": page,
                "sessionId": session,
                "song": song,
                "artist": artist,
                "length": length,
                "level": level,
                "gender": gender,
                "location": "here",
                "firstName": "first",
                "lastName": "last",
                "userAgent": agent,
            }
        )
    return rows


def raw_log(spark):
    rows = [tuple(r[f] for f in RAW_LOG.fieldNames()) for r in raw_rows()]
    return spark.createDataFrame(rows, RAW_LOG)


# userId: churn, gender, last_level, songs, listen time, artists, up, down, sessions,
# friends, downgrades, tenure, songs per session
EXPECTED = {
    1: (1, "M", "paid", 2, 300.0, 1, 0, 1, 2, 0, 0, 31, 1.0),
    2: (0, "F", "free", 1, 50.0, 1, 0, 0, 2, 0, 1, 70, 0.5),
    3: (0, "M", "free", 1, 75.0, 1, 0, 0, 1, 0, 0, 4, 1.0),
    4: (0, "F", "free", 0, 0.0, 0, 0, 1, 1, 0, 0, 30, 0.0),
    7: (0, "F", "paid", 0, 0.0, 0, 0, 0, 0, 1, 0, -1, 0.0),
}
