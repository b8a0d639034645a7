"""SQL for DuckDB that must give the same rows as the registered queries.

Written from the definitions, not from the Spark plans: attributes are filled
with windows over events, neighbours come from comparing every pair.
"""

from __future__ import annotations

from math import exp, factorial, floor

from stayline.registry.queries import AS_OF, BOOTS, DRIFT_FEATURES, SCORING_LIST, STOP_PATIENCE, STOP_ROUNDS
from stayline.sources.adapters import AGENTS

LOG = f"""
raw AS (
  SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events
),
log AS (
  SELECT user_id AS "userId", ts, event_id AS tie,
    CASE WHEN k % 6 <> 0 THEN TIMESTAMP '2024-01-01' - to_days(CAST(user_id % 400 AS INTEGER)) END AS registration,
    CASE WHEN k BETWEEN 40 AND 44 THEN 'Logged Out' ELSE 'Logged In' END AS auth,
    CASE WHEN event_type = 'view' THEN 'NextSong'
         WHEN event_type = 'click' THEN 'Thumbs Up'
         WHEN event_type = 'purchase' THEN 'Add Friend'
         WHEN event_type = 'signup' THEN 'Home'
         WHEN k >= 95 THEN 'Submit Downgrade'
         WHEN k = 94 THEN 'Cancellation Confirmation'
         WHEN k < 5 THEN 'Thumbs Down'
         ELSE 'Error' END AS page,
    CAST(day(ts) AS BIGINT) AS "sessionId",
    CASE WHEN event_type = 'view' THEN 'song_' || k END AS song,
    CASE WHEN event_type = 'view' THEN 'artist_' || (k % 20) END AS artist,
    CASE WHEN event_type = 'view' THEN value END AS length,
    CASE WHEN k % 10 = 3 THEN NULL WHEN k % 2 = 1 THEN 'paid' ELSE 'free' END AS level,
    CASE WHEN k % 10 = 0 AND user_id % 29 <> 7
         THEN CASE WHEN user_id % 2 = 0 THEN 'F' ELSE 'M' END END AS gender,
    CASE WHEN k % 7 = 0 THEN 'city_' || (user_id % 13) END AS location,
    CASE WHEN k % 5 = 0 THEN 'f_' || user_id END AS "firstName",
    'l_' || user_id AS "lastName",
    CASE WHEN user_id % 5 = 0 AND k % 4 = 1 THEN '{AGENTS[4]}'
         WHEN k % 3 = 0 THEN NULL
         WHEN user_id % 4 = 0 THEN '{AGENTS[0]}'
         WHEN user_id % 4 = 1 THEN '{AGENTS[1]}'
         WHEN user_id % 4 = 2 THEN '{AGENTS[2]}'
         ELSE '{AGENTS[3]}' END AS "userAgent"
  FROM raw
),
li AS (SELECT * FROM log WHERE auth = 'Logged In')
"""

PROFILE = ("location", "userAgent", "lastName", "firstName", "gender", "registration")


def _filled(column: str) -> str:
    c = f'"{column}"'
    return (
        f"coalesce(last_value({c} IGNORE NULLS) OVER past, first_value({c} IGNORE NULLS) OVER ahead) AS {c}"
    )


FILLED = f"""
filled AS (
  SELECT "userId", ts, tie, auth, page, "sessionId", song, artist, length, level,
    {", ".join(_filled(c) for c in PROFILE)}
  FROM li
  WHERE "userId" IS NOT NULL
  WINDOW past AS (PARTITION BY "userId" ORDER BY ts, tie ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
         ahead AS (PARTITION BY "userId" ORDER BY ts, tie ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
),
clean AS (SELECT * FROM filled WHERE {" AND ".join(f'"{c}" IS NOT NULL' for c in PROFILE)})
"""


# Families told by hand, for the agents of the test log and their kin.
OS = """CASE WHEN coalesce("userAgent", '') = '' THEN 'Unknown'
  WHEN contains("userAgent", 'iPhone') THEN 'iOS'
  WHEN contains("userAgent", 'Windows NT') THEN 'Windows'
  WHEN contains("userAgent", 'Macintosh') THEN 'Mac OS X'
  WHEN contains("userAgent", 'Ubuntu') THEN 'Ubuntu' ELSE 'Other' END"""
BROWSER = """CASE WHEN coalesce("userAgent", '') = '' THEN 'Unknown'
  WHEN contains("userAgent", 'Trident') THEN 'IE'
  WHEN contains("userAgent", 'Chrome/') THEN 'Chrome'
  WHEN contains("userAgent", 'Firefox/') THEN 'Firefox'
  WHEN contains("userAgent", 'iPhone') THEN 'Mobile Safari' ELSE 'Other' END"""


def _days(start: str, end: str) -> str:
    return f"CAST(floor((epoch_us({end}) - epoch_us({start})) / 86400000000.0) AS BIGINT)"


def _labelled(inactivity: str) -> str:
    return f"""
labelled AS (
  SELECT *, CAST("userId" IN (SELECT "userId" FROM clean WHERE page IN ('Submit Downgrade', 'Thumbs Down'))
    AND max(ts) OVER (PARTITION BY "userId") < (SELECT max(ts) FROM clean) - INTERVAL {inactivity} AS INTEGER) AS churn
  FROM clean
)"""


SCALARS = f"""
scalars AS (
  SELECT "userId", max(churn) AS churn, arg_min(gender, ts) AS gender,
    arg_min(registration, ts) AS reg, max(ts) AS last_ts,
    count(song) AS total_songs, round(coalesce(sum(length), 0.0), 2) AS total_listen_time,
    count(DISTINCT artist) AS num_artists,
    count(*) FILTER (page = 'Thumbs Up') AS num_thumbs_up,
    count(*) FILTER (page = 'Thumbs Down') AS num_thumbs_down,
    count(DISTINCT "sessionId") AS num_sessions,
    count(*) FILTER (page = 'Add Friend') AS num_friends_added,
    count(*) FILTER (page = 'Submit Downgrade') AS num_downgrades,
    arg_max(level, ts) FILTER (level IS NOT NULL) AS last_level,
    arg_max("userAgent", ts) AS "userAgent"
  FROM labelled GROUP BY 1
),
wide AS (
  SELECT *, {_days("reg", "last_ts")} AS tenure,
    CASE WHEN num_sessions = 0 THEN 0.0 ELSE total_songs / num_sessions END AS avg_songs_per_session
  FROM scalars
)
"""

FEATURES = (
    '"userId", churn, gender, total_songs, total_listen_time, num_artists, num_thumbs_up, '
    "num_thumbs_down, num_sessions, num_friends_added, num_downgrades, last_level, tenure, "
    f"avg_songs_per_session, {OS} AS os, {BROWSER} AS browser"
)
NUMBERS = (
    '"userId", churn, total_songs, total_listen_time, num_artists, num_thumbs_up, num_thumbs_down, '
    "num_sessions, num_friends_added, num_downgrades, tenure, avg_songs_per_session"
)
# The levels the mapping of the events table gives, smallest one dropped.
DUMMIES = {
    "gender": ("M",),
    "last_level": ("paid",),
    "os": ("Ubuntu", "Windows", "iOS"),
    "browser": ("Firefox", "IE", "Mobile Safari"),
}
DUMMY_SQL = ", ".join(
    [f"coalesce({c} = '{level}', FALSE) AS \"{c}_{level}\"" for c, ls in DUMMIES.items() for level in ls]
    + [f'{c} IS NULL AS "{c}_nan"' for c in DUMMIES]
)


def _as_of() -> str:
    """User features of the events up to the end of each day."""
    whole = "WHERE auth = 'Logged In'"
    days = [f"{EVENTS_FEATURES} SELECT {FEATURES}, DATE '{day}' AS as_of FROM wide".replace(whole, f"{whole} AND ts < DATE '{day}' + 1") for day in AS_OF]
    return " UNION ALL ".join(f"SELECT * FROM ({day})" for day in days)


SHIFTING = """
history AS (
  SELECT "userId", CAST(ts AS DATE) AS day, 1.0::DOUBLE / (1.0::DOUBLE + count(song)) AS score FROM li GROUP BY 1, 2
),
moved AS (SELECT "userId", day, CASE WHEN day(day) < 15 THEN score ELSE sqrt(score) END AS score FROM history)"""


def _significance() -> str:
    """Bootstrap by copying rows: each is drawn as often as its hash says, then metrics come from the copies."""
    below = [sum(exp(-1) / factorial(i) for i in range(k + 1)) for k in range(11)]
    drawn = " + ".join(f"CAST(bits >= {floor(share * 2**32)} AS INTEGER)" for share in below)
    bits = "CAST('0x' || substr(md5(\"userId\" || '-boot-' || b), 1, 8) AS BIGINT)"
    auc = lambda p: f"""(sum(r_{p}) FILTER (churn = 1) - count(*) FILTER (churn = 1) * (count(*) FILTER (churn = 1) + 1) / 2.0)
          / nullif(CAST(count(*) FILTER (churn = 1) AS DOUBLE) * count(*) FILTER (churn = 0), 0)"""  # noqa: E731
    f1 = lambda p: f"""coalesce((2 * count(*) FILTER ({p} > 0.5 AND churn = 1)) / nullif(2 * count(*) FILTER ({p} > 0.5 AND churn = 1)
          + count(*) FILTER ({p} > 0.5 AND churn = 0) + count(*) FILTER ({p} <= 0.5 AND churn = 1), 0), 0.0)"""  # noqa: E731
    ranks = ", ".join(f"rank() OVER (PARTITION BY b ORDER BY {p}) + (count(*) OVER (PARTITION BY b, {p}) - 1) / 2.0 AS r_{p}" for p in ("x", "y"))
    return f"""WITH {COMMERCE},
        pairs AS (SELECT "userId", churn, 7.0::DOUBLE / (7.0::DOUBLE + num_sessions) AS x, 9.0::DOUBLE / (9.0::DOUBLE + num_sessions) AS y FROM cu),
        lots AS (SELECT pairs.*, b, {bits} AS bits FROM pairs, range(-1, {BOOTS}) r(b)),
        times AS (SELECT *, CASE WHEN b < 0 THEN 1 ELSE {drawn} END AS w FROM lots),
        copies AS (SELECT b, churn, x, y, unnest(range(w)) AS copy FROM times),
        ranked AS (SELECT *, {ranks} FROM copies),
        v AS (SELECT b, 'f1' AS metric, {f1("x")} AS cur, {f1("y")} AS cand FROM ranked GROUP BY b
          UNION ALL SELECT b, 'roc_auc', {auc("x")}, {auc("y")} FROM ranked GROUP BY b),
        m AS (SELECT metric, max(cur) FILTER (b < 0) AS cur, max(cand) FILTER (b < 0) AS cand,
          list_sort(list(cand - cur) FILTER (b >= 0)) AS s, avg(CAST(cand - cur > 0 AS INTEGER)) FILTER (b >= 0) AS better FROM v GROUP BY 1)
        SELECT metric, round(cur, 9) AS current_value, round(cand, 9) AS candidate_value, round(cand - cur, 9) AS difference,
          round(s[CAST(floor(0.025 * len(s)) AS INTEGER) + 1], 9) AS low, round(s[len(s) - CAST(floor(0.025 * len(s)) AS INTEGER)], 9) AS high,
          round(better, 9) AS share_better, cand > 1.05 * cur AND s[CAST(floor(0.025 * len(s)) AS INTEGER) + 1] > 0 AS promote FROM m"""


def _featurized(inactivity: str) -> str:
    return (
        f"WITH {LOG}, {FILLED}, {_labelled(inactivity)}, {SCALARS}, "
        f"feats AS (SELECT {FEATURES} FROM wide), "
        f"encoded AS (SELECT {NUMBERS}, {DUMMY_SQL} FROM feats WHERE (SELECT max(churn) FROM feats) = 1) "
    )


EVENTS_FEATURES = f"WITH {LOG}, {FILLED}, {_labelled('12 HOURS')}, {SCALARS} "

EXPLICIT = """
explicit AS (
  SELECT "userId", CAST(bool_or(page = 'Submit Downgrade') AS INTEGER) AS churn FROM li GROUP BY 1
)"""

COMMERCE = f"""
since AS (SELECT o_custkey AS ck, min(o_orderdate) AS reg FROM orders GROUP BY 1),
clog AS (
  SELECT o_custkey AS "userId", o_orderdate AS ts, o_orderkey AS ok, reg, p_name, p_brand, l_quantity,
    l_returnflag AS flag, c_mktsegment AS segment, o_orderpriority AS priority
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN since ON ck = o_custkey
    JOIN customer ON c_custkey = o_custkey JOIN part ON p_partkey = l_partkey
),
cusers AS (
  SELECT "userId", max(ts) AS last_ts, min(reg) AS reg, count(p_name) AS total_songs,
    count(DISTINCT ok) AS num_sessions, count(*) FILTER (flag = 'R') AS triggers
  FROM clog GROUP BY 1
),
cu AS (
  SELECT "userId", last_ts, total_songs, num_sessions,
    {_days("reg", "(SELECT max(last_ts) FROM cusers)")} AS tenure_days,
    CAST(triggers > 0 AND last_ts < (SELECT max(last_ts) FROM cusers) - INTERVAL 365 DAYS AS INTEGER) AS churn
  FROM cusers
),
sc AS (SELECT "userId", churn, 9.0::DOUBLE / (9.0::DOUBLE + num_sessions) AS p FROM cu)
"""


def _confusion(scored: str, by: str = "") -> str:
    keys = f"{by}, " if by else ""
    group = f"GROUP BY {by}" if by else ""
    return f"""
counted AS (
  SELECT {keys}count(*) FILTER (p > 0.5 AND churn = 1) AS tp, count(*) FILTER (p > 0.5 AND churn = 0) AS fp,
    count(*) FILTER (p <= 0.5 AND churn = 1) AS fn, count(*) FILTER (p <= 0.5 AND churn = 0) AS tn
  FROM {scored} {group}
),
conf AS (
  SELECT *, coalesce(tp / nullif(tp + fp, 0), 0.0) AS "precision", coalesce(tp / nullif(tp + fn, 0), 0.0) AS recall,
    coalesce((2 * tp) / nullif(2 * tp + fp + fn, 0), 0.0) AS f1,
    coalesce(fp / nullif(fp + tn, 0), 0.0) AS false_positive_share,
    coalesce(fn / nullif(fn + tp, 0), 0.0) AS false_negative_share
  FROM counted
)"""


def _auc(scored: str, by: str = "") -> str:
    keys = f"{by}, " if by else ""
    part = f"PARTITION BY {by}" if by else ""
    part_p = f"PARTITION BY {by}, p" if by else "PARTITION BY p"
    group = f"GROUP BY {by}" if by else ""
    return f"""
rk AS (
  SELECT *, rank() OVER ({part} ORDER BY p) + (count(*) OVER ({part_p}) - 1) / 2.0 AS r FROM {scored}
),
auc AS (
  SELECT {keys}CAST(count(*) FILTER (churn = 1) AS BIGINT) AS positives,
    CAST(count(*) FILTER (churn = 0) AS BIGINT) AS negatives,
    (CAST(sum(r) FILTER (churn = 1) AS DOUBLE) - positives * (positives + 1) / 2.0)
      / nullif(CAST(positives AS DOUBLE) * negatives, 0) AS roc_auc
  FROM rk {group}
)"""


CURVE = """
g AS (SELECT p, count(*) FILTER (churn = 1) AS tp, count(*) AS n FROM sc GROUP BY p),
cum AS (
  SELECT p, sum(tp) OVER (ORDER BY p DESC) AS tps, sum(n) OVER (ORDER BY p DESC) AS flagged,
    (SELECT sum(tp) FROM g) AS all_pos
  FROM g
),
curve AS (
  SELECT p AS threshold, CAST(tps AS BIGINT) AS true_positives, CAST(flagged AS BIGINT) AS flagged,
    CAST(tps AS DOUBLE) / flagged AS "precision", CAST(tps AS DOUBLE) / all_pos AS recall
  FROM cum
),
steps AS (
  SELECT recall - lag(recall, 1, 0.0) OVER w AS dr, ("precision" + lag("precision", 1, 1.0) OVER w) / 2 AS mid
  FROM curve WINDOW w AS (ORDER BY threshold DESC)
)"""

HISTORY = """
history AS (
  SELECT "userId", CAST(ts AS DATE) AS day, 1.0::DOUBLE / (1.0::DOUBLE + count(song)) AS score FROM li GROUP BY 1, 2
)"""

POINTS = 'points AS (SELECT "userId", tenure_days, total_songs, churn FROM cu)'

NEIGHBORS = """
m AS (SELECT "userId" AS id, CAST(tenure_days AS DOUBLE) AS x, CAST(total_songs AS DOUBLE) AS y FROM points WHERE churn = 1),
near AS (
  SELECT a.id AS "userId", b.id AS neighbor, (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) AS distance2,
    a.x, a.y, b.x AS bx, b.y AS byy,
    CAST(row_number() OVER (PARTITION BY a.id ORDER BY (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y), b.id) AS INTEGER) AS rank
  FROM m a JOIN m b ON a.id <> b.id
),
nn AS (SELECT * FROM near WHERE rank <= 5)
"""


def _hex(text: str) -> str:
    return f"CAST('0x' || substr(md5({text}), 1, 8) AS BIGINT)"


SMOTE = f"""
sizes AS (SELECT count(*) FILTER (churn = 0) AS n0, count(*) FILTER (churn = 1) AS n1 FROM points),
drawn AS (
  SELECT id, CAST((n0 - n1) // n1 AS BIGINT)
      + CAST(row_number() OVER (ORDER BY md5(id || '-42'), id) <= (n0 - n1) % n1 AS BIGINT) AS copies
  FROM m, sizes
),
draws AS (SELECT id, CAST(unnest(range(1, copies + 1)) AS INTEGER) AS copy FROM drawn),
picks AS (
  SELECT id, copy, {_hex("id || '-' || copy || '-near-42'")} % 5 + 1 AS rank,
    {_hex("id || '-' || copy || '-gap-42'")} / 4294967296.0::DOUBLE AS gap
  FROM draws
)"""


RESAMPLED = """
resampled AS (
  SELECT "userId", 0 AS copy, tenure_days, total_songs, churn FROM points UNION ALL
  SELECT id, copy, CAST(trunc(x + gap * (bx - x)) AS BIGINT), CAST(trunc(y + gap * (byy - y)) AS BIGINT), 1
  FROM picks JOIN nn ON nn."userId" = picks.id AND nn.rank = picks.rank
)"""


def _drift() -> str:
    def side(number: int, condition: str) -> str:
        return f"""
side{number} AS (
  SELECT "userId", count(p_name) AS total_songs, sum(l_quantity) AS total_listen_time,
    count(DISTINCT p_brand) AS num_artists, count(DISTINCT ok) AS num_sessions
  FROM clog WHERE ts {condition} TIMESTAMP '1998-05-01' GROUP BY 1
)"""

    long = " UNION ALL ".join(
        f"SELECT '{f}' AS feature, CAST({f} AS DOUBLE) AS v, {n} AS new FROM side{n}"
        for f in DRIFT_FEATURES
        for n in (0, 1)
    )
    series = " + ".join(
        f"{2.0 * (-1) ** (j - 1)}::DOUBLE * exp({-2.0 * j * j}::DOUBLE * lam * lam)" for j in range(1, 21)
    )
    return f"""WITH {COMMERCE}, {side(0, "<")}, {side(1, ">=")},
long AS ({long}),
sums AS (SELECT feature, v, count(*) FILTER (new = 0) AS a, count(*) FILTER (new = 1) AS b FROM long GROUP BY 1, 2),
tot AS (SELECT feature, sum(a) AS na, sum(b) AS nb FROM sums GROUP BY 1),
cdf AS (
  SELECT feature, sum(a) OVER (PARTITION BY feature ORDER BY v) AS ca, sum(b) OVER (PARTITION BY feature ORDER BY v) AS cb FROM sums
),
stat AS (
  SELECT feature, CAST(na AS BIGINT) AS n_reference, CAST(nb AS BIGINT) AS n_current,
    max(abs(CAST(ca AS DOUBLE) / na - CAST(cb AS DOUBLE) / nb)) AS d
  FROM cdf JOIN tot USING (feature) GROUP BY 1, 2, 3
),
scaled AS (SELECT *, sqrt(CAST(n_reference AS DOUBLE) * n_current / (n_reference + n_current)) * d AS lam FROM stat),
p AS (SELECT *, CASE WHEN lam < 0.2 THEN 1.0 ELSE least(1.0, greatest(0.0, {series})) END AS pv FROM scaled)
SELECT feature, n_reference, n_current, round(d, 9) AS statistic, round(pv, 6) AS p_value, pv < 0.05 AS drifted FROM p"""


def _boxplot(column: str) -> str:
    return f"""WITH {COMMERCE},
q AS (SELECT churn, quantile_cont(CAST({column} AS DOUBLE), 0.25) AS q1, quantile_cont(CAST({column} AS DOUBLE), 0.5) AS median,
  quantile_cont(CAST({column} AS DOUBLE), 0.75) AS q3 FROM cu GROUP BY 1),
f AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM q)
SELECT churn, q1, median, q3, CAST(min({column}) FILTER ({column} BETWEEN lo AND hi) AS DOUBLE) AS whisker_low,
  CAST(max({column}) FILTER ({column} BETWEEN lo AND hi) AS DOUBLE) AS whisker_high,
  count(*) FILTER ({column} NOT BETWEEN lo AND hi) AS outliers
FROM cu JOIN f USING (churn) GROUP BY 1, 2, 3, 4"""


SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")


def _useless() -> str:
    columns = {
        "total_songs": "count(p_name)",
        "total_listen_time": "sum(l_quantity)",
        "num_artists": "count(DISTINCT p_brand)",
        "num_thumbs_up": "count(*) FILTER (flag = 'A')",
        "num_thumbs_down": "count(*) FILTER (flag = 'R')",
        "num_sessions": "count(DISTINCT ok)",
        "num_friends_added": "0",
        "num_downgrades": "0",
        "tenure": _days("min(reg)", "max(ts)"),
        "avg_songs_per_session": "count(p_name) / count(DISTINCT ok)",
    }
    for s in SEGMENTS[1:]:
        columns[f"gender_{s}"] = f"CAST(min(segment) = '{s}' AS INTEGER)"
    columns["gender_nan"] = "0"
    for p in PRIORITIES[1:]:
        columns[f"last_level_{p}"] = f"CAST(max(ROW(ts, priority)).priority = '{p}' AS INTEGER)"
    for c in ("last_level", "os", "browser"):
        columns[f"{c}_nan"] = "0"
    wide = ", ".join(f'CAST({sql} AS DOUBLE) AS "{name}"' for name, sql in columns.items())
    long = " UNION ALL ".join(
        f"SELECT {i} AS pos, '{name}' AS feature, \"userId\", \"{name}\" AS v FROM w"
        for i, name in enumerate(columns)
    )
    return f"""WITH {COMMERCE}, w AS (
  SELECT "userId", {wide.replace("max(ROW(ts, priority)).priority", "max({'ts': ts, 'priority': priority}).priority")} FROM clog GROUP BY 1
),
long AS ({long}),
const AS (SELECT pos, feature, min(v) = max(v) AS is_constant FROM long GROUP BY 1, 2),
same AS (
  SELECT b.pos AS pos, min(a.pos) AS first_pos FROM (
    SELECT a.pos AS pos_a, b.pos AS pos_b FROM long a JOIN long b ON a."userId" = b."userId" AND a.pos < b.pos
    GROUP BY 1, 2 HAVING bool_and(a.v = b.v)
  ) t JOIN const a ON a.pos = pos_a JOIN const b ON b.pos = pos_b GROUP BY 1
)
SELECT const.feature, const.is_constant, o.feature AS duplicate_of
FROM const LEFT JOIN same ON same.pos = const.pos LEFT JOIN const o ON o.pos = same.first_pos"""


def _profile() -> str:
    types = {
        "userId": "bigint", "ts": "timestamp_ntz", "tie": "bigint", "registration": "timestamp_ntz",
        "auth": "string", "page": "string", "sessionId": "bigint", "song": "string", "artist": "string",
        "length": "double", "level": "string", "gender": "string", "location": "string",
        "firstName": "string", "lastName": "string", "userAgent": "string",
    }
    return f"WITH {LOG} " + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", '{t}' AS type, count(*) AS rows, count(\"{c}\") AS non_null FROM log"
        for c, t in types.items()
    )


def _aligned() -> str:
    have = {"os_Linux": "0.0"}
    columns = ", ".join(
        f"CAST({have[f]} AS DOUBLE) AS \"{f}\"" if f in have else f'CAST("{f}" AS DOUBLE) AS "{f}"'
        for f in SCORING_LIST
    )
    return _featurized("12 HOURS") + f'SELECT "userId", {columns} FROM encoded'


def _records(run: str) -> str:
    return (
        f"SELECT '{run}' AS run_id, 'AUC_ROC' AS metric, round(roc_auc, 9) AS value FROM auc UNION ALL "
        f"SELECT '{run}', 'F1_Score', round(f1, 9) FROM conf UNION ALL "
        f"SELECT '{run}', 'Precision', round(\"precision\", 9) FROM conf UNION ALL "
        f"SELECT '{run}', 'Recall', round(recall, 9) FROM conf UNION ALL "
        f"SELECT '{run}', 'PR_AUC', round(sum(dr * mid), 9) FROM steps"
    )


def _f1(scale: float) -> str:
    hit = f"{scale}::DOUBLE / ({scale}::DOUBLE + num_sessions) > 0.5"
    tp, fp, fn = (
        f"count(*) FILTER ({hit} AND churn = 1)",
        f"count(*) FILTER ({hit} AND churn = 0)",
        f"count(*) FILTER (NOT ({hit}) AND churn = 1)",
    )
    return f"(SELECT coalesce((2 * {tp}) / nullif(2 * {tp} + {fp} + {fn}, 0), 0.0) FROM cu)"


SPLIT = """
split AS (
  SELECT "userId", churn, row_number() OVER (PARTITION BY churn ORDER BY md5("userId" || '-42'), "userId")
    <= round(0.2 * count(*) OVER (PARTITION BY churn)) AS is_test FROM cu
)"""
KNOWN_TEST = f"""
known AS (SELECT "userId", CAST(num_sessions < 9 AS INTEGER) AS churn FROM cu),
{SPLIT.replace("FROM cu", "FROM known").replace("split AS", "known_split AS")},
known_test AS (SELECT "userId", churn FROM known_split WHERE is_test)"""
CHECKED_TEST = 'SELECT "userId", churn, TRUE AS is_probability, TRUE AS follows_threshold FROM split WHERE is_test'

# Two fixed scores in place of fitted models.
FIXED = """
fixed AS (
  SELECT "userId", churn, 9.0::DOUBLE / (9.0::DOUBLE + num_sessions) AS a,
    1.0::DOUBLE / (1.0::DOUBLE + ("userId" % 97) / 10.0::DOUBLE + total_songs / 20.0::DOUBLE) AS b FROM cu
)"""


def _area(score: str, source: str = "fixed") -> str:
    """AUC of one score column by ranks."""
    return f"""(SELECT (sum(r) FILTER (churn = 1) - count(*) FILTER (churn = 1) * (count(*) FILTER (churn = 1) + 1) / 2.0)
      / (CAST(count(*) FILTER (churn = 1) AS DOUBLE) * count(*) FILTER (churn = 0))
    FROM (SELECT churn, rank() OVER (ORDER BY s) + (count(*) OVER (PARTITION BY s) - 1) / 2.0 AS r
      FROM (SELECT churn, {score} AS s FROM {source})))"""


MODEL_AUCS = f"""
aucs AS (
  SELECT 'a' AS model, {_area("a")} AS score_val, 1.5::DOUBLE AS fit_time
  UNION ALL SELECT 'b', {_area("b")}, 0.5::DOUBLE
)"""
# The first model with the highest area, and the first share of the other that raises it most.
_OPTIONS = " UNION ALL ".join(
    f"SELECT {i} AS i, '{i}' AS name, {i * 0.05!r}::DOUBLE AS share, CASE WHEN (SELECT model FROM top) = 'a' "
    f"THEN {_area(f'{1 - i * 0.05!r}::DOUBLE * a + {i * 0.05!r}::DOUBLE * b')} "
    f"ELSE {_area(f'{1 - i * 0.05!r}::DOUBLE * b + {i * 0.05!r}::DOUBLE * a')} END AS auc"
    for i in range(1, 20)
)
BLENDS = f"""
top AS (SELECT model, score_val FROM aucs ORDER BY score_val DESC, model LIMIT 1),
options AS ({_OPTIONS}),
best AS (SELECT share, auc FROM options ORDER BY auc DESC, name LIMIT 1),
taken AS (SELECT CASE WHEN auc > (SELECT score_val FROM top) THEN share ELSE 0.0 END AS share FROM best),
chosen AS (
  SELECT aucs.model, CASE WHEN aucs.model = top.model THEN 1 - share ELSE share END AS weight FROM aucs, top, taken
)"""


ORACLES: dict[str, str] = {
    "filter_logged_in": f'WITH {LOG} SELECT "userId", ts, tie, auth, page FROM li',
    "filter_page": f"WITH {LOG} SELECT \"userId\", ts, tie, page FROM li WHERE page = 'Thumbs Down'",
    "cancel_like_pages": f"WITH {LOG} SELECT DISTINCT page FROM li WHERE lower(page) LIKE '%cancel%'",
    "distinct_pages": f"WITH {LOG} SELECT DISTINCT page FROM li ORDER BY page",
    "trigger_users": f"""WITH {LOG} SELECT "userId" FROM li WHERE page = 'Submit Downgrade'
        UNION SELECT "userId" FROM li WHERE page = 'Thumbs Down'""",
    "trigger_user_count": f"""WITH {LOG} SELECT count(DISTINCT "userId") AS num_trigger_users FROM li
        WHERE page IN ('Submit Downgrade', 'Thumbs Down')""",
    "semi_trigger_users": f"""WITH {LOG} SELECT "userId", ts, tie, page FROM li WHERE "userId" IN
        (SELECT "userId" FROM li WHERE page IN ('Submit Downgrade', 'Thumbs Down'))""",
    "inactive_users": f"""WITH {LOG}, u AS (SELECT "userId", max(ts) AS last_ts FROM li GROUP BY 1)
        SELECT * FROM u WHERE last_ts < (SELECT max(ts) FROM li) - INTERVAL 12 HOURS""",
    "drop_incomplete_users": f'WITH {LOG}, {FILLED} SELECT DISTINCT "userId" FROM clean',
    "churn_flag_events": f"""WITH {LOG} SELECT "userId", ts, tie, page, CAST("userId" IN
        (SELECT "userId" FROM li WHERE page = 'Submit Downgrade') AS INTEGER) AS churn FROM li""",
    "distinct_user_agents": f"""WITH {LOG} SELECT DISTINCT "userId", "userAgent" FROM li
        WHERE "userAgent" IS NOT NULL""",
    "user_agent_fanout": f"""WITH {LOG}, u AS (SELECT "userId", max(ts) AS last_ts FROM li GROUP BY 1),
        a AS (SELECT DISTINCT "userId", "userAgent" FROM li WHERE "userAgent" IS NOT NULL)
        SELECT u."userId", last_ts, "userAgent" FROM u LEFT JOIN a ON a."userId" = u."userId" """,
    "fill_profile": f"""WITH {LOG}, {FILLED} SELECT "userId", ts, tie, location, "userAgent", "lastName",
        "firstName", gender, registration FROM filled""",
    "clean_log": f"WITH {LOG}, {FILLED} SELECT * FROM clean",
    "last_interaction": f'WITH {LOG} SELECT "userId", max(ts) AS last_ts FROM li GROUP BY 1',
    "engagement_counts": f"""WITH {LOG} SELECT "userId", count(song) AS total_songs,
        round(coalesce(sum(length), 0.0), 2) AS total_listen_time, count(DISTINCT artist) AS num_artists,
        count(DISTINCT "sessionId") AS num_sessions FROM li GROUP BY 1""",
    "page_counts": f"""WITH {LOG} SELECT "userId", count(*) FILTER (page = 'Thumbs Up') AS num_thumbs_up,
        count(*) FILTER (page = 'Thumbs Down') AS num_thumbs_down,
        count(*) FILTER (page = 'Add Friend') AS num_friends_added,
        count(*) FILTER (page = 'Submit Downgrade') AS num_downgrades FROM li GROUP BY 1""",
    "first_profile": f"""WITH {LOG} SELECT "userId", arg_min(gender, ts) FILTER (gender IS NOT NULL) AS gender,
        arg_min(registration, ts) FILTER (registration IS NOT NULL) AS registration FROM li GROUP BY 1""",
    "last_level": f"""WITH {LOG} SELECT "userId", arg_max(level, ts) FILTER (level IS NOT NULL) AS last_level
        FROM li GROUP BY 1""",
    "tenure_user": f"""WITH {LOG}, u AS (SELECT "userId",
        arg_min(registration, ts) FILTER (registration IS NOT NULL) AS reg, max(ts) AS last_ts FROM li GROUP BY 1)
        SELECT "userId", {_days("reg", "last_ts")} AS tenure FROM u""",
    "tenure_dataset": f"""WITH {LOG}, u AS (SELECT "userId", min(registration) AS reg FROM li GROUP BY 1)
        SELECT "userId", {_days("reg", "(SELECT max(ts) FROM li)")} AS tenure_days FROM u""",
    "songs_per_session": f"""WITH {LOG} SELECT "userId", count(song) AS total_songs,
        count(DISTINCT "sessionId") AS num_sessions,
        coalesce(count(song) / nullif(count(DISTINCT "sessionId"), 0), 0.0) AS avg_songs_per_session
        FROM li GROUP BY 1""",
    "session_duration": f"""WITH {LOG}, s AS (SELECT "userId", "sessionId",
        epoch_us(max(ts)) - epoch_us(min(ts)) AS micros FROM li GROUP BY 1, 2)
        SELECT "userId", count(*) AS num_sessions,
        CAST(sum(micros) AS DOUBLE) / 1000000.0 / count(*) AS avg_session_duration FROM s GROUP BY 1""",
    "play_trend_14d": f"""WITH {LOG}, t AS (SELECT *, ts > (SELECT max(ts) FROM li) - INTERVAL 14 DAYS AS recent FROM li),
        u AS (SELECT "userId", count(song) FILTER (recent) AS recent_songs,
        count(song) FILTER (NOT recent) AS earlier_songs FROM t GROUP BY 1),
        d AS (SELECT "userId", least(13, CAST(floor((epoch_us(ts) - epoch_us((SELECT max(ts) FROM li) - INTERVAL 14 DAYS))
        / 86400000000.0) AS INTEGER)) AS d, count(song) AS plays FROM t WHERE recent GROUP BY 1, 2),
        grid AS (SELECT "userId", g.d AS d, coalesce(plays, 0) AS plays FROM u CROSS JOIN range(14) AS g(d)
        LEFT JOIN d USING ("userId", d)),
        slope AS (SELECT "userId", round(regr_slope(plays, d), 9) + 0.0 AS daily_slope FROM grid GROUP BY 1)
        SELECT u.*, coalesce(recent_songs / nullif(recent_songs + earlier_songs, 0), 0.0) AS recent_share, daily_slope
        FROM u JOIN slope ON slope."userId" = u."userId" """,
    "ua_os_family": f'WITH {LOG}, a AS (SELECT DISTINCT "userAgent" FROM li) SELECT "userAgent", {OS} AS os FROM a',
    "ua_browser_family": f"""WITH {LOG}, a AS (SELECT DISTINCT "userAgent" FROM li)
        SELECT "userAgent", {BROWSER} AS browser FROM a""",
    "churn_label": f"""WITH {LOG}, {FILLED}, {_labelled("12 HOURS")}
        SELECT "userId", max(ts) AS last_ts, max(churn) AS churn FROM labelled GROUP BY 1""",
    "churn_label_explicit": f"WITH {LOG}, {EXPLICIT} SELECT * FROM explicit",
    "churn_label_cancelled": f"""WITH {LOG} SELECT "userId",
        CAST(bool_or(page = 'Cancellation Confirmation') AS INTEGER) AS churn FROM li GROUP BY 1""",
    "user_features": EVENTS_FEATURES + f"SELECT {FEATURES} FROM wide",
    "incremental_user_features": EVENTS_FEATURES + f"SELECT {FEATURES} FROM wide",
    "incremental_features_as_of": _as_of(),
    "sketched_engagement": f"""WITH {LOG}, {FILLED} SELECT "userId", count(DISTINCT artist) AS num_artists,
        count(DISTINCT "sessionId") AS num_sessions FROM clean GROUP BY 1""",
    "log_quarantine": """SELECT CASE event_id % 40 WHEN 0 THEN 'unreadable' WHEN 1 THEN 'wrong type'
        WHEN 2 THEN 'no time' WHEN 3 THEN 'bad time' ELSE 'sound' END AS reason, count(*) AS n FROM events GROUP BY 1""",
    "user_features_fanout": EVENTS_FEATURES
    + ", ua AS (SELECT DISTINCT \"userId\", \"userAgent\" FROM clean), "
    'fan AS (SELECT wide.* EXCLUDE ("userAgent"), ua."userAgent" FROM wide LEFT JOIN ua ON ua."userId" = wide."userId") '
    f"SELECT {FEATURES} FROM fan",
    "featurize": _featurized("12 HOURS") + "SELECT * FROM encoded",
    "one_hot_features": EVENTS_FEATURES
    + f', feats AS (SELECT {FEATURES} FROM wide) SELECT "userId", {DUMMY_SQL} FROM feats',
    "align_features": _aligned(),
    "useless_features": _useless(),
    "log_time_range": f"""WITH {LOG} SELECT min(ts) AS min_ts, max(ts) AS max_ts,
        {_days("min(ts)", "max(ts)")} AS span_days FROM li""",
    "table_profile": _profile(),
    "log_preview": f"WITH {LOG} SELECT * FROM li ORDER BY ts, tie LIMIT 5",
    "auth_counts": f"WITH {LOG} SELECT auth, count(*) AS n FROM log GROUP BY 1",
    "page_frequency": f"""WITH {LOG} SELECT page, count(*) AS n,
        count(*) / (SELECT count(*) FROM li) AS share FROM li GROUP BY 1""",
    "churn_distribution": f"""WITH {COMMERCE} SELECT churn, count(*) AS n,
        count(*) / (SELECT count(*) FROM cu) AS share,
        CASE churn WHEN 0 THEN 'Active' WHEN 1 THEN 'Churned' END AS status FROM cu GROUP BY 1""",
    "churn_rate": f"WITH {COMMERCE} SELECT coalesce(avg(churn), 0.0) AS churn_rate FROM cu",
    "songs_by_cohort": f"""WITH {LOG}, {EXPLICIT}, s AS (SELECT "userId", count(*) AS song_count FROM li
        WHERE page = 'NextSong' GROUP BY 1) SELECT "userId", song_count, churn FROM s JOIN explicit USING ("userId")""",
    "cohort_medians": f"""WITH {LOG}, {EXPLICIT}, s AS (SELECT "userId", count(*) AS song_count FROM li
        WHERE page = 'NextSong' GROUP BY 1), u AS (SELECT "userId",
        arg_min(registration, ts) FILTER (registration IS NOT NULL) AS reg, max(ts) AS last_ts FROM li GROUP BY 1)
        SELECT churn, median(CAST(song_count AS DOUBLE)) AS median_song_count,
        median(CAST({_days("reg", "last_ts")} AS DOUBLE)) AS median_tenure
        FROM s JOIN explicit USING ("userId") JOIN u USING ("userId") GROUP BY 1""",
    "gender_by_churn": f"""WITH {LOG}, {EXPLICIT}, d AS (SELECT DISTINCT "userId", gender, churn FROM li
        JOIN explicit USING ("userId")) SELECT gender, churn, count(*) AS n FROM d GROUP BY 1, 2""",
    "level_by_churn": f"""WITH {LOG}, {EXPLICIT}, l AS (SELECT "userId",
        arg_max(level, ts) FILTER (level IS NOT NULL) AS last_level FROM li GROUP BY 1)
        SELECT last_level, churn, count(*) AS n FROM l JOIN explicit USING ("userId") GROUP BY 1, 2""",
    "tenure_histogram": f"""WITH {COMMERCE} SELECT churn, CAST(floor(tenure_days / 100.0) AS BIGINT) AS bin,
        count(*) AS n, CAST(floor(tenure_days / 100.0) * 100.0 AS DOUBLE) AS bin_from FROM cu GROUP BY ALL""",
    "songs_boxplot": _boxplot("total_songs"),
    "tenure_boxplot": _boxplot("tenure_days"),
    "scatter_points": f"""WITH {COMMERCE} SELECT tenure_days, total_songs, churn, count(*) AS n
        FROM cu GROUP BY 1, 2, 3""",
    "stratified_split": f"""WITH {COMMERCE} SELECT "userId", churn, row_number() OVER (PARTITION BY churn
        ORDER BY md5("userId" || '-42'), "userId") <= round(0.2 * count(*) OVER (PARTITION BY churn)) AS is_test
        FROM cu""",
    "class_weights": f"""WITH {COMMERCE}, c AS (SELECT churn, count(*) AS n_class FROM cu GROUP BY 1)
        SELECT churn, n_class, CAST((SELECT count(*) FROM cu) AS DOUBLE)
        / ((SELECT count(*) FROM c) * n_class) AS weight FROM c""",
    "class_balance": f"""WITH {COMMERCE}, c AS (SELECT count(*) FILTER (churn = 0) AS negatives,
        count(*) FILTER (churn = 1) AS positives FROM cu)
        SELECT negatives, positives, negatives / nullif(positives, 0) AS scale_pos_weight FROM c""",
    "metric_roc_auc": f"WITH {COMMERCE}, {_auc('sc')} SELECT * FROM auc",
    "metric_confusion": f"WITH {COMMERCE}, {_confusion('sc')} SELECT * FROM conf",
    "pr_curve": f"WITH {COMMERCE}, {CURVE} SELECT * FROM curve",
    "metric_pr_auc": f"WITH {COMMERCE}, {CURVE} SELECT round(sum(dr * mid), 9) AS pr_auc FROM steps",
    "run_metrics": f"WITH {COMMERCE}, {CURVE}, {_auc('sc')}, {_confusion('sc')} " + _records("orders_9"),
    "promotion_gate": f"""WITH {COMMERCE}, v AS (SELECT {_f1(7.0)} AS current_value, {_f1(9.0)} AS candidate_value)
        SELECT 'F1_Score' AS metric, *, candidate_value > 1.05 * current_value AS promote FROM v""",
    "promotion_significance": _significance(),
    "shift_alerts": f"""WITH {LOG}, {SHIFTING}, d AS (SELECT day, count(*) AS scored, count(*) FILTER (score > 0.5) AS flagged,
          row_number() OVER (ORDER BY day) AS k FROM moved GROUP BY 1),
        b AS (SELECT sum(flagged) FILTER (k <= 7) / sum(scored) FILTER (k <= 7) AS base FROM d),
        z AS (SELECT d.*, flagged / scored AS flagged_share, base,
          CASE WHEN k > 7 THEN (flagged / scored - base) / sqrt(greatest(least(base, 0.999), 0.001)
            * (1 - greatest(least(base, 0.999), 0.001)) / scored) END AS move FROM d, b),
        t AS (SELECT *, sum(coalesce(move - 0.5, 0)) OVER (ORDER BY day) AS up, sum(coalesce(-move - 0.5, 0)) OVER (ORDER BY day) AS down FROM z),
        s AS (SELECT *, up - least(min(up) OVER (ORDER BY day), 0) AS raised, down - least(min(down) OVER (ORDER BY day), 0) AS lowered FROM t)
        SELECT day, scored, flagged, round(flagged_share, 6) AS flagged_share, round(base, 6) AS baseline_share,
          round(raised, 6) AS raised, round(lowered, 6) AS lowered,
          CASE WHEN raised > 5 THEN 'up' WHEN lowered > 5 THEN 'down' END AS alert FROM s""",
    "score_stability": f"""WITH {LOG}, {SHIFTING}, h AS (SELECT day, least(CAST(floor(score * 10) AS INTEGER), 9) AS bin FROM moved),
        days AS (SELECT day, count(*) AS scored FROM h GROUP BY 1), bins AS (SELECT CAST(i AS INTEGER) AS bin FROM range(10) r(i)),
        q AS (SELECT bins.bin, (count(h.bin) + 0.5) / (SELECT count(*) + 5.0 FROM h WHERE day(day) <= 7) AS q
          FROM bins LEFT JOIN (SELECT * FROM h WHERE day(day) <= 7) h ON h.bin = bins.bin GROUP BY 1),
        p AS (SELECT days.day, scored, q, ((SELECT count(*) FROM h WHERE h.day = days.day AND h.bin = q.bin) + 0.5) / (scored + 5.0) AS p FROM days, q),
        i AS (SELECT day, any_value(scored) AS scored, sum((p - q) * ln(p / q)) AS psi FROM p GROUP BY 1)
        SELECT day, scored, round(psi, 6) AS psi, psi > 0.2 AS shifted FROM i""",
    "stored_length_quantiles": f"""WITH {LOG}, v AS (SELECT coalesce(level, 'none') AS level, list_sort(list(length)) AS s
          FROM li WHERE length IS NOT NULL GROUP BY 1)
        SELECT level, CAST(len(s) AS BIGINT) AS n, s[CAST(ceil(0.25 * len(s)) AS INTEGER)] AS q1, s[CAST(ceil(0.5 * len(s)) AS INTEGER)] AS median,
          s[CAST(ceil(0.75 * len(s)) AS INTEGER)] AS q3 FROM v""",
    "scatter_sample": f"""WITH {COMMERCE} SELECT "userId", tenure_days, total_songs, churn FROM cu
        QUALIFY row_number() OVER (PARTITION BY churn ORDER BY md5("userId" || '-42'), "userId") <= 200""",
    "prediction_share": f"""WITH {LOG}, {HISTORY} SELECT day, count(*) AS scored,
        count(*) FILTER (score > 0.5) AS flagged, count(*) FILTER (score > 0.5) / count(*) AS flagged_share
        FROM history GROUP BY 1""",
    "delayed_metrics": f"""WITH {LOG}, {FILLED}, {_labelled("12 HOURS")}, {HISTORY},
        truth AS (SELECT "userId", max(churn) AS churn FROM labelled GROUP BY 1),
        judged AS (SELECT day, score AS p, churn FROM history JOIN truth USING ("userId")),
        {_auc("judged", "day")}, {_confusion("judged", "day")}
        SELECT auc.day, positives, negatives, roc_auc, "precision", recall, f1 FROM auc JOIN conf ON conf.day = auc.day""",
    "drift_ks": _drift(),
    "smote_neighbors": f"""WITH {COMMERCE}, {POINTS}, {NEIGHBORS}
        SELECT "userId", rank, neighbor, distance2 FROM nn""",
    "smote_resample": f"WITH {COMMERCE}, {POINTS}, {NEIGHBORS}, {SMOTE}, {RESAMPLED} SELECT * FROM resampled",
    "churn_distribution_resampled": f"""WITH {COMMERCE}, {POINTS}, {NEIGHBORS}, {SMOTE}, {RESAMPLED}
        SELECT churn, count(*) AS n, count(*) / (SELECT count(*) FROM resampled) AS share,
        CASE churn WHEN 0 THEN 'Active' WHEN 1 THEN 'Churned' END AS status FROM resampled GROUP BY 1""",
    "scatter_points_resampled": f"""WITH {COMMERCE}, {POINTS}, {NEIGHBORS}, {SMOTE}, {RESAMPLED}
        SELECT tenure_days, total_songs, churn, count(*) AS n FROM resampled GROUP BY 1, 2, 3""",
    "one_hot_sparse": f"""WITH {LOG}, cities AS (
          SELECT location AS level, row_number() OVER (ORDER BY location) - 1 AS code
          FROM (SELECT DISTINCT location FROM li WHERE location IS NOT NULL)),
        names AS (
          SELECT "lastName" AS level, row_number() OVER (ORDER BY "lastName") - 1 AS code
          FROM (SELECT DISTINCT "lastName" FROM li WHERE "lastName" IS NOT NULL))
        SELECT tie, (SELECT count(*) FROM cities) + (SELECT count(*) FROM names) + 2 AS width,
          CAST(coalesce(c.code, (SELECT count(*) FROM cities)) AS VARCHAR) || ',' ||
          CAST((SELECT count(*) FROM cities) + 1 + coalesce(n.code, (SELECT count(*) FROM names)) AS VARCHAR) AS places
        FROM li LEFT JOIN cities c ON c.level = li.location LEFT JOIN names n ON n.level = li."lastName" """,
    "rf_churn_scores": f"WITH {COMMERCE}, {SPLIT} {CHECKED_TEST}",
    "gbt_churn_scores": f"WITH {COMMERCE}, {SPLIT} {CHECKED_TEST}",
    "score_batch": f"""WITH {COMMERCE} SELECT "userId", TRUE AS is_probability, TRUE AS follows_threshold,
        CAST(NULL AS VARCHAR) AS error FROM cu""",
    "model_leaderboard": f"""WITH {COMMERCE} SELECT model, (SELECT count(*) FROM cu) AS rows_scored,
        TRUE AS is_probability, TRUE AS in_order
        FROM (VALUES ('RandomForestGini'), ('RandomForestEntr'), ('GradientBoosting'), ('LogisticRegression')) t(model)""",
    "forest_of_splits": f"""WITH {COMMERCE}, s AS (SELECT "userId", (CASE WHEN tenure_days <= 1800 THEN 0.75 ELSE 0.125 END
          + 2 * CASE WHEN total_songs <= 40 THEN 0.625 WHEN tenure_days <= 2200 THEN 0.5 ELSE 0.25 END) / 3.0 AS score FROM cu)
        SELECT "userId", CAST(round(score, 9) AS DOUBLE) AS score, CAST(score > 0.5 AS INTEGER) AS prediction FROM s""",
    "rf_known_rule": f"""WITH {COMMERCE}, {KNOWN_TEST}
        SELECT "userId", churn, CAST(churn AS DOUBLE) AS score, churn AS prediction FROM known_test""",
    "gbt_known_rule": f"""WITH {COMMERCE}, {KNOWN_TEST} SELECT "userId", churn, churn AS prediction FROM known_test""",
    "score_known_rule": f"""WITH {COMMERCE}, {KNOWN_TEST}, r AS (SELECT "userId", churn, "userId" % 11 <> 0 AS whole FROM known)
        SELECT "userId", CASE WHEN whole THEN churn END AS churn_prediction, CASE WHEN whole THEN CAST(churn AS DOUBLE) END AS churn_probability,
          CASE WHEN NOT whole THEN 'Field required: num_sessions' END AS error FROM r""",
    "known_rule_leaderboard": f"""WITH {COMMERCE}, {KNOWN_TEST}, told AS (SELECT model, churn, CAST(churn AS DOUBLE) AS p FROM known,
        (VALUES ('RandomForestGini'), ('RandomForestEntr'), ('LogisticRegression')) t(model)),
        {_auc("told", "model")} SELECT model, round(roc_auc, 9) AS score_val FROM auc""",
    "boosting_stop": f"""WITH {COMMERCE}, steps AS (SELECT "userId", churn, m, (("userId" * 7919 + m * 104729) * (m + 13)) % 23
          + CASE WHEN m <= 12 THEN 3 * churn ELSE -churn END AS step FROM cu, range(1, {STOP_ROUNDS + 1}) r(m)),
        margins AS (SELECT m, churn, sum(step) OVER (PARTITION BY "userId" ORDER BY m) AS p FROM steps),
        {_auc("margins", "m")},
        best AS (SELECT m, roc_auc, max(roc_auc) OVER (ORDER BY m) AS reached FROM auc),
        tops AS (SELECT m, roc_auc, (SELECT min(b.m) FROM auc b WHERE b.roc_auc = best.reached) AS top FROM best),
        stop AS (SELECT min(m) AS last FROM tops WHERE m - top >= {STOP_PATIENCE}),
        kept AS (SELECT top FROM tops WHERE m = coalesce((SELECT last FROM stop), {STOP_ROUNDS}))
        SELECT CAST(m AS INTEGER) AS round, round(roc_auc, 9) AS roc_auc,
          m <= coalesce((SELECT last FROM stop), {STOP_ROUNDS}) AS is_counted, m = (SELECT top FROM kept) AS is_best FROM auc""",
    "score_answers": f"""WITH {COMMERCE}, {FIXED},
        r AS (SELECT "userId", a, CASE WHEN "userId" % 7 = 0 THEN 'Field required: tenure'
          WHEN "userId" % 11 = 0 THEN 'Field required: total_songs' END AS error FROM fixed)
        SELECT "userId", CASE WHEN error IS NULL THEN CAST(a > 0.5 AS INTEGER) END AS churn_prediction,
          CASE WHEN error IS NULL THEN a END AS churn_probability, error FROM r""",
    "fold_assignment": f"""WITH {COMMERCE} SELECT "userId", CAST({_hex("\"userId\" || '-fold-42'")} % 8 AS INTEGER) AS fold FROM cu""",
    "leaderboard_order": f"""WITH {COMMERCE}, {FIXED}, {MODEL_AUCS}
        SELECT model, round(score_val, 9) AS score_val, fit_time,
          CAST(row_number() OVER (ORDER BY score_val DESC, model) AS INTEGER) AS place FROM aucs""",
    "ensemble_scores": f"""WITH {COMMERCE}, {FIXED} SELECT "userId", churn, round(0.25 * a + 0.75 * b, 9) AS score FROM fixed""",
    "ensemble_weights": f"""WITH {COMMERCE}, {FIXED}, {MODEL_AUCS}, {BLENDS}
        SELECT model, round(weight, 9) AS weight FROM chosen WHERE weight > 0""",
}
