import json
from datetime import timedelta
from types import SimpleNamespace

import pytest
from golden import EXPECTED, raw_log, raw_rows
from logs import random_log, rows_of
from pyspark.sql import functions as F

from stayline import staging
from stayline.operators import agents, cleaning, encoding, labels, users
from stayline.plans.featurize import FEATURE_COLUMNS, churn_labels, featurize, user_features
from stayline.schemas import CATEGORICAL_COLUMNS
from stayline.sources.tables import (
    MissingInput,
    load_feature_list,
    parse_log,
    read_activity_log,
    read_features,
    save_feature_list,
    write_features,
)


@pytest.fixture(scope="module")
def golden(spark):
    return parse_log(raw_log(spark))


def test_golden_user_table(golden):
    found = {
        r.userId: (
            r.churn, r.gender, r.last_level, r.total_songs, r.total_listen_time, r.num_artists,
            r.num_thumbs_up, r.num_thumbs_down, r.num_sessions, r.num_friends_added,
            r.num_downgrades, r.tenure, r.avg_songs_per_session,
        )
        for r in user_features(golden).collect()
    }
    assert found == EXPECTED


def test_golden_latest_agent_and_fanout(golden):
    latest = {r.userId: (r.os, r.browser) for r in user_features(golden).collect()}
    assert latest[7] == ("iOS", "Mobile Safari")
    assert latest[1] == ("Mac OS X", "Chrome")
    fan = user_features(golden, ua_mode="fanout")
    assert fan.count() == 6
    assert {r.os for r in fan.where("userId = 7").collect()} == {"Windows", "iOS"}


def test_golden_dummies(golden):
    table, levels = featurize(golden, ua_mode="fanout")
    for name in (
        "gender_M", "gender_nan", "last_level_paid", "last_level_nan", "os_Windows", "os_iOS", "os_nan",
    ):
        assert name in table.columns
    assert "os_Mac OS X" not in table.columns and "gender_F" not in table.columns
    for c, found in levels.items():
        marks = [f"`{c}_{level}`" for level in found[1:]] + [f"`{c}_nan`"]
        total = sum((F.col(m).cast("int") for m in marks), F.lit(0))
        assert table.where(total > 1).count() == 0


def test_no_churn_gives_empty_table_with_schema(golden):
    table, _ = featurize(golden, timedelta(days=3650))
    assert table.count() == 0
    assert "total_songs" in table.columns and "gender_M" in table.columns
    for_scoring, _ = featurize(golden, timedelta(days=3650), require_churn=False)
    assert for_scoring.count() == 5 and for_scoring.columns == table.columns


def test_clean_log_window_form_matches_aggregate_form(spark):
    log = random_log(spark)
    clean = cleaning.clean_log(log)
    by_window = (
        clean.groupBy("userId")
        .agg(
            F.min_by("gender", "ts").alias("gender"),
            F.min_by("registration", "ts").alias("registration"),
            F.max("ts").alias("last_ts"),
            F.count("song").alias("total_songs"),
            F.coalesce(F.sum("length"), F.lit(0.0)).alias("total_listen_time"),
            F.count_distinct("artist").alias("num_artists"),
            F.count_distinct("sessionId").alias("num_sessions"),
            F.max_by("level", F.when(F.col("level").isNotNull(), F.col("ts"))).alias("last_level"),
            F.max_by("userAgent", "ts").alias("userAgent"),
            F.count_if(F.col("page").isin("Thumbs Down", "Submit Downgrade")).alias("num_triggers"),
        )
    )
    by_sets = users.user_aggregates(cleaning.logged_in(log)).select(*by_window.columns)
    assert rows_of(by_window) == rows_of(by_sets)
    churned = labels.with_churn(by_window, timedelta(days=30)).select("userId", "last_ts", "churn")
    assert rows_of(churned) == rows_of(churn_labels(log, timedelta(days=30)))
    assert 0 < churned.where("churn = 1").count() < churned.count()
    assert rows_of(agents.distinct_user_agents(clean)) == rows_of(
        agents.distinct_user_agents(cleaning.logged_in(log)).join(by_sets.select("userId"), "userId")
    )


def filled_by_pandas(log, cols):
    pdf = log.where("userId is not null").toPandas().sort_values(["userId", "ts", "tie"])
    pdf[cols] = pdf.groupby("userId")[cols].transform(lambda x: x.ffill().bfill())
    return pdf


def assert_filled(log, parts, cols=("location", "userAgent", "gender", "registration")):
    cols = list(cols)
    pdf = filled_by_pandas(log, cols)
    ours = cleaning.fill_profile(log, cols, parts=parts).toPandas().sort_values(["userId", "ts", "tie"])
    assert ours["tie"].tolist() == pdf["tie"].tolist()
    for c in cols:
        assert [None if x != x else x for x in ours[c]] == [None if x != x else x for x in pdf[c]]


@pytest.mark.parametrize("parts", [1, 7, 60])
def test_fill_is_the_same_in_any_number_of_parts(spark, parts):
    assert_filled(random_log(spark, seed=parts), parts)


@pytest.mark.parametrize("parts", [1, 20])
def test_fill_of_heavy_user_with_one_moment(spark, parts):
    log = random_log(spark, events=400, hot_share=0.9)
    assert_filled(log.withColumn("ts", F.expr("TIMESTAMP_NTZ'2020-01-01 00:00:00'")), parts)


def test_fill_of_many_heavy_users(spark):
    assert_filled(random_log(spark, users=300, events=6000, hot_share=0.0), 40)


def test_equal_times_go_by_the_tie_everywhere(spark):
    rows = []
    for user, order in ((1, (3, 1, 2)), (2, (2, 3, 1))):
        for tie, level, gender, agent in zip(order, ("free", "paid", None), ("M", None, "F"), ("b", "c", "a"), strict=True):
            rows.append((user, tie, level, gender, agent))
    log = spark.createDataFrame(rows, "userId long, tie long, level string, gender string, userAgent string").selectExpr(
        "userId", "timestamp_ntz'2020-01-01 00:00:00' ts", "tie", "timestamp_ntz'2019-01-01' registration", "'Logged In' auth",
        "'NextSong' page", "1L sessionId", "'s' song", "'a' artist", "1.0D length", "level", "gender", "'x' location",
        "'f' firstName", "'l' lastName", "userAgent",
    )
    want = {}
    for user in (1, 2):
        own = sorted((r for r in rows if r[0] == user), key=lambda r: r[1])
        last = lambda i: [r[i] for r in own if r[i] is not None][-1]  # noqa: B023, E731
        want[user] = ([r[3] for r in own if r[3]][0], last(2), last(4))
    got = {r.userId: (r.gender, r.last_level, r.userAgent) for r in users.user_aggregates(log).collect()}
    assert got == want
    assert {r.userId: r.gender for r in users.first_profile(log).collect()} == {u: v[0] for u, v in want.items()}
    assert {r.userId: r.last_level for r in users.last_level(log).collect()} == {u: v[1] for u, v in want.items()}
    clean = cleaning.clean_log(log).orderBy("userId", "ts", "tie").collect()
    for user in (1, 2):
        own = [r for r in clean if r.userId == user]
        assert own[0].gender == want[user][0] and own[-1].userAgent == want[user][2]


def test_fill_against_pandas(spark):
    log = random_log(spark, seed=3)
    cols = ["location", "userAgent", "gender", "registration"]
    pdf = log.where("userId is not null").toPandas().sort_values(["userId", "ts", "tie"])
    pdf[cols] = pdf.groupby("userId")[cols].transform(lambda x: x.ffill().bfill())
    ours = cleaning.fill_profile(log, cols).toPandas().sort_values(["userId", "ts", "tie"])
    for c in cols:
        assert [None if x != x else x for x in ours[c]] == [None if x != x else x for x in pdf[c]]


def test_event_joins_keep_every_event(spark):
    log = random_log(spark)
    found = labels.events_of(log, labels.trigger_users(log))
    plain = log.join(labels.trigger_users(log), "userId", "left_semi")
    assert rows_of(found, *log.columns) == rows_of(plain, *log.columns)
    flags = labels.explicit_churn(log, "Submit Downgrade").where("userId % 3 <> 1")
    ours = labels.flag_events(log, flags)
    plain = log.where("userId is not null").join(flags, "userId", "left").na.fill(0, ["churn"])
    assert rows_of(ours, *log.columns, "churn") == rows_of(plain, *log.columns, "churn")


def test_label_is_monotone_in_threshold(spark):
    log = random_log(spark)
    counts = [
        churn_labels(log, timedelta(days=d)).where("churn = 1").count() for d in (5, 15, 30, 60)
    ]
    assert counts == sorted(counts, reverse=True)


def test_unseen_levels_are_counted_and_encoded_false(spark):
    df = spark.createDataFrame([(1, "x"), (2, "y"), (3, None), (4, "z")], "userId long, os string")
    levels = {"os": ["x", "y"]}
    encoded = {r.userId: (r.os_y, r.os_nan) for r in encoding.one_hot(df, levels).collect()}
    assert encoded == {1: (False, False), 2: (True, False), 3: (False, True), 4: (False, False)}
    assert encoding.unseen_levels(df, levels).collect()[0].unseen_rows == 1


def test_levels_are_sorted(spark):
    df = spark.createDataFrame([("iOS",), ("Windows",), (None,), ("Ubuntu",)], "os string")
    assert encoding.fit_levels(df, ["os"]) == {"os": ["Ubuntu", "Windows", "iOS"]}


def test_wide_categories_become_one_sparse_vector(spark):
    df = spark.range(3000).selectExpr("id", "concat('c', lpad(id % 2500, 4, '0')) city", "if(id % 3 = 0, null, 'x') kind")
    model = encoding.sparse_one_hot(("city", "kind")).fit(df)
    rows = {r.id: r.categories for r in model.transform(df).where("id in (0, 7, 2507)").collect()}
    assert rows[7].size == 2500 + 1 + 1 + 1 and rows[7] == rows[2507]
    assert rows[7].indices.tolist() == [7, 2501] and rows[0].indices.tolist() == [0, 2502]


def test_alignment_table_counts_rows(spark):
    df = spark.createDataFrame([(1, True, 2.0), (2, False, None), (3, None, 0.0)], "userId long, gender_Male boolean, `a b` double")
    got = {(r.column, r.status): r.rows for r in encoding.alignment_table(df, ["gender_M", "tenure"], ["userId"]).collect()}
    assert got == {("gender_M", "missing"): 3, ("tenure", "missing"): 3, ("gender_Male", "ignored"): 1, ("a b", "ignored"): 1}


def test_align_fills_missing_columns(spark):
    df = spark.createDataFrame([(1, True, None)], "userId long, gender_M boolean, tenure long")
    row = encoding.align(df, ["tenure", "gender_M", "os_Mac OS X"], ["userId"]).collect()[0]
    assert tuple(row) == (1, 0.0, 1.0, 0.0)
    report = encoding.alignment_report(df, ["tenure", "os_Mac OS X"], ["userId"])
    assert report == {"missing": ["os_Mac OS X"], "ignored": ["gender_M"]}


def test_json_source_and_csv_round_trip(spark, tmp_path):
    lines = tmp_path / "log.json"
    lines.write_text("\n".join(json.dumps(r) for r in raw_rows()))
    log = read_activity_log(spark, str(lines))
    table, _ = featurize(log)
    for fmt in ("csv", "parquet"):
        path = str(tmp_path / fmt)
        write_features(table, path, fmt)
        assert rows_of(read_features(spark, path, table.schema, fmt)) == rows_of(table)
    names = [c for c in table.columns if c not in ("userId", "churn")]
    save_feature_list(spark, names, str(tmp_path / "names"))
    assert load_feature_list(spark, str(tmp_path / "names")) == names


def test_text_user_ids_are_read(spark, tmp_path):
    rows = [dict(r, userId="" if r["userId"] is None else str(r["userId"])) for r in raw_rows()]
    (tmp_path / "log.json").write_text("\n".join(json.dumps(r) for r in rows))
    table = user_features(read_activity_log(spark, str(tmp_path / "log.json")))
    assert {r.userId: r.churn for r in table.collect()} == {u: v[0] for u, v in EXPECTED.items()}


def test_fanout_of_heavy_users_keeps_users_without_agents(spark):
    log = random_log(spark)
    people = users.last_interaction(log).unionByName(
        spark.sql("select 999L as userId, timestamp_ntz'2020-01-01' as last_ts")
    )
    plain = people.join(agents.distinct_user_agents(log), "userId", "left")
    found = agents.user_agent_fanout(people, log)
    assert rows_of(found, *plain.columns) == rows_of(plain)


def test_staging_uses_the_folder_the_cluster_names(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        assert staging.staging_root(spark) == named.rstrip("/")
    assert staging.staging_root(spark) == staging.staging_root(spark)

    class Unset:
        master = "spark://head:7077"
        conf = SimpleNamespace(get=lambda key, default=None: default)

        def getCheckpointDir(self):
            return None

    cluster = Unset()
    cluster.sparkContext = cluster
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        staging.staging_root(cluster)


def test_a_run_deletes_what_it_staged_and_nothing_else(spark):
    outside = staging.stage(spark.range(3))
    with staging.run(spark) as folder:
        inside = staging.stage(spark.range(4))
        with staging.run(spark):
            inner = staging.stage(spark.range(5)).inputFiles()[0]
        assert inside.count() == 4 and folder in inside.inputFiles()[0]
        path = inside.inputFiles()[0]
    assert outside.count() == 3
    for gone in (path, inner):
        with pytest.raises(Exception, match="PATH_NOT_FOUND"):
            spark.read.parquet(gone).count()


def test_missing_input_names_the_path(spark, tmp_path):
    with pytest.raises(MissingInput, match="nowhere"):
        read_activity_log(spark, str(tmp_path / "nowhere"))


def test_timestamps_do_not_depend_on_the_session_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        first = parse_log(raw_log(spark)).agg(F.min("ts").cast("string").alias("t")).collect()[0].t
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert first == "2018-10-01 00:00:00"


def test_empty_agent_is_unknown(spark):
    df = spark.createDataFrame([("",), ("curl/7",)], "userAgent string")
    found = {r.userAgent: (r.os, r.browser) for r in agents.agent_families(df).collect()}
    assert found == {"": ("Unknown", "Unknown"), "curl/7": ("Other", "Other")}


def test_feature_columns_are_stable(golden):
    assert tuple(user_features(golden).columns) == FEATURE_COLUMNS
    assert set(CATEGORICAL_COLUMNS) <= set(FEATURE_COLUMNS)
