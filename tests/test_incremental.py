import json
import random
from datetime import date, datetime, timedelta

import pytest
from golden import raw_rows
from logs import random_log, rows_of
from pyspark.sql import functions as F

from stayline.operators.state import daily_state, merged, users_of_state
from stayline.plans import featurize as feat
from stayline.plans import incremental
from stayline.sources.tables import (
    MalformedInput,
    MissingInput,
    read_activity_log,
    read_quarantine,
)
from stayline.streaming.ingest import ingest_new_logs, ingest_state, quarantined


def rounded(features):
    return rows_of(features.withColumn("total_listen_time", F.round("total_listen_time", 2)))


def split(log, seed, parts):
    """Batches that share days, users and sessions."""
    return [log.where(F.pmod(F.xxhash64("tie", F.lit(seed)), F.lit(parts)) == k) for k in range(parts)]


@pytest.fixture(scope="module")
def log(spark):
    return random_log(spark, seed=11).cache()


@pytest.fixture(scope="module")
def store(spark, log, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("state") / "store")
    for k, part in enumerate(split(log, 1, 4)):
        assert incremental.add_batch(part, path, f"b{k}")
    return path


@pytest.mark.parametrize("ua_mode", ["latest", "fanout"])
def test_any_split_gives_the_rows_of_the_whole_log(spark, log, store, ua_mode):
    got = incremental.user_features(incremental.read_state(spark, store), ua_mode=ua_mode)
    assert rounded(got) == rounded(feat.user_features(log, ua_mode=ua_mode))


def test_as_of_a_day_equals_the_log_cut_there(spark, log, store):
    days = [date(2020, 1, 4), date(2020, 1, 20), date(2020, 2, 10)]
    got = incremental.features_of_days(incremental.read_state(spark, store), days, timedelta(days=5))
    for day in days:
        cut = log.where(F.to_date("ts") <= F.lit(day))
        assert rounded(got.where(F.col("as_of") == F.lit(day)).drop("as_of")) == rounded(feat.user_features(cut, timedelta(days=5)))
    until = incremental.read_state(spark, store, days[1])
    assert rounded(incremental.user_features(until)) == rounded(feat.user_features(log.where(F.to_date("ts") <= F.lit(days[1]))))


def test_a_batch_counts_once_and_a_lost_run_does_not_count(spark, log, tmp_path):
    store = str(tmp_path / "store")
    first, second, third = split(log, 2, 3)
    assert incremental.add_batch(first, store, "first")
    # a run that was lost after writing, before its commit
    for name, table in daily_state(third).tables().items():
        table.write.parquet(f"{store}/{name}/batch=second")
    assert rounded(incremental.user_features(incremental.read_state(spark, store))) == rounded(feat.user_features(first))
    assert incremental.add_batch(second, store, "second")
    assert not incremental.add_batch(second, store, "second") and not incremental.add_batch(first, store, "first")
    both = first.unionByName(second)
    assert rounded(incremental.user_features(incremental.read_state(spark, store))) == rounded(feat.user_features(both))


def test_compaction_keeps_the_rows(spark, log, tmp_path):
    store, parts = str(tmp_path / "store"), split(log, 3, 3)
    for k in range(2):
        incremental.add_batch(parts[k], store, f"b{k}")
    incremental.compact(spark, store)
    incremental.add_batch(parts[2], store, "b2")
    assert not incremental.add_batch(parts[0], store, "b0")
    start = date(2020, 1, 25)
    incremental.compact(spark, store, before=start)
    incremental.clean(spark, store)
    known = incremental.commits(spark, store)
    assert len(known.live) == 1 and known.whole_days_from == start
    state = incremental.read_state(spark, store)
    assert state.folds.agg(F.min("day")).first()[0] == date(2020, 1, 24)
    assert rounded(incremental.user_features(state)) == rounded(feat.user_features(log))
    later = incremental.read_state(spark, store, start)
    assert rounded(incremental.user_features(later)) == rounded(feat.user_features(log.where(F.to_date("ts") <= F.lit(start))))
    with pytest.raises(ValueError, match="folded into one"):
        incremental.read_state(spark, store, date(2020, 1, 10))


def test_merging_twice_changes_nothing(spark, log):
    once = merged(daily_state(log))
    twice = merged(once)
    assert rows_of(once.folds) == rows_of(twice.folds) and rows_of(once.members) == rows_of(twice.members)


def test_sketched_counts(spark, store):
    state = incremental.read_state(spark, store)
    columns = ("userId", "num_artists", "num_sessions")
    assert rows_of(users_of_state(state, distinct="sketch"), *columns) == rows_of(users_of_state(state), *columns)
    with pytest.raises(ValueError):
        users_of_state(state, distinct="guess")


def test_error_of_sketches_of_many_values(spark):
    events = spark.range(60_000).select(
        (F.col("id") % 3).alias("userId"),
        F.timestamp_add("HOUR", (F.col("id") % 700).cast("int"), F.lit(datetime(2020, 1, 1)).cast("timestamp_ntz")).alias("ts"),
        F.concat(F.lit("a"), F.col("id") % 30_011).alias("artist"),
        (F.col("id") % 9_001).alias("sessionId"),
    )
    dated = events.withColumn("day", F.to_date("ts"))
    sketches = dated.groupBy("userId", "day").agg(F.hll_sketch_agg("artist", 12).alias("num_artists"), F.hll_sketch_agg(F.col("sessionId").cast("string"), 12).alias("num_sessions"))
    from stayline.operators.state import _estimated

    exact = {r.userId: r for r in events.groupBy("userId").agg(F.count_distinct("artist").alias("a"), F.count_distinct("sessionId").alias("s")).collect()}
    for r in _estimated(sketches).collect():
        assert abs(r.num_artists / exact[r.userId].a - 1) < 0.05 and abs(r.num_sessions / exact[r.userId].s - 1) < 0.05


def test_a_store_is_for_one_set_of_triggers(spark, log, store, tmp_path):
    with pytest.raises(ValueError, match="trigger pages"):
        incremental.add_batch(log, store, "other", triggers=("Home",))
    with pytest.raises(MissingInput):
        incremental.read_state(spark, str(tmp_path / "nothing"))


def write_lines(path, rows):
    path.write_text("".join((row if isinstance(row, str) else json.dumps(row)) + "\n" for row in rows))


def test_new_files_are_folded_once(spark, tmp_path):
    rows = raw_rows()
    random.Random(1).shuffle(rows)
    incoming, store, state = tmp_path / "in", str(tmp_path / "store"), str(tmp_path / "state")
    incoming.mkdir()
    write_lines(incoming / "a.json", rows[:5] + ["{broken"])
    assert len(ingest_state(spark, str(incoming), store, state)) == 1
    write_lines(incoming / "b.json", rows[5:])
    assert len(ingest_state(spark, str(incoming), store, state)) == 1
    assert ingest_state(spark, str(incoming), store, state) == []
    write_lines(tmp_path / "all.json", rows)
    whole = feat.user_features(read_activity_log(spark, str(tmp_path / "all.json")))
    assert rounded(incremental.user_features(incremental.read_state(spark, store))) == rounded(whole) != []
    assert [r.line for r in spark.read.parquet(f"{store}/quarantine").collect()] == ["{broken"]


BROKEN = [
    ('{"userId": 1, "ts": 15383', "unreadable"),
    ("not json", "unreadable"),
    ('{"userId": 2, "ts": "x", "auth": "Logged In"}', "wrong type"),
    ('{"userId": 2, "ts": 1538352000000, "length": "long"}', "wrong type"),
    ('{"userId": 3, "page": "Home"}', "no time"),
    ('{"userId": 4, "ts": 9007199254740992000}', "bad time"),
    ('{"userId": 4, "ts": 1538352000000, "registration": -9007199254740992000}', "bad time"),
]


def test_broken_lines_are_counted_and_kept(spark, tmp_path):
    path, aside = tmp_path / "log.json", str(tmp_path / "aside")
    write_lines(path, [*raw_rows(), *(line for line, _ in BROKEN), "", '{"userId": "", "ts": 1538352000000}'])
    with pytest.raises(MalformedInput, match="7 of 20 lines.*unreadable"):
        read_activity_log(spark, str(path))
    log = read_activity_log(spark, str(path), quarantine=aside, limit=0.5)
    assert log.count() == 13 and log.where("ts IS NULL").isEmpty()
    got = read_quarantine(spark, aside).collect()
    assert sorted(r.reason for r in got) == sorted(reason for _, reason in BROKEN)
    assert {r.line for r in got if r.reason in ("unreadable", "wrong type")} == {line for line, reason in BROKEN if reason in ("unreadable", "wrong type")}
    assert json.loads(next(r.line for r in got if r.reason == "no time")) == {"userId": "3", "page": "Home"}
    # a mended line is a line like any other
    mended = tmp_path / "mended.json"
    write_lines(mended, [r.line.replace('"x"', "1538352000001") for r in got if '"x"' in r.line])
    assert read_activity_log(spark, str(mended)).count() == 1


def test_an_empty_log(spark, tmp_path):
    (tmp_path / "log.json").write_text("")
    assert read_activity_log(spark, str(tmp_path / "log.json")).count() == 0


def test_ingest_keeps_broken_lines_once(spark, tmp_path):
    incoming, args = tmp_path / "in", [str(tmp_path / n) for n in ("in", "log", "state")]
    incoming.mkdir()
    write_lines(incoming / "a.json", [*raw_rows(), BROKEN[0][0], BROKEN[2][0]])
    assert ingest_new_logs(spark, *args) == 12 and ingest_new_logs(spark, *args) == 0
    write_lines(incoming / "b.json", [BROKEN[4][0]])
    assert ingest_new_logs(spark, *args) == 0
    assert sorted(r.reason for r in quarantined(spark, args[2]).collect()) == ["no time", "unreadable", "wrong type"]
