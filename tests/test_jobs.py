import json

import pytest
from golden import raw_rows
from test_models import REQUEST

from stayline import jobs
from stayline.plans import model_search
from stayline.plans.monitoring import read_metrics
from stayline.sources.tables import load_levels, save_levels


@pytest.fixture(scope="module")
def raw_path(tmp_path_factory):
    """The golden users many times over under new ids, enough to fit a model."""
    folder = tmp_path_factory.mktemp("raw")
    lines = []
    for copy in range(30):
        for row in raw_rows():
            user = row["userId"]
            row = dict(row, userId=None if user is None else user + 100 * copy)
            row["length"] = row["length"] and row["length"] + copy
            lines.append(json.dumps(row))
    (folder / "log.json").write_text("\n".join(lines))
    return str(folder)


def test_jobs_end_to_end(spark, raw_path, tmp_path, capsys):
    at = lambda name: str(tmp_path / name)

    def run(*argv):
        return jobs.main(list(argv), spark)

    assert run("pages", "--log", raw_path) == 0
    assert "Submit Downgrade" in capsys.readouterr().out
    assert run("ingest", "--source", raw_path, "--log", at("log"), "--state", at("state")) == 0
    assert "360 events added" in capsys.readouterr().out
    for fmt, log in (("json", raw_path), ("parsed", at("log"))):
        done = run(
            "featurize", "--log", log, "--log-format", fmt,
            "--features", at(f"features_{fmt}"), "--levels", at("levels"),
        )
        assert done == 0
        assert "150 users" in capsys.readouterr().out
    first, second = (spark.read.parquet(at(f"features_{f}")) for f in ("json", "parsed"))
    assert first.exceptAll(second.select(*first.columns)).count() == 0
    again = run(
        "featurize", "--log", raw_path, "--use-levels", at("levels"), "--features", at("again"),
        "--format", "csv",
    )
    assert again == 0
    capsys.readouterr()

    features = at("features_json")
    assert run("search", "--features", features, "--trees", "3", "--rounds", "2", "--folds", "2",
               "--leaderboard", at("board"), "--models", at("found"), "--hold-out") == 0
    assert "best model" in capsys.readouterr().out
    board = spark.read.parquet(at("board"))
    assert board.count() == 5 and {"score_val", "score_test", "fit_time", "pred_time"} <= set(board.columns)
    found, weights = model_search.load_search(at("found"), spark)
    assert model_search.score_rows(found, first, weights).count() == 150
    assert run("train", "--features", features, "--trees", "5", "--model", at("model"),
               "--metrics", at("metrics"), "--curve", at("curve"), "--run", "r1",
               "--parameters", at("parameters")) == 0
    assert {r.run_id for r in read_metrics(spark, at("metrics")).collect()} == {"r1"}
    told = {r.name: r.value for r in spark.read.parquet(at("parameters")).collect()}
    assert told["trees"] == "5" and told["model_type"] == "forest"
    for _ in range(2):
        assert run("train", "--features", features, "--trees", "2", "--model", at("other"), "--metrics", at("metrics")) == 0
    assert read_metrics(spark, at("metrics")).select("run_id").distinct().count() == 3
    assert spark.read.parquet(at("curve")).count() > 0
    assert run("score", "--features", features, "--model", at("model"), "--scores", at("scores"),
               "--history", at("history"), "--day", "2024-05-01") == 0
    scores = spark.read.parquet(at("scores"))
    assert scores.count() == 150 and scores.where("error is not null").count() == 0
    assert spark.read.parquet(at("history")).where("day = date'2024-05-01'").count() == 150

    capsys.readouterr()
    (tmp_path / "requests.json").write_text(json.dumps(REQUEST) + "\n" + json.dumps({"tenure": 120}))
    assert run("score", "--requests", at("requests.json"), "--model", at("model"),
               "--scores", at("answers")) == 0
    assert "missing" in capsys.readouterr().out
    errors = [r.error for r in spark.read.parquet(at("answers")).collect()]
    assert sorted(errors, key=str) == ["Field required: total_songs", None]


def test_missing_log_is_reported(spark, tmp_path, capsys):
    code = jobs.main(["pages", "--log", str(tmp_path / "none")], spark)
    assert code == 1 and "none" in capsys.readouterr().err


def test_sparse_log_writes_nothing(spark, raw_path, tmp_path, capsys):
    target = tmp_path / "features"
    assert jobs.main(
        ["featurize", "--log", raw_path, "--days", "4000", "--features", str(target)], spark
    ) == 0
    assert "no churned users" in capsys.readouterr().out and not target.exists()


def test_levels_round_trip(spark, tmp_path):
    levels = {"os": ["Ubuntu", "iOS"], "gender": [], "browser": ["Chrome"]}
    save_levels(spark, levels, str(tmp_path / "levels"))
    assert load_levels(spark, str(tmp_path / "levels")) == levels


def test_state_jobs_give_the_features_of_the_log(spark, tmp_path):
    incoming = tmp_path / "in"
    incoming.mkdir()
    rows = raw_rows()
    for name, part in (("a", rows[::2]), ("b", rows[1::2])):
        (incoming / f"{name}.json").write_text("\n".join(json.dumps(r) for r in part) + "\n{broken\n")
        where = {n: str(tmp_path / n) for n in ("store", "state", "one", "two", "aside")}
        assert jobs.main(["fold", "--source", str(incoming), "--store", where["store"], "--state", where["state"]], spark) == 0
    assert jobs.main(["compact", "--store", where["store"], "--clean"], spark) == 0
    assert jobs.main(["featurize", "--log", where["store"], "--log-format", "state", "--features", where["one"]], spark) == 0
    assert jobs.main(["featurize", "--log", str(incoming), "--features", where["two"]], spark) == 1
    assert jobs.main(["featurize", "--log", str(incoming), "--quarantine", where["aside"], "--bad-share", "0.2", "--features", where["two"]], spark) == 0
    one, two = (spark.read.parquet(where[n]) for n in ("one", "two"))
    assert sorted(map(repr, one.collect())) == sorted(map(repr, two.collect())) != []
    assert spark.read.parquet(where["aside"]).count() == 2


def test_a_candidate_is_deployed_only_if_it_is_better(spark, tmp_path, capsys):
    from pyspark.sql import functions as F

    from stayline.plans import training

    at = lambda name: str(tmp_path / name)
    value = lambda name: F.pmod(F.hash("id", F.lit(name)), F.lit(100)).cast("double").alias(name)
    rows = spark.range(400).select(F.col("id").alias("userId"), value("a"), value("b"))
    rows = rows.withColumn("churn", (F.col("a") < 40).cast("int"))
    rows.write.parquet(at("rows"))
    for name, feature in (("poor", "b"), ("good", "a")):
        model, names, _, _ = training.train_random_forest(rows.select("userId", "churn", feature), trees=3, max_depth=3)
        training.save_model(model, names, at(name), spark)
    common = ["--features", at("rows"), "--serving", at("serving"), "--replicates", "30", "--decisions", at("decisions")]
    serving = lambda: training.load_model(at("serving"), spark)[1]
    for candidate, kept in (("poor", "b"), ("good", "a"), ("poor", "a"), ("good", "a")):
        assert jobs.main(["promote", "--candidate", at(candidate), *common], spark) == 0
        assert serving() == [kept]
    told = spark.read.parquet(at("decisions")).where("name = 'promote'").collect()
    assert sorted(r.value for r in told) == ["False", "False", "True", "True"]


def test_monitor_and_drift_jobs(spark, tmp_path, capsys):
    from datetime import date, timedelta

    at = lambda name: str(tmp_path / name)
    days = [(u, date(2024, 1, 1) + timedelta(days=d), 0.9 if u < (5 if d < 10 else 40) else 0.2) for d in range(12) for u in range(100)]
    spark.createDataFrame(days, "userId long, day date, score double").write.parquet(at("history"))
    assert jobs.main(["monitor", "--history", at("history"), "--alerts", at("alerts")], spark) == 0
    found = {r.day.day: (r.alert, r.shifted) for r in spark.read.parquet(at("alerts")).collect()}
    assert found[11] == ("up", True) and found[9] == (None, False)
    for name, shift in (("before", 0.0), ("after", 30.0)):
        spark.range(200).selectExpr("id AS userId", "id % 2 AS churn", f"CAST(id % 50 AS DOUBLE) + {shift} AS tenure", "CAST(id % 7 AS DOUBLE) AS num_sessions").write.parquet(at(name))
    assert jobs.main(["drift", "--before", at("before"), "--features", at("after"), "--report", at("report")], spark) == 0
    report = spark.read.parquet(at("report"))
    assert {r["feature"]: r["drifted"] for r in report.collect()} == {"tenure": True, "num_sessions": False}
