"""Steps whose cost must follow the rows, not rows times models, levels or replicates."""

from pyspark.sql import functions as F

from stayline import staging
from stayline.operators import encoding
from stayline.plans import model_search, training


def test_training_parts_grow_slower_than_rows():
    parts = [training.training_parts(n) for n in (0, 1, 12_000, 120_000, 720_000, 4_320_000)]
    assert parts == [1, 1, 1, 4, 9, 21]


def test_every_model_of_a_search_is_scored_in_a_job_of_its_own(spark, monkeypatch):
    plans = []

    def spy(df):
        plans.append(df._jdf.queryExecution().analyzed().toString())
        return staging.stage(df)

    monkeypatch.setattr(model_search, "stage", spy)
    table = spark.range(120).selectExpr("id userId", "cast(id % 3 = 0 as int) churn", "cast(id % 3 as double) a", "cast(id % 5 as double) b")
    offered = {name: model_search.candidates(3)[name] for name in ("RandomForestGini", "LogisticRegression")}
    with staging.run(spark) as folder:
        scores, seconds = model_search.out_of_fold(table, offered, folds=3)
        assert all(path.startswith(f"file://{folder}") or path.startswith(f"file:{folder}") for path in scores.inputFiles())
        assert {(r.model, r.n) for r in scores.groupBy("model").agg(F.count("score").alias("n")).collect()} == {(m, 120) for m in offered}
    scoring = [plan for plan in plans if "probability" in plan]
    assert len(scoring) == 6 and not any("Union" in plan for plan in scoring)
    assert set(seconds) == set(offered)


def test_sparse_places_cost_no_width(spark):
    # 20,000 levels: as dense rows these would be 20,000 times 20,002 doubles
    df = spark.range(20_000).select("id", F.format_string("%05d", "id").alias("name"), F.when(F.col("id") % 2 == 0, "x").alias("kind"))
    coded = encoding.sparse_one_hot(("kind", "name")).fit(df).transform(df)
    width, places = encoding.ones("categories")
    told = coded.select("id", width.alias("width"), places.alias("places"))
    assert "vector_to_array" not in told._jdf.queryExecution().optimizedPlan().toString()
    wrong = (F.col("width") != 20_003) | (F.col("places") != F.array((F.col("id") % 2).cast("int"), (F.col("id") + 2).cast("int")))
    assert told.where(wrong).count() == 0 and told.count() == 20_000
    # a short vector is stored densely
    few = spark.createDataFrame([(1, "a"), (2, None)], "id int, kind string")
    short = encoding.sparse_one_hot(("kind",)).fit(few).transform(few)
    width, places = encoding.ones("categories")
    assert sorted(short.select("id", width, places).collect()) == [(1, 2, [0]), (2, 2, [1])]
