"""Model pipelines: shapes, determinism, accuracy above chance."""

from pyspark.sql import functions as F

from tablecraft.operators import ml
from tablecraft.operators.stats import chance_criterion
from tablecraft.plans import queries
from tablecraft.sources import fixtures as FX


def test_predict_class_on_separable_ids(spark, sf_dir):
    trips = FX.trips(spark, sf_dir)
    train, new = ml.split_by_hash(trips, 0.7, "PULocationID", "DOLocationID", "lpep_pickup_datetime")
    out = ml.predict_class(train, new, keep=("PULocationID", "DOLocationID"))
    assert out.count() == new.count()
    truth = out.withColumn("want", (F.lit(1) + F.col("PULocationID") % 2))
    acc = truth.agg(F.avg((F.col("want") == F.col("prediction")).cast("double"))).first()[0]
    assert acc > 1.25 * 0.5  # two balanced classes: chance is 0.5


def test_split_by_hash_is_deterministic(spark, sf_dir):
    trips = FX.trips(spark, sf_dir)
    a, _ = ml.split_by_hash(trips, 0.7, "PULocationID", "lpep_pickup_datetime")
    b, _ = ml.split_by_hash(trips.repartition(3), 0.7, "PULocationID", "lpep_pickup_datetime")
    assert a.count() == b.count()


def test_tune_forest_beats_chance(spark, sf_dir):
    flows = FX.flows(spark, sf_dir)
    rows = {r["param"]: r["value"] for r in ml.tune_forest(flows, depths=(2, 4), folds=2).collect()}
    assert rows["maxDepth"] in ("2", "4")
    pcc = chance_criterion(flows).first()["pcc"]
    assert float(rows["test_accuracy"]) > 1.25 * pcc


def test_feature_columns_rule():
    class D:
        columns = ["Fwd Mean", "Flow Bytes", "Bwd STD", "Label"]
    assert ml.feature_columns(D()) == ["Fwd Mean", "Bwd STD"]


def test_registered_ml_queries_exist():
    assert {"predict_class", "tune_forest"} <= set(queries())


def test_other_estimators_run(spark, sf_dir, tmp_path):
    from tablecraft.sources.tables import read_table
    emb = read_table(spark, sf_dir, "embeddings")
    model, score = ml.kmeans_silhouette(emb, "embedding", k=3)
    assert len(model.clusterCenters()) == 3 and -1.0 <= score <= 1.0

    tweets = FX.tweets(spark, sf_dir).select("id", F.explode("entities.hashtags.text").alias("tag"))
    fp = ml.frequent_itemsets(tweets, "id", "tag", min_support=0.05)
    assert fp.freqItemsets.count() > 0

    ev = read_table(spark, sf_dir, "events")
    ratings = (ev.groupBy("user_id", F.length("event_type").alias("item"))
               .agg(F.count(F.lit(1)).cast("float").alias("rating")))
    als = ml.recommend(ratings, "user_id", "item", "rating", rank=2)
    assert als.transform(ratings).count() > 0

    trips = FX.trips(spark, sf_dir).dropna(subset=["fare_amount"])
    reg = ml.regression_forest(trips, ["tolls_amount", "extra"], "fare_amount")
    path = str(tmp_path / "model")
    ml.save_model(reg, path)
    again = ml.load_pipeline(path)
    assert again.transform(trips).select("prediction").count() == trips.count()

    flows = FX.flows(spark, sf_dir).filter(F.col("Label") != "Label")
    flows = flows.select(F.col("`Fwd Mean`").cast("double").alias("fwd"),
                         F.col("`Bwd Mean`").cast("double").alias("bwd"), "Label")
    two = flows.filter(F.col("Label") != "N")
    for kind, rows in (("logistic", flows), ("svm", flows), ("gbt", two)):
        fitted = ml.linear_classifier(rows, ["fwd", "bwd"], "Label", kind=kind)
        assert fitted.transform(rows).count() == rows.count()


def test_folds_are_prepared_once_and_scored_as_by_cross_validator(spark, sf_dir, monkeypatch):
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator
    from pyspark.ml.feature import StringIndexer, VectorAssembler
    from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
    rows = spark.range(400).select((F.col("id") % 20).cast("double").alias("a"), (F.col("id") % 7).cast("double").alias("b"),
                                   F.when(F.col("id") % 20 + F.col("id") % 3 > 11, "u").otherwise("v").alias("Label"))
    prepare = Pipeline(stages=[VectorAssembler(inputCols=["a", "b"], outputCol="features_scaled"), StringIndexer(inputCol="Label", outputCol="label_idx")])
    forest = RandomForestClassifier(seed=1, featuresCol="features_scaled", labelCol="label_idx")
    evaluator = MulticlassClassificationEvaluator(labelCol="label_idx", metricName="accuracy")
    grid = ParamGridBuilder().addGrid(forest.maxDepth, [1, 4]).build()
    whole = CrossValidator(estimator=Pipeline(stages=[*prepare.getStages(), forest]), estimatorParamMaps=grid, evaluator=evaluator,
                           numFolds=3, seed=5).fit(rows)
    fits, fit = [], StringIndexer._fit

    def counted(self, data):
        fits.append(1)
        return fit(self, data)
    monkeypatch.setattr(StringIndexer, "_fit", counted)
    scores = ml._fold_scores(rows, prepare, forest, [1, 4], evaluator, 3, 5)
    assert [round(scores[d], 12) for d in (1, 4)] == [round(m, 12) for m in whole.avgMetrics]
    assert len(fits) == 3
