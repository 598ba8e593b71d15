"""MLlib pipelines: category-id forest, cross-validated flow classifier, and the
other estimators the analyses import (regression forest, k-means with its
silhouette, frequent item sets, ALS, linear models, boosted trees).

Fits run on executors (tree aggregation); only split decisions and model
parameters live on the driver.  Splits are keyed on a hash of row content, so a
re-run on the same data gives the same train/test rows on any partitioning.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import StandardScaler, StringIndexer, VectorAssembler, VectorIndexer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


# Fixed values used as defaults below: the id forest's seed (2020) and bin
# budget source (10,000 categories); the flow forest's depth 5 and seed 143,
# its 70/30 split and the depth grid 4, 8, 12 scored by 3-fold accuracy.


def split_by_hash(df: DataFrame, train_share: float, *cols: str, seed: int = 143):
    """Deterministic split on ``xxhash64(seed, cols)`` instead of ``randomSplit``."""
    h = F.pmod(F.xxhash64(F.lit(seed), *[F.col(c) for c in cols]), F.lit(10_000))
    cut = int(train_share * 10_000)
    return df.filter(h < cut), df.filter(h >= cut)


def feature_columns(df: DataFrame, words: Sequence[str] = ("mean", "std")) -> list[str]:
    """Columns whose name holds one of ``words`` (case-insensitive)."""
    return [c for c in df.columns if any(w in c.lower() for w in words)]


# ------------------------------------------------------------- category forest
def predict_class(train: DataFrame, new: DataFrame,
                  features: Sequence[str] = ("PULocationID", "DOLocationID"),
                  label: str = "payment_type", keep: Sequence[str] = (),
                  max_categories: int = 10_000, seed: int = 2020) -> DataFrame:
    """Random-forest class of each row of ``new`` from categorical id features.

    Both frames are cast the same way; ids unseen in training are kept as an
    extra category instead of failing; ``maxBins`` is raised to the largest
    category count the fitted indexer found (plus one for unseen ids), so every
    category stays usable.  Runs the indexer and forest fit jobs; prediction
    stays lazy.
    """
    feats = list(features)
    extra = [k for k in keep if k not in feats]
    cast = lambda d: d.select(*extra, *[F.col(c).cast("double").alias(c) for c in feats],
                              *([F.col(label).cast("int").alias(label)] if label in d.columns else []))
    assembler = VectorAssembler(inputCols=feats, outputCol="features", handleInvalid="keep")
    train_rows = assembler.transform(cast(train).dropna(subset=feats + [label])).select("features", label)
    train_rows = train_rows.cache()  # read by the indexer fit and by every tree level
    try:
        indexer = VectorIndexer(maxCategories=max_categories, inputCol="features",
                                outputCol="features_indexed", handleInvalid="keep").fit(train_rows)
        widest = max([len(m) for m in indexer.categoryMaps.values()] or [2])
        forest = RandomForestClassifier(featuresCol="features_indexed", labelCol=label,
                                        maxBins=max(32, widest + 2), seed=seed)
        fitted = forest.fit(indexer.transform(train_rows))
    finally:
        train_rows.unpersist()
    model = PipelineModel(stages=[assembler, indexer, fitted])
    return model.transform(cast(new)).select(
        *extra, *[F.col(c).cast("int").alias(c) for c in feats if c in keep],
        F.col("prediction").cast("int").alias("prediction"))


# ------------------------------------------------------ cross-validated forest
def _fold_scores(train: DataFrame, prepare: Pipeline, forest: RandomForestClassifier, depths: Sequence[int],
                 evaluator: MulticlassClassificationEvaluator, folds: int, seed: int) -> dict[int, float]:
    """Mean score of each depth over ``folds`` folds, which a seeded ``rand`` parts as ``CrossValidator`` does.

    A fold's rows are prepared once for all depths, and depths are fitted one
    after another: a fit holds its binned rows with a count for every tree, and
    several at once would push each other out of memory.
    """
    scores = dict.fromkeys(depths, 0.0)
    drawn = train.withColumn("__fold", F.rand(seed))
    for i in range(folds):
        here = (F.col("__fold") >= i / folds) & (F.col("__fold") < (i + 1) / folds)
        prepared = prepare.fit(drawn.filter(~here))
        fit_rows, check_rows = (prepared.transform(drawn.filter(c)).select("features_scaled", "label_idx").cache() for c in (~here, here))
        try:
            for d in depths:
                fitted = forest.copy({forest.maxDepth: d}).fit(fit_rows)
                scores[d] += evaluator.evaluate(fitted.transform(check_rows)) / folds
        finally:
            fit_rows.unpersist()
            check_rows.unpersist()
    return scores


def tune_forest(df: DataFrame, features: Sequence[str] | None = None, label: str = "Label",
                depths: Sequence[int] = (4, 8, 12), folds: int = 3, seed: int = 143,
                train_share: float = 0.7, header_value: str | None = "Label") -> DataFrame:
    """Scale + index + random forest, depth chosen by k-fold CV on accuracy.

    Returns rows ``(param, value)``: the best forest's parameters and a final
    ``test_accuracy`` row and
    ``dropped_rows``, the rows with an unreadable feature or no label.  Repeated header rows (``label == header_value``)
    are dropped; numeric text is read with ``try_cast``.
    """
    spark = df.sparkSession
    feats = list(features) if features else feature_columns(df)
    data = df.filter(F.col(label) != header_value) if header_value is not None else df
    data = data.select(*[F.col(f"`{c}`").try_cast("double").alias(c) for c in feats],
                       F.col(label).alias("Label"))
    incomplete = reduce(or_, [F.col(f"`{c}`").isNull() for c in [*feats, "Label"]])
    dropped = data.filter(incomplete).count()
    data = data.dropna()
    train, test = split_by_hash(data, train_share, *feats, "Label", seed=seed)
    train, test = train.cache(), test.cache()
    try:
        forest = RandomForestClassifier(maxDepth=5, seed=seed, featuresCol="features_scaled",
                                        labelCol="label_idx", predictionCol="prediction")
        prepare = Pipeline(stages=[
            VectorAssembler(inputCols=feats, outputCol="features"),
            StringIndexer(inputCol="Label", outputCol="label_idx"),
            StandardScaler(inputCol="features", outputCol="features_scaled"),
        ])
        evaluator = MulticlassClassificationEvaluator(labelCol="label_idx", predictionCol="prediction",
                                                      metricName="accuracy")
        scores = _fold_scores(train, prepare, forest, depths, evaluator, folds, seed)
        depth = max(depths, key=lambda d: scores[d])  # ties: the first
        prepared = prepare.fit(train)
        model = PipelineModel([prepared, forest.copy({forest.maxDepth: depth}).fit(prepared.transform(train))])
        accuracy = evaluator.evaluate(model.transform(test))
        best = model.stages[-1]
        rows = [(p.name, str(v)) for p, v in sorted(best.extractParamMap().items(), key=lambda kv: kv[0].name)]
        rows.append(("test_accuracy", repr(float(accuracy))))
        rows.append(("dropped_rows", str(dropped)))
    finally:
        train.unpersist()
        test.unpersist()
    return spark.createDataFrame(rows, "param string, value string")


# ------------------------------------------------- other estimators (thin jobs)
def regression_forest(df: DataFrame, features: Sequence[str], label: str, seed: int = 2020):
    from pyspark.ml.regression import RandomForestRegressor
    vec = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="skip")
    model = Pipeline(stages=[vec, RandomForestRegressor(labelCol=label, seed=seed)]).fit(df)
    return model


def kmeans_silhouette(df: DataFrame, features: Sequence[str] | str, k: int = 3, seed: int = 1):
    """K-means model and the silhouette of its clustering.

    ``features`` is a list of numeric columns, or the name of one array column
    (turned into dense vectors with ``array_to_vector``).
    """
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.evaluation import ClusteringEvaluator
    if isinstance(features, str):
        from pyspark.ml.functions import array_to_vector
        data = df.filter(F.col(features).isNotNull()).withColumn("features", array_to_vector(features))
    else:
        vec = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="skip")
        data = vec.transform(df)
    model = KMeans(k=k, seed=seed).fit(data)
    score = ClusteringEvaluator().evaluate(model.transform(data))
    return model, score


def frequent_itemsets(df: DataFrame, basket: str, item: str, min_support: float = 0.01,
                      min_confidence: float = 0.5):
    """FP-growth over baskets built with ``collect_set`` (a basket is one group's items)."""
    from pyspark.ml.fpm import FPGrowth
    baskets = df.groupBy(basket).agg(F.collect_set(item).alias("items"))
    return FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(baskets)


def recommend(df: DataFrame, user: str, item: str, rating: str, rank: int = 10, seed: int = 1):
    from pyspark.ml.recommendation import ALS
    return ALS(userCol=user, itemCol=item, ratingCol=rating, rank=rank, seed=seed,
               coldStartStrategy="drop").fit(df)


def linear_classifier(df: DataFrame, features: Sequence[str], label: str, kind: str = "logistic"):
    """Logistic regression, linear SVM (one-vs-rest) or boosted trees (two classes only)."""
    from pyspark.ml.classification import GBTClassifier, LinearSVC, LogisticRegression, OneVsRest
    est = {"logistic": LogisticRegression(labelCol="label_idx"),
           "svm": OneVsRest(classifier=LinearSVC(), labelCol="label_idx"),
           "gbt": GBTClassifier(labelCol="label_idx")}[kind]
    pipe = Pipeline(stages=[VectorAssembler(inputCols=list(features), outputCol="features",
                                            handleInvalid="skip"),
                            StringIndexer(inputCol=label, outputCol="label_idx"), est])
    return pipe.fit(df)


def save_model(model, path: str) -> None:
    model.write().overwrite().save(path)


def load_pipeline(path: str):
    return PipelineModel.load(path)
