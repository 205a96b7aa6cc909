"""Training and scoring of binary classifiers on tables."""

from __future__ import annotations

import json
import random
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LinearSVC,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    RandomForestClassifier,
)
from pyspark.ml.feature import Imputer, OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.scratch import durable
from . import encodings as E
from . import evaluate as V

PARALLEL_FITS = 1  # fits that run side by side; worth raising where executors would idle

TEXT_NUMERICS = ["n_chars", "n_words", "n_lines", "digit_share", "upper_share", "mark_share", "mean_word"]
TEXT_CATEGORIES = ["lang", "source"]


def text_frame(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Labelled documents with numbers read off their whole text by built-in functions.

    The numbers are made before the join, so no text is shuffled.
    """
    text = F.col("text")
    n = F.greatest(F.length(text), F.lit(1))
    without = lambda pattern: (F.length(text) - F.length(F.regexp_replace(text, pattern, ""))) / n
    words = F.size(F.split(text, r"\s+"))
    rows = documents.select("doc_id", "lang", "source", "text").select(
        "doc_id",
        "lang",
        "source",
        F.length(text).cast("double").alias("n_chars"),
        words.cast("double").alias("n_words"),
        F.size(F.split(text, "\n")).cast("double").alias("n_lines"),
        without("[0-9]").alias("digit_share"),
        without("[A-Z]").alias("upper_share"),
        without(r"[^\p{L}0-9\s]").alias("mark_share"),
        (n / words).alias("mean_word"),
    )
    return labels.join(rows, "doc_id")


def weight_column(counts: dict[int, int], label: str) -> Column:
    """The balanced weight n / (2 n_c) as an expression over the two known class sizes."""
    n = sum(counts.values())
    return F.when(F.col(label) == 1, F.lit(n / (2 * max(counts.get(1, 0), 1)))).otherwise(F.lit(n / (2 * max(counts.get(0, 0), 1))))


def with_class_weight(df: DataFrame, label: str, name: str = "weight") -> DataFrame:
    """Balanced weights from one counting pass; every later pass of a learner only evaluates an expression."""
    counts = {int(r[label]): r["count"] for r in df.groupBy(label).count().collect()}
    return df.withColumn(name, weight_column(counts, label))


def with_fold_class_weight(df: DataFrame, label: str, fold: str, name: str = "weight") -> DataFrame:
    """Balanced weights of each fold by its own rows: with two folds, those of the training rows alone."""
    counts = {(r[fold], int(r[label])): r["count"] for r in df.groupBy(fold, label).count().collect()}
    total = {f: sum(n for (g, _), n in counts.items() if g == f) for f, _ in counts}
    weight = F.lit(1.0)
    for (f, y), n in counts.items():
        weight = F.when((F.col(fold) == f) & (F.col(label) == y), total[f] / (2 * n)).otherwise(weight)
    return df.withColumn(name, weight)


def preparation(numerics: list[str], categories: list[str], scale: bool = True, one_hot: bool = True) -> list:
    """Stages that turn columns into one vector: impute, index, encode, assemble, scale."""
    stages = [Imputer(inputCols=numerics, outputCols=[f"{c}_filled" for c in numerics], strategy="median")]
    parts = [f"{c}_filled" for c in numerics]
    if categories:
        indexed = [f"{c}_index" for c in categories]
        stages.append(StringIndexer(inputCols=categories, outputCols=indexed, handleInvalid="keep"))
        if one_hot:
            encoded = [f"{c}_hot" for c in categories]
            stages.append(OneHotEncoder(inputCols=indexed, outputCols=encoded, dropLast=False))
            parts += encoded
        else:
            parts += indexed
    stages.append(VectorAssembler(inputCols=parts, outputCol="raw" if scale else "features", handleInvalid="keep"))
    if scale:
        stages.append(StandardScaler(inputCol="raw", outputCol="features", withMean=False))
    return stages


def pipeline(numerics, categories, learner: Estimator, scale: bool = True, one_hot: bool = True) -> Pipeline:
    return Pipeline(stages=[*preparation(numerics, categories, scale, one_hot), learner])


def logistic_pipeline(numerics, categories, label: str, max_iter: int = 30, reg: float = 0.01, weight: str | None = "weight") -> Pipeline:
    lr = LogisticRegression(labelCol=label, maxIter=max_iter, regParam=reg)
    return pipeline(numerics, categories, lr.setWeightCol(weight) if weight else lr)


class TreePipeline(Pipeline):
    """A pipeline whose last stage is a tree learner: it gets as many bins as the largest category has levels."""

    def _fit(self, df: DataFrame) -> PipelineModel:
        *before, learner = self.getStages()
        names = [c for stage in before if isinstance(stage, StringIndexer) for c in stage.getInputCols()]
        if names:
            most = max(df.agg(*[F.count_distinct(c).alias(c) for c in names]).head())
            learner = learner.copy()
            learner.setMaxBins(max(learner.getMaxBins(), most + 2))
        return Pipeline(stages=[*before, learner]).fit(df)


def tree_learner(numerics, categories, learner: Estimator) -> Pipeline:
    return TreePipeline(stages=[*preparation(numerics, categories, scale=False, one_hot=False), learner])


def tree_pipeline(numerics, categories, label: str, depth: int = 5) -> Pipeline:
    tree = DecisionTreeClassifier(labelCol=label, maxDepth=depth, maxBins=64, weightCol="weight", seed=42)
    return tree_learner(numerics, categories, tree)


def forest_pipeline(numerics, categories, label: str, trees: int = 20, depth: int = 5) -> Pipeline:
    forest = RandomForestClassifier(labelCol=label, numTrees=trees, maxDepth=depth, maxBins=64, weightCol="weight", seed=42)
    return tree_learner(numerics, categories, forest)


def boosted_pipeline(numerics, categories, label: str, rounds: int = 10, depth: int = 3, rate: float = 0.2, validation: str | None = None) -> Pipeline:
    """Boosted trees; categories enter as indexed levels. With ``validation`` (a boolean column) training stops early."""
    gbt = GBTClassifier(
        labelCol=label, maxIter=rounds, maxDepth=depth, stepSize=rate, subsamplingRate=0.8, maxBins=64, weightCol="weight", seed=42
    )
    if validation:
        gbt = gbt.setValidationIndicatorCol(validation)
    return tree_learner(numerics, categories, gbt)


def boosted_on_categories(
    train: DataFrame, rows: DataFrame, numerics: list[str], categories: list[str], label: str, key: str, watch: str, rounds: int = 10, **settings
) -> DataFrame:
    """``rows`` scored by boosted trees on raw categories (adds ``probability``); training stops early on the ``watch`` rows of ``train``.

    Categories become ordered target statistics: a row that is learned from sees only the rows before it, the others
    see all rows that are learned from. So there is no limit on levels, and no level needs a column or a bin.
    """
    learned, watched = train.filter(~F.col(watch)), train.filter(watch)
    table = E.target_statistics(learned, categories, label)
    encoded = E.ordered_statistics(learned, categories, label, key).unionByName(E.apply_statistics(watched, categories, key, table))
    inputs = [*numerics, *[f"{c}_ts" for c in categories]]
    model = boosted_pipeline(inputs, [], label, rounds, validation=watch, **settings).fit(durable(encoded))
    return model.transform(E.apply_statistics(rows, categories, key, table))


def network_pipeline(numerics, label: str, hidden: int = 8, max_iter: int = 40) -> Pipeline:
    net = MultilayerPerceptronClassifier(labelCol=label, layers=[len(numerics), hidden, 2], maxIter=max_iter, seed=42)
    return pipeline(numerics, [], net)


def linear_pipeline(numerics, categories, label: str, max_iter: int = 20) -> Pipeline:
    return pipeline(numerics, categories, LinearSVC(labelCol=label, maxIter=max_iter, regParam=0.01, weightCol="weight"))


def scores(predicted: DataFrame, *keep: str) -> DataFrame:
    """The kept columns and ``score``, the probability of the positive class."""
    return predicted.select(*keep, vector_to_array("probability")[1].alias("score"))


def save_bundle(model: PipelineModel, path: str, **settings) -> str:
    """The fitted pipeline, and its settings as a side table."""
    model.write().overwrite().save(f"{path}/model")
    spark = SparkSession.active()
    rows = [(k, json.dumps(v)) for k, v in settings.items()]
    spark.createDataFrame(rows, "name string, setting string").write.mode("overwrite").parquet(f"{path}/settings")
    return path


def load_bundle(spark: SparkSession, path: str):
    """(model, threshold) of a saved bundle."""
    settings = {r.name: json.loads(r.setting) for r in spark.read.parquet(f"{path}/settings").collect()}
    return PipelineModel.load(f"{path}/model"), settings.get("threshold")


def cross_validated(df: DataFrame, key: str, label: str, fold: str, k: int, models: dict[str, Callable[[], Pipeline]]) -> DataFrame:
    """Out-of-fold scores, one row per (model, key). Everything is fitted on the other folds only.

    ``PARALLEL_FITS`` models are fitted side by side. The scores are written once, so what follows does not
    score again.
    """
    sizes = {(r[fold], int(r[label])): r["count"] for r in df.groupBy(fold, label).count().collect()}

    def one(job):
        i, name, make = job
        counts = {c: sum(n for (f, y), n in sizes.items() if f != i and y == c) for c in (0, 1)}
        train = df.filter(F.col(fold) != i).withColumn("weight", weight_column(counts, label))
        held = make().fit(train).transform(df.filter(F.col(fold) == i))
        return scores(held, key, label, fold).select(F.lit(name).alias("model"), "*")

    jobs = [(i, name, make) for i in range(k) for name, make in models.items()]
    with ThreadPoolExecutor(PARALLEL_FITS) as pool:
        parts = list(pool.map(inheritable_thread_target(df.sparkSession)(one), jobs))
    return durable(reduce(lambda a, b: a.unionByName(b), parts))


def fold_metrics(oof: DataFrame, label: str, keys: Iterable[str] = ("model", "fold")) -> DataFrame:
    """ROC-AUC and average precision of every (model, fold) in one job."""
    keys = list(keys)
    return V.auc_ap(V.score_curve(oof, "score", label, keys), keys)


def summary(metrics: DataFrame, by: list[str]) -> DataFrame:
    x = "roc_auc"
    return metrics.groupBy(*by).agg(
        F.count(x).alias("folds"), F.avg(x).alias("mean"), F.stddev_samp(x).alias("std"), F.min(x).alias("lo"), F.max(x).alias("hi")
    )


def sampled_settings(space: dict[str, tuple], n: int, seed: int = 42) -> list[dict]:
    """Random settings: a list is drawn from, a pair of floats is drawn log-uniformly between its ends."""
    draw = random.Random(seed)
    out = []
    for _ in range(n):
        one = {}
        for name, choice in space.items():
            if isinstance(choice, tuple):
                low, high = choice
                one[name] = low * (high / low) ** draw.random()
            else:
                one[name] = draw.choice(choice)
        out.append(one)
    return out
