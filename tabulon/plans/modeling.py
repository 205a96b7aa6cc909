"""Splits, preprocessing, models and model experiments."""

import numpy as np
from pyspark.ml.evaluation import BinaryClassificationEvaluator, ClusteringEvaluator
from pyspark.ml.feature import PCA, PolynomialExpansion, StandardScaler, UnivariateFeatureSelector, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators import batched as B
from ..operators import cluster as K
from ..operators import encodings as E
from ..operators import evaluate as V
from ..operators import features as X
from ..operators import models as M
from ..operators import outliers as O
from ..operators import preprocess as P
from ..operators import profile as Prof
from ..operators import splits as Sp
from ..operators.ordered import Ordered, ordered, stable_hash
from ..operators.perceptron import fit_perceptron
from ..registry import query
from ..sources import tables as Io
from ..sources.scratch import durable, scratch_path
from . import standins as S

R = F.round
NUM, CAT, Y = M.TEXT_NUMERICS, M.TEXT_CATEGORIES, "quality"


def frame(t):
    """Labelled documents with features and a split, written once because models read it many times."""
    return durable(M.text_frame(t.documents, Sp.stratified_split(t.labels, "doc_id", Y).select("doc_id", Y, "split")))


def folded(t, k=3):
    return durable(M.text_frame(t.documents, Sp.stratified_folds(t.labels, "doc_id", Y, k).select("doc_id", Y, "fold")))


@query("mlb1")
def split_rows(t):
    return Sp.stratified_split(t.labels, "doc_id", Y).select("doc_id", Y, "split")


@query("mlb2")
def fold_rows(t):
    out = t.labels.select("doc_id", Y)
    for seed in (42, 123, 2024):
        out = Sp.stratified_folds(out, "doc_id", Y, 5, seed, f"fold_{seed}")
    return out


NULLED = """SELECT o_orderkey, nullif(o_orderpriority, '5-LOW') AS priority, CASE WHEN o_totalprice > 100000 THEN o_totalprice END AS total, nullif(o_custkey % 20, 7) AS code FROM orders"""


def nulled(t):
    return t.orders.select(
        "o_orderkey",
        F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("priority"),
        F.when(F.col("o_totalprice") > 100000, F.col("o_totalprice")).alias("total"),
        F.nullif(F.col("o_custkey") % 20, F.lit(7)).cast("double").alias("code"),
    )


@query(
    "mlb3",
    f"""WITH x AS ({NULLED}) SELECT o_orderkey, round(coalesce(total, (SELECT median(total) FROM x)), 6) AS total, CAST(total IS NULL AS INTEGER) AS "total_MISSING",
        coalesce(CAST(code AS DOUBLE), (SELECT median(code) FROM x)) AS code, CAST(code IS NULL AS INTEGER) AS "code_MISSING" FROM x""",
)
def median_imputation(t):
    df = nulled(t).drop("priority")
    out = P.Filler(P.medians(df, ["total", "code"]), flags=True).transform(df)
    return out.withColumn("total", R("total", 6))


@query(
    "mlb4",
    f"""WITH x AS ({NULLED}) SELECT o_orderkey, coalesce(priority, (SELECT priority FROM x WHERE priority IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)) AS by_mode, coalesce(priority, 'missing') AS by_constant FROM x""",
)
def mode_imputation(t):
    df = nulled(t).select("o_orderkey", F.col("priority").alias("by_mode"), F.col("priority").alias("by_constant"))
    return P.Filler({**P.modes(df, ["by_mode"]), "by_constant": "missing"}).transform(df)


@query(
    "mlb5",
    """WITH tr AS (SELECT * FROM orders WHERE o_custkey % 3 <> 0) SELECT o_orderkey, round((o_totalprice - (SELECT avg(o_totalprice) FROM tr)) / (SELECT stddev_pop(o_totalprice) FROM tr), 8) + 0 AS z FROM orders""",
)
def standard_scaling(t):
    df = t.orders.select("o_orderkey", F.col("o_totalprice").alias("z"), "o_custkey")
    scaler = P.fit_scaler(df.filter("o_custkey % 3 <> 0"), ["z"])
    return scaler.transform(df).select("o_orderkey", R("z", 8).alias("z"))


@query(
    "mlb6",
    """WITH c AS (SELECT p_brand AS level, count(*) AS n FROM part GROUP BY 1), k AS (SELECT level FROM c WHERE n >= 3 ORDER BY n DESC, level LIMIT 14)
       SELECT level, n, CASE WHEN level IN (SELECT level FROM k) THEN level ELSE 'infrequent' END AS grouped FROM c""",
)
def rare_levels(t):
    return P.level_map(t.part, "p_brand", min_frequency=3, max_levels=15)


@query("mlb6_one_hot")
def one_hot(t):
    train = t.part.filter("p_partkey % 2 = 0")
    return P.fit_one_hot(train, "p_brand", min_frequency=3, max_levels=15).transform(t.part.select("p_partkey", "p_brand"))


@query("mlb7")
def fold_safe_pipeline(t):
    return M.fold_metrics(M.cross_validated(folded(t), "doc_id", Y, "fold", 3, {"logistic": lambda: M.logistic_pipeline(NUM, CAT, Y, 15)}), Y)


@query(
    "mlb8",
    """SELECT doc_id, round((SELECT avg(quality) FROM labels WHERE doc_id % 3 <> 0), 10) AS prior, CAST((SELECT quality FROM labels WHERE doc_id % 3 <> 0 GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS INTEGER) AS majority
       FROM labels WHERE doc_id % 3 = 0""",
)
def baselines(t):
    train, valid = t.labels.filter("doc_id % 3 <> 0"), t.labels.filter("doc_id % 3 = 0")
    counts = train.groupBy(Y).agg(F.count("*").alias("n"))
    majority = counts.agg(F.min_by(Y, F.struct(-F.col("n"), F.col(Y)))).scalar()
    return valid.select("doc_id", R(train.agg(F.avg(Y)).scalar(), 10).alias("prior"), majority.cast("int").alias("majority"))


def holdout(t, make):
    df = frame(t)
    train = M.with_class_weight(df.filter("split = 'train'"), Y)
    model = make().fit(train)
    return model, M.scores(model.transform(df.filter("split <> 'train'")), "doc_id", Y, "split")


@query("mlb9")
def logistic(t):
    return holdout(t, lambda: M.logistic_pipeline(NUM, CAT, Y, 15))[1]


@query(
    "mlb10",
    """SELECT quality, round((SELECT count(*) FROM labels) / (2 * count(*)), 10) AS weight, round((SELECT count(*) FILTER (quality = 0) / count(*) FILTER (quality = 1) FROM labels), 10) AS positive_weight FROM labels GROUP BY 1""",
)
def weights(t):
    return Sp.class_weights(t.labels, Y).select(Y, R("weight", 10).alias("weight"), R("positive_weight", 10).alias("positive_weight"))


@query("mlb11")
def forest(t):
    model, out = holdout(t, lambda: M.forest_pipeline(NUM, CAT, Y, 10))
    tree = holdout(t, lambda: M.tree_pipeline(NUM, CAT, Y))[1]
    return out.withColumnRenamed("score", "forest").join(tree.select("doc_id", F.col("score").alias("tree")), "doc_id")


def importances(t, model, names):
    values = model.stages[-1].featureImportances.toArray()
    return t.spark.createDataFrame([(n, float(v)) for n, v in zip(names, values)], "feature string, importance double")


@query("mlb11_importance")
def forest_importance(t):
    model, _ = holdout(t, lambda: M.forest_pipeline(NUM, CAT, Y, 10))
    return importances(t, model, NUM + CAT)


@query("mlb12")
def boosted(t):
    return holdout(t, lambda: M.boosted_pipeline(NUM, [], Y, 5))[1]


@query("mlb13")
def boosted_with_categories(t):
    # The early stop watches a tenth of the training rows; the held-out rows stay unseen.
    df = frame(t).withColumn("watch", F.pmod(stable_hash("doc_id", seed=9), F.lit(10)) == 0)
    train = M.with_class_weight(df.filter("split = 'train'"), Y)
    scored = M.boosted_on_categories(train, df.filter("split <> 'train'"), NUM, CAT, Y, "doc_id", "watch", 8)
    return M.scores(scored, "doc_id", Y)


@query(
    "mlb13_ordered",
    """WITH x AS (SELECT o_orderkey, o_custkey, o_orderpriority, CAST(o_orderstatus = 'F' AS INTEGER) AS y, o_orderkey * 7919 % 104729 AS place FROM orders)
       SELECT o_orderkey, round((coalesce(sum(y) OVER c, 0) + 0.5) / (count(*) OVER c + 1), 10) AS o_custkey_ts, round((coalesce(sum(y) OVER p, 0) + 0.5) / (count(*) OVER p + 1), 10) AS o_orderpriority_ts FROM x
       WINDOW c AS (PARTITION BY o_custkey ORDER BY place, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), p AS (PARTITION BY o_orderpriority ORDER BY place, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""",
)
def ordered_target_statistics(t):
    df = t.orders.select("o_orderkey", "o_custkey", "o_orderpriority", (F.col("o_orderstatus") == "F").cast("int").alias("y"))
    out = E.ordered_statistics(df, ["o_custkey", "o_orderpriority"], "y", "o_orderkey", F.col("o_orderkey") * 7919 % 104729)
    return out.select("o_orderkey", *[R(c, 10).alias(c) for c in ("o_custkey_ts", "o_orderpriority_ts")])


def price_frame(t):
    df = t.part.select("p_partkey", F.col("p_size").cast("double").alias("x"), (F.col("p_retailprice") / 1000).alias("z"), (F.col("p_retailprice") + 3 * F.col("p_size")).alias("y"))
    return VectorAssembler(inputCols=["x", "z"], outputCol="features").transform(df)


@query("mlb14")
def linear_models(t):
    df = durable(price_frame(t))
    n = df.count()
    rows = []
    # A ridge penalty a on the sum of squares is a / n on their mean.
    for name, reg, net in (("ols", 0.0, 0.0), ("ridge", 10.0 / n, 0.0), ("lasso", 0.1, 1.0)):
        m = LinearRegression(labelCol="y", regParam=reg, elasticNetParam=net, standardization=False, maxIter=50).fit(df)
        c = m.coefficients.toArray()
        rows.append((name, float(c[0]), float(c[1]), float(m.intercept), int(np.count_nonzero(np.abs(c) > 1e-9))))
    return t.spark.createDataFrame(rows, "model string, b_x double, b_z double, intercept double, nonzero int")


@query(
    "mlb14_slope",
    "SELECT l_returnflag, round(regr_slope(l_extendedprice, l_quantity), 6) AS slope, round(regr_intercept(l_extendedprice, l_quantity), 4) AS intercept FROM lineitem GROUP BY 1",
)
def slope(t):
    return t.lineitem.groupBy("l_returnflag").agg(
        R(F.regr_slope("l_extendedprice", "l_quantity"), 6).alias("slope"),
        R(F.regr_intercept("l_extendedprice", "l_quantity"), 4).alias("intercept"),
    )


@query("mlb15")
def degree_sweep(t):
    x = (F.col("p_size") / 25.0 - 1).alias("x")
    df = t.part.select(x, F.sin(F.col("p_size") / 8.0).alias("y"), (F.pmod(stable_hash("p_partkey"), F.lit(4)) > 0).alias("train"))
    vec = durable(VectorAssembler(inputCols=["x"], outputCol="v").transform(df).select("v", "y", "train"))
    rows = []
    for degree in (1, 3, 5, 9):
        data = PolynomialExpansion(degree=degree, inputCol="v", outputCol="features").transform(vec)
        m = LinearRegression(labelCol="y", solver="normal").fit(data.filter("train"))
        e = m.transform(data).groupBy("train").agg(F.avg(F.pow(F.col("prediction") - F.col("y"), 2)).alias("mse")).collect()
        mse = {r.train: r.mse for r in e}
        rows.append((degree, mse[True], mse[False]))
    return t.spark.createDataFrame(rows, "degree int, train_mse double, test_mse double")


@query("mlb16")
def network(t):
    return holdout(t, lambda: M.network_pipeline(NUM, Y, 8, 30))[1]


@query("mlb17")
def linear_classifier(t):
    """The perceptron rule on numbers scaled by the training rows."""
    df = frame(t)
    scaler = P.fit_scaler(df.filter("split = 'train'"), NUM)
    df = durable(scaler.transform(df.select("doc_id", Y, "split", *NUM)))
    model = fit_perceptron(df.filter("split = 'train'"), "doc_id", NUM, Y)
    return df.select("doc_id", Y, "split", model.predict().alias("prediction"))


@query("mlb18")
def kmeans_elbow(t):
    df = durable(t.embeddings.select("vec_id", "embedding"))
    return t.spark.createDataFrame(K.elbow(K.as_vectors(df, "embedding"), [2, 4, 6], seeds=(1,)), "k int, cost double")


CENTERS = "c AS (SELECT vec_id AS k, list_transform(embedding, lambda v: CAST(v AS DOUBLE)) AS e FROM embeddings WHERE vec_id < 3)"


@query(
    "mlb18_step",
    f"""WITH {CENTERS}, d AS (SELECT vec_id, embedding, k, list_sum(list_transform(list_zip(embedding, e), lambda p: pow(CAST(p[1] AS DOUBLE) - p[2], 2))) AS d FROM embeddings, c),
        a AS (SELECT vec_id, embedding, k FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY d, k) AS rn FROM d) WHERE rn = 1),
        x AS (SELECT k, unnest(range(0, 64)) AS position, CAST(unnest(embedding) AS DOUBLE) AS v FROM a)
        SELECT CAST(k AS INTEGER) AS cluster, CAST(position AS INTEGER) AS position, round(avg(v), 8) + 0 AS mean FROM x GROUP BY 1, 2""",
)
def kmeans_step(t):
    # Three starting centres: their number is a parameter, not a property of the data.
    starts = [list(r.embedding) for r in t.embeddings.filter("vec_id < 3").orderBy("vec_id").collect()]
    out = K.new_centers(K.assign(t.embeddings, "embedding", starts), "embedding", "cluster")
    return out.withColumn("mean", R("mean", 8))


@query("mlb19_silhouette")
def silhouette(t):
    df = K.as_vectors(durable(t.embeddings.select("vec_id", "embedding")), "embedding")
    predicted = K.best_kmeans(df, 4, seeds=(1,)).transform(df)
    rows = [(name, ClusteringEvaluator(distanceMeasure=name).evaluate(predicted)) for name in ("squaredEuclidean", "cosine")]
    own = K.silhouettes(predicted, "vec_id", "embedding", "prediction").agg(F.lit("euclidean").alias("distance"), F.avg("silhouette").alias("silhouette"))
    return own.union(t.spark.createDataFrame(rows, "distance string, silhouette double"))


@query(
    "mlb19",
    """WITH x AS (SELECT label, list_position(embedding, list_max(embedding)) AS c FROM embeddings), n AS (SELECT label, c, count(*) AS n FROM x GROUP BY 1, 2),
       a AS (SELECT sum(s * (s - 1) / 2) AS a FROM (SELECT sum(n) AS s FROM n GROUP BY label)), b AS (SELECT sum(s * (s - 1) / 2) AS b FROM (SELECT sum(n) AS s FROM n GROUP BY c)),
       s AS (SELECT sum(n * (n - 1) / 2) AS s, sum(n) * (sum(n) - 1) / 2 AS t FROM n) SELECT round((s - a * b / t) / ((a + b) / 2 - a * b / t), 8) + 0 AS adjusted_rand FROM a, b, s""",
)
def rand_index(t):
    df = t.embeddings.select("label", F.array_position("embedding", F.array_max("embedding")).alias("c"))
    return K.adjusted_rand(df, "label", "c").select(R("adjusted_rand", 8).alias("adjusted_rand"))


@query("mlb20")
def density(t):
    """Over the two main axes of the whole vectors."""
    points = durable(projection(t).select("vec_id", F.col("pc1").alias("x"), F.col("pc2").alias("y")))
    return K.density_clusters(points, "vec_id", ["x", "y"], eps=0.02, min_samples=5)


@query("mlb21")
def projection(t):
    df = K.as_vectors(t.embeddings, "embedding", "raw")
    centred = StandardScaler(inputCol="raw", outputCol="features", withMean=True, withStd=False).fit(df).transform(df)
    out = PCA(k=2, inputCol="features", outputCol="p").fit(centred).transform(centred).withColumn("a", vector_to_array("p"))
    return out.select("vec_id", F.col("a")[0].alias("pc1"), F.col("a")[1].alias("pc2"))


ANOVA = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(
    "mlb22",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS name, round((sum(n * pow(m - g, 2)) / 2) / (sum(n * v) / (sum(n) - 3)), 6) AS f FROM (SELECT count(*) AS n, avg({c}) AS m, var_pop({c}) AS v, (SELECT avg({c}) FROM lineitem) AS g FROM lineitem GROUP BY l_returnflag)"""
        for c in ANOVA
    ),
)
def anova(t):
    return P.anova_f(t.lineitem, ANOVA, "l_returnflag").select("name", R("f", 6).alias("f"))


@query("mlb22_select")
def chosen_features(t):
    df = VectorAssembler(inputCols=NUM, outputCol="v").transform(frame(t))
    pick = UnivariateFeatureSelector(featuresCol="v", labelCol=Y, outputCol="chosen").setFeatureType("continuous").setLabelType("categorical")
    model = pick.setSelectionMode("numTopFeatures").setSelectionThreshold(5).fit(df)
    return t.spark.createDataFrame([(NUM[i],) for i in model.selectedFeatures], "feature string")


@query("mlb23")
def isolation(t):
    df = t.lineitem.groupBy("l_suppkey").agg(F.avg("l_quantity").alias("q"), F.avg("l_extendedprice").alias("p"), F.count("*").alias("n"))
    return O.isolation_outliers(df, "l_suppkey", ["q", "p", "n"]).select("l_suppkey", "anomaly", "outlier")


MODELS = ["logistic", "tree"]
TREES = {"tree": lambda: M.tree_pipeline(NUM, CAT, Y, 4)}


def set_scores(df, sets, k, fold="fold"):
    """Out-of-fold scores of a logistic model per feature set, all fitted together."""
    return B.cross_scores(df, "doc_id", Y, B.fold_problems(sets, fold, k)).drop("fold_by")


def model_scores(df, k):
    return set_scores(df, {"logistic": (NUM, CAT)}, k).unionByName(M.cross_validated(df, "doc_id", Y, "fold", k, TREES))


@query("evl12")
def model_comparison(t):
    return M.summary(M.fold_metrics(model_scores(folded(t), 3), Y), ["model"])


FEATURE_SETS = {"length": (NUM[:3], []), "marks": (NUM[3:], []), "all": (NUM, CAT)}


@query("evl13")
def feature_set_comparison(t):
    df = folded(t)
    out = M.summary(M.fold_metrics(set_scores(df, FEATURE_SETS, 3), Y), ["model"])
    levels = {c: df.agg(F.count_distinct(c)).head()[0] for c in CAT}
    counts = [(n, len(a) + len(b), len(a) + sum(levels[c] + 1 for c in b)) for n, (a, b) in FEATURE_SETS.items()]
    sizes = t.spark.createDataFrame(counts, "model string, n_raw int, n_transformed int")
    base = out.filter("model = 'length'").select("mean").scalar()
    return out.join(sizes, "model").withColumn("delta", F.col("mean") - base)


@query("evl14")
def parameter_search(t):
    df = M.with_fold_class_weight(folded(t, 2), Y, "fold")
    pipe = M.logistic_pipeline(NUM, [], Y, 8)
    lr = pipe.getStages()[-1]
    settings = M.sampled_settings({"regParam": (0.001, 1.0), "elasticNetParam": [0.0, 0.5, 1.0]}, 3)
    grid = [{lr.getParam(k): v for k, v in s.items()} for s in settings]
    grid += ParamGridBuilder().addGrid(lr.regParam, [0.01]).build()
    judge = BinaryClassificationEvaluator(labelCol=Y, numBins=0)
    model = CrossValidator(estimator=pipe, estimatorParamMaps=grid, evaluator=judge, numFolds=2, foldCol="fold", parallelism=4).fit(df)
    rows = [(i, str({p.name: v for p, v in g.items()}), float(m)) for i, (g, m) in enumerate(zip(grid, model.avgMetrics))]
    return t.spark.createDataFrame(rows, "trial int, settings string, roc_auc double").orderBy(F.desc("roc_auc"))


@query("evl15")
def group_experiments(t):
    groups = {"length": NUM[:3], "marks": NUM[3:6], "words": NUM[6:]}
    sets = {f"only_{n}": (c, []) for n, c in groups.items()}
    seen = []
    for n, c in groups.items():
        seen = seen + c
        sets[f"upto_{n}"] = (seen, [])
    metrics = M.fold_metrics(set_scores(folded(t, 2), sets, 2), Y)
    return ranked_results(metrics.groupBy("model").agg(F.avg("roc_auc").alias("roc_auc"), F.avg("average_precision").alias("ap")))


def ranked_results(results):
    """Experiments in order of their metrics; one row per experiment."""
    return results.withColumn("place", F.row_number().over(W.orderBy(F.desc("roc_auc"), F.desc("ap"), "model")))


@query(
    "evl15_rank",
    """WITH r AS (SELECT o_orderpriority AS model, avg(CASE WHEN o_orderstatus = 'F' THEN 1.0 ELSE 0.0 END) AS roc_auc, avg(CASE WHEN o_orderstatus = 'O' THEN 1.0 ELSE 0.0 END) AS ap FROM orders GROUP BY 1)
       SELECT model, round(roc_auc, 10) AS roc_auc, round(ap, 10) AS ap, CAST(row_number() OVER (ORDER BY roc_auc DESC, ap DESC, model) AS INTEGER) AS place FROM r""",
)
def experiment_ranking(t):
    r = t.orders.groupBy(F.col("o_orderpriority").alias("model")).agg(
        F.avg(F.when(F.col("o_orderstatus") == "F", 1.0).otherwise(0.0)).alias("roc_auc"),
        F.avg(F.when(F.col("o_orderstatus") == "O", 1.0).otherwise(0.0)).alias("ap"),
    )
    return ranked_results(r).select("model", R("roc_auc", 10).alias("roc_auc"), R("ap", 10).alias("ap"), "place")


@query("evl16")
def ablation(t):
    groups = {"length": NUM[:3], "marks": NUM[3:6], "words": NUM[6:]}
    sets = {"baseline": (NUM, [])} | {f"without_{n}": ([c for c in NUM if c not in g], []) for n, g in groups.items()}
    metrics = M.fold_metrics(set_scores(folded(t, 2), sets, 2), Y)
    mean = metrics.groupBy("model").agg(F.avg("roc_auc").alias("roc_auc"))
    base = mean.filter("model = 'baseline'").select("roc_auc").scalar()
    return mean.withColumn("change", F.col("roc_auc") - base)


def with_partner(df, key, columns, seed):
    """Every row beside the values of another row: positions in two hash orders are matched."""
    place = lambda d, s: ordered(d.withColumn("_h", stable_hash(key, seed=s)), Ordered(order="_h", tie=[key], row_number="_rn")).drop("_h")
    other = place(df.select(key, *columns), seed + 1).select("_rn", *[F.col(c).alias(f"other_{c}") for c in columns])
    return place(df, seed).join(other, "_rn").drop("_rn")


@query("evl19")
def permutation_importance(t):
    df = frame(t)
    model = M.logistic_pipeline(NUM, [], Y, 10).fit(M.with_class_weight(df.filter("split = 'train'"), Y))
    valid = durable(df.filter("split <> 'train'").select("doc_id", Y, *NUM))

    # One shuffle of the rows per repeat serves all columns: a column takes its partner's value in turn.
    def variant(name):
        return F.struct(F.lit(name).alias("feature"), *[F.col(f"other_{c}" if c == name else c).alias(c) for c in NUM])

    parts = valid.select(Y, F.lit(0).alias("repeat"), F.lit("none").alias("feature"), *NUM)
    for repeat in range(5):
        pairs = with_partner(valid, "doc_id", NUM, 10 * repeat + 1)
        parts = parts.union(pairs.select(Y, F.lit(repeat).alias("repeat"), F.inline(F.array(*[variant(c) for c in NUM]))))
    parts = M.scores(model.transform(parts), Y, "feature", "repeat")
    aucs = V.auc_ap(V.score_curve(durable(parts), "score", Y, ["feature", "repeat"]), ["feature", "repeat"])
    aucs = durable(aucs)
    base = aucs.filter("feature = 'none'").select("roc_auc").scalar()
    drops = aucs.filter("feature <> 'none'").withColumn("drop", base - F.col("roc_auc"))
    return drops.groupBy("feature").agg(F.avg("drop").alias("mean"), F.stddev_pop("drop").alias("std"))


@query("evl21")
def iterative_pruning(t):
    df = folded(t, 2)
    weak = P.anova_f(df, NUM, Y).orderBy("f", "name").select("name").limit(len(NUM)).collect()
    order = [r.name for r in weak]
    sets = {f"drop_{n:02d}": ([c for c in NUM if c not in order[:n]], []) for n in (0, 1, 3)}
    metrics = M.fold_metrics(set_scores(df, sets, 2), Y)
    mean = metrics.groupBy("model").agg(F.avg("roc_auc").alias("roc_auc"))
    return pruning_choice(mean.withColumn("dropped", F.substring("model", 6, 2).cast("int")), 0.002)


def pruning_choice(results, tolerance):
    """Accept a step that loses no more than the tolerance against dropping nothing; mark the three candidates."""
    base = results.filter("dropped = 0").select("roc_auc").scalar()
    marked = results.withColumn("accepted", F.col("roc_auc") >= base - tolerance)
    best = marked.agg(F.max_by("dropped", F.struct("roc_auc", "dropped"))).scalar()
    small = marked.agg(F.max(F.when(F.col("accepted"), F.col("dropped")))).scalar()
    near = marked.agg(F.max_by("dropped", F.when(F.col("accepted"), F.struct("roc_auc", "dropped")))).scalar()
    return marked.select("*", (F.col("dropped") == best).alias("best"), (F.col("dropped") == small).alias("smallest"), (F.col("dropped") == near).alias("best_accepted"))


@query(
    "evl21_choice",
    """WITH r AS (SELECT CAST(o_custkey % 10 AS INTEGER) AS dropped, avg(CASE WHEN o_orderstatus = 'F' THEN 1.0 ELSE 0.0 END) AS roc_auc FROM orders GROUP BY 1),
       a AS (SELECT *, roc_auc >= (SELECT roc_auc FROM r WHERE dropped = 0) - 0.01 AS accepted FROM r)
       SELECT dropped, round(roc_auc, 10) AS roc_auc, accepted, dropped = (SELECT dropped FROM a ORDER BY roc_auc DESC, dropped DESC LIMIT 1) AS best, dropped = (SELECT max(dropped) FROM a WHERE accepted) AS smallest,
       dropped = (SELECT dropped FROM a WHERE accepted ORDER BY roc_auc DESC, dropped DESC LIMIT 1) AS best_accepted FROM a""",
)
def pruning_candidates(t):
    r = t.orders.groupBy((F.col("o_custkey") % 10).cast("int").alias("dropped")).agg(
        F.avg(F.when(F.col("o_orderstatus") == "F", 1.0).otherwise(0.0)).alias("roc_auc")
    )
    return pruning_choice(r, 0.01).withColumn("roc_auc", R("roc_auc", 10))


def stacked(t, k=3):
    """Out-of-fold scores of the base models beside two raw features, one row per document."""
    df = folded(t, k)
    oof = model_scores(df, k)
    wide = oof.groupBy("doc_id").pivot("model", MODELS).agg(F.first("score"))
    return df.select("doc_id", Y, "fold", "n_chars", "mark_share").join(wide, "doc_id")


@query("evl23")
def stacking(t):
    meta = durable(stacked(t))
    inputs = [*MODELS, "n_chars", "mark_share"]
    oof = set_scores(meta, {"meta": (inputs, [])}, 3)
    return oof.select("doc_id", Y, "score")


@query("evl24")
def robustness(t):
    seeds = (42, 123, 2024)
    rows = t.labels.select("doc_id", Y)
    for seed in seeds:
        rows = Sp.stratified_folds(rows, "doc_id", Y, 3, seed, f"fold_{seed}")
    df = durable(M.text_frame(t.documents, rows))
    # the logistic models of all seeds and folds advance together
    together = [p for seed in seeds for p in B.fold_problems({"logistic": (NUM, CAT)}, f"fold_{seed}", 3)]
    parts = B.cross_scores(df, "doc_id", Y, together).withColumn("seed", F.substring("fold_by", 6, 9).cast("int")).drop("fold_by")
    for seed in seeds:
        trees = M.cross_validated(df.withColumn("fold", F.col(f"fold_{seed}")), "doc_id", Y, "fold", 3, TREES)
        parts = parts.unionByName(trees.withColumn("seed", F.lit(seed)))
    wide = parts.groupBy("seed", "fold", "doc_id", Y).pivot("model", MODELS).agg(F.first("score"))
    a, b = (F.col(m) for m in MODELS)
    scores = F.array(*[F.struct(F.lit(n).alias("model"), c.alias("score")) for n, c in ((MODELS[0], a), (MODELS[1], b), ("blend", (a + b) / 2))])
    long = durable(wide.select("seed", "fold", Y, F.inline(scores)))
    out = M.summary(M.fold_metrics(long, Y, ("model", "seed", "fold")), ["model"])
    gain = out.agg(F.max(F.when(F.col("model") == "blend", F.col("mean"))) - F.max(F.when(F.col("model") != "blend", F.col("mean")))).scalar()
    return out.withColumn("blend_gain", gain)


@query("evl26")
def batch_scoring(t):
    """Train on two folds, save encodings, models and settings; load them and score the third fold as new data."""
    base = X.row_features(S.application(t))
    history = X.bureau_recent(S.bureau(t))
    matrix = X.joined_matrix(base, [history])
    y = S.targets(t)
    inputs = ["CREDIT_INCOME_RATIO", "EXT_SOURCE_MEAN", "ADV_BURO_CLOSED_RECORD_COUNT", "ADV_BURO_ACTIVE_RECORD_COUNT", "TE_APP_ORGANIZATION_TYPE"]

    def prepared(rows, encoding, mean):
        return complete(E.apply_encoding(rows, "ORGANIZATION_TYPE", encoding, F.lit(mean), "TE_APP_ORGANIZATION_TYPE"))

    def complete(out):
        out = C.align(out, {X.KEY: "bigint", **{c: "double" for c in inputs}, **({"TARGET": "int"} if "TARGET" in out.columns else {})})
        return out.fillna(0.0, inputs)

    data = durable(matrix.join(y, X.KEY))
    train, new = data.filter("fold <> 0"), data.filter("fold = 0").drop("TARGET")
    encoding = E.fit_encoding(train, "ORGANIZATION_TYPE", "TARGET")
    mean = train.agg(F.avg("TARGET")).head()[0]
    # a training row is encoded by the other training folds, a new row by all of them
    apart = E.out_of_fold(train, "ORGANIZATION_TYPE", "TARGET", "fold", "TE_APP_ORGANIZATION_TYPE")
    fit = durable(M.with_class_weight(complete(apart), "TARGET"))
    folder = scratch_path(t.spark, "scoring")
    M.save_bundle(M.logistic_pipeline(inputs, [], "TARGET", 10).fit(fit), f"{folder}/a", threshold=0.5, weight=0.6, mean=mean)
    M.save_bundle(M.tree_pipeline(inputs, [], "TARGET", 4).fit(fit), f"{folder}/b", threshold=0.5)
    encoding.write.parquet(f"{folder}/encoding")

    saved = t.spark.read.parquet(f"{folder}/encoding")
    ready = durable(prepared(new, saved, mean))
    a = M.scores(M.load_bundle(t.spark, f"{folder}/a")[0].transform(ready), X.KEY).withColumnRenamed("score", "a")
    b = M.scores(M.load_bundle(t.spark, f"{folder}/b")[0].transform(ready), X.KEY).withColumnRenamed("score", "b")
    out = V.blend(a.join(b, X.KEY), "a", "b", (0.6,)).select(X.KEY, F.col("blended").alias("TARGET"))
    out = durable(out)
    Prof.accept(Prof.output_checks(out, ready, X.KEY, "TARGET", [X.KEY, "TARGET"]))
    path = Io.write_delimited(out, f"{folder}/scores")
    return Io.read_delimited(t.spark, path, out.schema)
