"""Folds, cross-validated boosted trees, out-of-fold and fold-averaged scores, principal components."""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark import SparkContext
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from relfeat.functions.expr import lit, with_exprs
from relfeat.operators.impute import fit_standardize, standardize
from relfeat.session import in_parallel, shared_dir, stored

# fixed values: folds and seed of the evaluation
FOLDS = 5
SEED = 546789
# fixed value: stands for "missing" in a feature vector, because the trees take no missing values
MISSING = -999.0
# fixed values: share of rows and of columns that each tree looks at
ROW_SHARE = 0.8715623
COLUMN_SHARE = 0.9497036
# fixed value: trees without a better AUC after which boosting counts as finished
PATIENCE = 100
# to be raised when models are fitted or cut in another way: saved ones outlive the session where the shared folder does
MODEL_FORMAT = 1
# more than any number of trees, so that (fold, number of trees) is one number
STAGES_PER_FOLD = 1_000_000


def kfold_column(key: str, k: int = FOLDS, seed: int = SEED) -> Column:
    """Fold 0..k-1 from a hash of the key: no shuffle, the same after any repartition or recomputation."""
    digest = F.substring(F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}"))), 1, 8)
    return F.pmod(F.conv(digest, 16, 10).cast("long"), F.lit(k)).cast("int")


def assign_folds(df: DataFrame, key: str, k: int = FOLDS, seed: int = SEED, name: str = "fold") -> DataFrame:
    return df.withColumn(name, kfold_column(key, k, seed))


def assemble(df: DataFrame, features: Sequence[str], name: str = "features", missing: float = MISSING) -> DataFrame:
    filled = with_exprs(df, {c: f"coalesce(CAST({c} AS DOUBLE), {lit(missing)})" for c in features})
    return VectorAssembler(inputCols=list(features), outputCol=name).transform(filled)


@dataclass
class CrossValidation:
    """Fitted fold models, each cut to the number of trees with the best held-out AUC, and the scores they give."""

    key: str
    label: str
    features: list[str]
    models: list[GBTClassificationModel] = field(default_factory=list)
    oof: DataFrame | None = None

    def score_average(self, test: DataFrame) -> DataFrame:
        """(key, score): mean over the fold models of the probability of the positive class."""
        scored = assemble(test, self.features).select(self.key, "features")
        names = []
        for i, model in enumerate(self.models):
            names.append(f"__p{i}")
            scored = _probability(model, scored, names[-1])
        mean = sum((F.col(n) for n in names[1:]), F.col(names[0])) / F.lit(float(len(names)))
        return scored.select(self.key, mean.alias("score"))

    def importances(self) -> DataFrame:
        """(feature, fold, importance): a few numbers per feature, held by the models already."""
        spark = self.oof.sparkSession
        rows = [
            (f, i, float(v))
            for i, model in enumerate(self.models)
            for f, v in zip(self.features, model.featureImportances.toArray())
        ]
        return spark.createDataFrame(rows, "feature string, fold int, importance double")


def _probability(model: GBTClassificationModel, df: DataFrame, name: str) -> DataFrame:
    kept = df.columns
    model.setFeaturesCol("features").setPredictionCol("").setRawPredictionCol("").setProbabilityCol("__prob")
    scored = model.transform(df)
    return scored.select(*kept, vector_to_array("__prob").getItem(1).alias(name))


def first_trees(model: GBTClassificationModel, n: int) -> GBTClassificationModel:
    """The model that boosting had after ``n`` trees."""
    sc, java = SparkContext._active_spark_context, model._java_obj
    trees = sc._gateway.new_array(sc._jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, n)
    weights = sc._gateway.new_array(sc._gateway.jvm.double, n)
    for i, (tree, weight) in enumerate(zip(java.trees()[:n], java.treeWeights()[:n])):
        trees[i], weights[i] = tree, weight
    cut = sc._jvm.org.apache.spark.ml.classification.GBTClassificationModel(java.uid(), trees, weights, model.numFeatures, 2)
    return GBTClassificationModel(cut)


def staged_margins(model: GBTClassificationModel, path: str, df: DataFrame, name: str = "margins") -> DataFrame:
    """Add an array with the margin after each tree: one pass finds the leaf of every tree, whose weighted predictions,
    read from the model saved at ``path`` (leaves count in preorder), are added up."""
    spark = df.sparkSession
    leaves = spark.read.parquet(f"{path}/data").where("nodeData.leftChild < 0")
    found: dict[int, list[float]] = {}
    for r in leaves.select("treeID", "nodeData.id", "nodeData.prediction").orderBy("treeID", "id").collect():
        found.setdefault(r.treeID, []).append(r.prediction)
    values = [[model.treeWeights[t] * v for v in found[t]] for t in sorted(found)]
    table = spark.createDataFrame([(values,)], "__values array<array<double>>")  # trees x leaves numbers, one row
    model.setFeaturesCol("features").setPredictionCol("").setRawPredictionCol("").setProbabilityCol("").setLeafCol("__leaf")
    placed = model.transform(df).withColumn("__leaf", vector_to_array("__leaf"))
    model.setLeafCol("")
    parts = "zip_with(__leaf, __values, (leaf, v) -> v[CAST(leaf AS INT)])"
    summed = f"aggregate({parts}, array(0D), (a, x) -> concat(a, array(element_at(a, -1) + x)), a -> slice(a, 2, size(a)))"
    return placed.crossJoin(F.broadcast(table)).select(*df.columns, F.expr(f"{summed} AS `{name}`"))


def staged_auc(staged: DataFrame, label: str, fold: str, margins: str = "margins") -> dict[int, list[float | None]]:
    """Per fold the AUC after each tree, of all folds and numbers of trees in one job; None where a fold has one class."""
    from relfeat.operators.metrics import ALL_ROWS, auc_by_fold

    long = staged.select(F.col(label).alias("y"), F.col(fold).alias("f"), F.posexplode(margins).alias("at", "score"))
    numbered = long.select("y", (F.col("f") * STAGES_PER_FOLD + F.col("at")).alias("stage"), "score")
    found: dict[int, dict[int, float | None]] = {}
    for r in auc_by_fold(numbered, "y", "score", "stage").where(F.col("fold") != ALL_ROWS).collect():
        found.setdefault(r.fold // STAGES_PER_FOLD, {})[r.fold % STAGES_PER_FOLD] = r.auc
    return {f: [auc[i] for i in sorted(auc)] for f, auc in found.items()}


def best_stage(auc: Sequence[float | None], patience: int = PATIENCE) -> int:
    """Number of trees with the best AUC (ties: the fewest), looking no further than ``patience`` trees without a better
    one; all trees if there is no AUC."""
    best, at = None, len(auc)
    for i, value in enumerate(auc):
        if value is not None and (best is None or value > best):
            best, at = value, i + 1
        elif best is not None and i + 1 - at >= patience:
            break
    return at


def cross_validate(
    train: DataFrame,
    key: str,
    label: str,
    features: Sequence[str],
    k: int = FOLDS,
    seed: int = SEED,
    max_iter: int = 20,
    max_depth: int = 5,
    step_size: float = 0.1,
    subsampling_rate: float = ROW_SHARE,
    min_instances: int = 1,
    patience: int = PATIENCE,
    reuse: bool = True,
) -> CrossValidation:
    """Fit k boosted-tree models, cut each to the trees with the best AUC on its held-out fold, score every row out of fold.

    The assembled rows are stored once, every fit reads them without its fold, and the fits, which do not depend on each
    other, run side by side. The models are saved in the shared folder under a key of settings and data (an
    order-independent digest of all rows): with ``reuse`` the same data and settings are fitted once and read after that.
    """
    rows = assemble(assign_folds(train, key, k, seed), features)
    rows = stored(rows.selectExpr(key, f"CAST({label} AS DOUBLE) AS label", "fold", "features"), "fold-rows")
    settings = {
        "featuresCol": "features", "labelCol": "label", "maxIter": max_iter, "maxDepth": max_depth, "stepSize": step_size,
        "subsamplingRate": subsampling_rate, "minInstancesPerNode": min_instances, "featureSubsetStrategy": str(COLUMN_SHARE), "seed": seed,
    }
    home = models_home(rows, key, {**settings, "features": list(features), "k": k, "patience": patience})
    models = load_models(train.sparkSession, home) if reuse else None
    if models is None:
        models = fit_folds(rows, k, settings, patience, home)
    result = CrossValidation(key, label, list(features), models)
    parts = None
    for fold, model in enumerate(result.models):
        held = _probability(model, rows.where(F.col("fold") == fold), "score").select(
            key, F.col("label").cast("int").alias("label"), "fold", "score"
        )
        parts = held if parts is None else parts.unionByName(held)
    result.oof = parts
    return result


def fit_folds(rows: DataFrame, k: int, settings: Mapping[str, object], patience: int, home: str) -> list[GBTClassificationModel]:
    spark = rows.sparkSession
    attempt = f"{home}/{uuid.uuid4().hex}"

    def fit(fold: int) -> tuple[GBTClassificationModel, DataFrame]:
        model = GBTClassifier(**settings).fit(rows.where(F.col("fold") != fold))
        model.save(f"{attempt}/whole-{fold}")
        return model, staged_margins(model, f"{attempt}/whole-{fold}", rows.where(F.col("fold") == fold).select("label", "fold", "features"))

    fitted = in_parallel(spark, [lambda f=fold: fit(f) for fold in range(k)])
    staged = reduce(DataFrame.unionByName, [s.select("label", "fold", "margins") for _, s in fitted])
    auc = staged_auc(staged, "label", "fold")
    models = []
    for fold, (model, _) in enumerate(fitted):
        models.append(first_trees(model, best_stage(auc.get(fold) or [None] * model.getNumTrees, patience)))
        models[-1].save(f"{attempt}/fold-{fold}")
    # the manifest comes last: without it there are no models
    manifest = spark.createDataFrame([(f, f"{attempt}/fold-{f}") for f in range(k)], "fold int, path string")
    manifest.coalesce(1).write.mode("overwrite").parquet(f"{home}/manifest")
    return models


def models_home(rows: DataFrame, key: str, settings: Mapping[str, object]) -> str:
    """The folder of the models for these rows and settings."""
    code = F.xxhash64(key, "label", "features")
    data = rows.agg(F.count(F.lit(1)), F.bit_xor(code), F.sum(F.shiftright(code, 20)), F.sum(code.bitwiseAND(0xFFFFF))).first()
    named = json.dumps([MODEL_FORMAT, rows.sparkSession.version, tuple(data), key, dict(settings)], sort_keys=True)
    return f"{shared_dir(rows.sparkSession).rstrip('/')}/fold-models/{hashlib.sha256(named.encode()).hexdigest()}"


def load_models(spark: SparkSession, home: str) -> list[GBTClassificationModel] | None:
    done = spark._jvm.org.apache.hadoop.fs.Path(f"{home}/manifest/_SUCCESS")
    if not done.getFileSystem(spark._jsc.hadoopConfiguration()).exists(done):
        return None
    paths = spark.read.parquet(f"{home}/manifest").orderBy("fold").collect()
    return [GBTClassificationModel.load(r.path) for r in paths]


def forget_models(spark: SparkSession) -> None:
    """Delete all saved fold models of the shared folder."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark).rstrip('/')}/fold-models")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def fold_report(result: CrossValidation) -> DataFrame:
    """(fold, rows, trees, auc) per fold model, and over all rows."""
    from relfeat.operators.metrics import ALL_ROWS, auc_by_fold

    auc = auc_by_fold(result.oof, "label", "score", "fold")
    trees = {i: m.getNumTrees for i, m in enumerate(result.models)}
    trees[ALL_ROWS] = sum(trees.values())
    number = None
    for fold, n in trees.items():
        hit = F.col("fold") == fold
        number = F.when(hit, n) if number is None else number.when(hit, n)
    return auc.select("fold", (F.col("pos") + F.col("neg")).alias("n_rows"), number.alias("n_trees"), "auc")


def separation(scored: DataFrame, label: str, score: str, fold: str | None = None) -> DataFrame:
    """(fold, gap): mean score of the positive rows less that of the others; 0 for a model that tells nothing apart."""
    by = F.lit(0).alias("fold") if fold is None else F.col(fold).alias("fold")
    means = [F.avg(F.when(F.col(label) == y, F.col(score))) for y in (1, 0)]
    return scored.groupBy(by).agg((means[0] - means[1]).alias("gap"))


def pca_project(train: DataFrame, df: DataFrame, key: str, features: Sequence[str], n: int) -> DataFrame:
    """(key, principal_component_1..n) of the standardised features; scaling and axes come from ``train``.

    The fit gathers one covariance matrix, of size features x features.
    """
    fitted = fit_standardize(train, features)

    def vectors(x: DataFrame) -> DataFrame:
        return assemble(standardize(x, fitted), features, missing=0.0).select(key, "features")

    model = PCA(k=n, inputCol="features", outputCol="__pc").fit(vectors(train))
    projected = model.transform(vectors(df)).select(key, vector_to_array("__pc").alias("__pc"))
    return projected.select(key, *[F.col("__pc").getItem(i).alias(f"principal_component_{i + 1}") for i in range(n)])
