"""Risk model (MOD-1..4), re-aimed onto Spark ML: the gradient-boosted tree learner of
the reference is not available here, so a Spark ``GBTClassifier`` with the same number
of trees, depth and learning rate is trained in a ``Pipeline`` (median imputation plus
missing-value flags, then ``VectorAssembler``).  Results are *a* model, not the
reference's weights (which are not published)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import Imputer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import boosting


def feature_matrix(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """MOD-1: numeric feature columns as doubles plus 0/1 missing flags."""
    return df.withColumns({c: F.col(c).cast("double") for c in features}).withColumns(
        {f"{c}_missing": F.col(c).isNull().cast("double") for c in features})


def gbt_pipeline(features: Sequence[str], *, label: str = "label", trees: int = 50, depth: int = 10,
                 rate: float = 0.1, seed: int = 42) -> Pipeline:
    imp = Imputer(inputCols=list(features), outputCols=[f"{c}_imp" for c in features], strategy="median")
    asm = VectorAssembler(inputCols=[f"{c}_imp" for c in features] + [f"{c}_missing" for c in features],
                          outputCol="features", handleInvalid="keep")
    gbt = GBTClassifier(labelCol=label, featuresCol="features", maxIter=trees, maxDepth=depth, stepSize=rate,
                        seed=seed)
    return Pipeline(stages=[imp, asm, gbt])


def train(df: DataFrame, features: Sequence[str], **kw) -> PipelineModel:
    """MOD-2: fit on the training rows (an action: model fitting).  The model of ``gbt_pipeline(...).fit``, its trees
    grown over blocks of binned rows (``boosting``)."""
    imp, asm, gbt = gbt_pipeline(features, **kw).getStages()
    rows = feature_matrix(df, features)
    filled = imp.fit(rows)
    return PipelineModel([filled, asm, boosting.fitted(filled.transform(rows), gbt, asm.getInputCols())])


def score(model: PipelineModel, df: DataFrame, features: Sequence[str], out: str = "pred_proba") -> DataFrame:
    """MOD-3: probability of the positive class, that of ``model.transform`` (``boosting.probability`` walks whole batches
    down the trees)."""
    filled, asm, gbt = model.stages
    p = filled.transform(feature_matrix(df, features))
    return p.withColumn(out, boosting.probability(gbt, asm.getInputCols())).drop(
        *[f"{c}_imp" for c in features], *[f"{c}_missing" for c in features])


def importance(model: PipelineModel, features: Sequence[str], top: int = 20) -> DataFrame:
    """MOD-4 / SRT-4: impurity-gain importances of the trees, top ``top`` features."""
    gbt = model.stages[-1]
    names = list(features) + [f"{c}_missing" for c in features]
    vals = gbt.featureImportances.toArray().tolist()
    from pyspark.sql import SparkSession
    s = SparkSession.getActiveSession()
    # one value per feature (model metadata, bounded by the feature count)
    imp = s.createDataFrame(list(zip(names, [float(v) for v in vals])), "feature string, importance double")
    return imp.orderBy(F.desc("importance"), F.asc("feature")).limit(top)


def tree_nodes(model: PipelineModel) -> DataFrame:
    """(tree, node, feature_no, gain) of every inner node of the fitted trees: the model's own node table,
    written to the shared folder and read back as rows."""
    nodes = boosting.saved_nodes(model.stages[-1]).select(F.col("treeID").alias("tree"), "nodeData.*")
    return nodes.where(F.col("leftChild") >= 0).select(
        "tree", F.col("id").alias("node"), F.col("split.featureIndex").alias("feature_no"), "gain")


def split_counts(model: PipelineModel, features: Sequence[str], top: int = 20) -> DataFrame:
    """MOD-4 / SRT-4, second kind: how often the trees split on a feature, top ``top`` features (ties by
    name); features that no tree splits on are left out."""
    names = F.array(*(F.lit(f) for f in features), *(F.lit(f"{f}_missing") for f in features))
    return (tree_nodes(model).groupBy("feature_no").agg(F.count(F.lit(1)).alias("splits"))
            .select(F.get(names, F.col("feature_no")).alias("feature"), "splits")
            .orderBy(F.desc("splits"), F.asc("feature")).limit(top))
