"""Class-weighted baseline classifiers on MLlib."""

from __future__ import annotations

import math

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from riskweave import constants as K
from riskweave.models.balanced_forest import Forest, fit_balanced_forest, score_balanced_forest
from riskweave.operators.metrics import binary_metrics
from riskweave.operators.ranking import exact_quantile
from riskweave.operators.sampling import use_or_make_split
from riskweave.session import staged

LABEL = "is_laundering"
TASK_ROWS = 250_000  # training rows of one task, so that cached blocks stay small


def impute_medians(train: DataFrame) -> dict:
    """Exact medians of the numeric columns that hold a NULL; one pass finds those."""
    gaps = train.agg(
        *[F.count_if(F.col(c).isNull()).alias(c) for c in K.NUMERIC_FEATURES]
    ).first().asDict()
    return {c: exact_quantile(train, c, 0.5) for c, n in gaps.items() if n}


def impute_values(train: DataFrame) -> dict:
    """Medians and most frequent texts of the training rows."""
    fill = impute_medians(train)
    for c in K.CATEGORICAL_FEATURES:
        top = (
            train.filter(F.col(c).isNotNull()).groupBy(c).agg(F.count("*").alias("n"))
            .orderBy(F.desc("n"), c).limit(1).collect()
        )
        if top:
            fill[c] = top[0][0]
    return fill


def prepare(df: DataFrame, fill: dict) -> DataFrame:
    """Numeric columns as doubles, gaps filled."""
    typed = df.withColumns({c: F.col(c).cast("double") for c in K.NUMERIC_FEATURES})
    return typed.fillna(fill)


def _encoder_stages(scale: bool) -> tuple[list, str]:
    """Index + one-hot for texts (unknown -> all zeros), optional standardising."""
    indexed = [f"{c}_ix" for c in K.CATEGORICAL_FEATURES]
    hot = [f"{c}_hot" for c in K.CATEGORICAL_FEATURES]
    stages = [
        StringIndexer(inputCols=K.CATEGORICAL_FEATURES, outputCols=indexed,
                      handleInvalid="keep", stringOrderType="alphabetAsc"),
        # the unknown bucket comes last and is the dropped one
        OneHotEncoder(inputCols=indexed, outputCols=hot, dropLast=True),
        VectorAssembler(inputCols=K.NUMERIC_FEATURES, outputCol="numeric"),
    ]
    numeric = "numeric"
    if scale:
        stages.append(StandardScaler(inputCol="numeric", outputCol="scaled", withMean=True))
        numeric = "scaled"
    stages.append(VectorAssembler(inputCols=[numeric, *hot], outputCol="features"))
    return stages, "features"


def with_class_weight(train: DataFrame) -> DataFrame:
    """``n / (2 n_c)`` per row of class c."""
    n, pos = train.agg(F.count("*"), F.count_if(F.col(LABEL) == 1)).first()
    weight = F.when(F.col(LABEL) == 1, n / (2 * max(pos, 1))).otherwise(n / (2 * max(n - pos, 1)))
    return train.withColumn("class_weight", weight)


def spread(rows: DataFrame, n: int, id_col: str = "transaction_id") -> DataFrame:
    """``n`` rows dealt by id into equal parts, a whole number for each core: every pass of a model waits for the largest."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(cores * max(1, math.ceil(n / (TASK_ROWS * cores))), id_col)


def fit_stages(stages: list, rows: DataFrame, n: int) -> PipelineModel:
    """A pipeline whose last stage makes many passes: the ``n`` rows are encoded and dealt out once for it."""
    encoder = Pipeline(stages=stages[:-1]).fit(rows)
    ready = encoder.transform(rows).select("transaction_id", "features", LABEL, "class_weight")
    ready = spread(ready, n).drop("transaction_id").cache()
    last = stages[-1].fit(ready)
    ready.unpersist()
    return PipelineModel(stages=[*encoder.stages, last])


def logistic_stages(rows: int) -> list:
    stages, features = _encoder_stages(scale=True)
    # L2 with C = 1 on a summed loss equals regParam = 1 / n on MLlib's mean loss
    return [
        *stages,
        LogisticRegression(
            featuresCol=features, labelCol=LABEL, weightCol="class_weight", maxIter=500,
            regParam=1.0 / max(rows, 1), elasticNetParam=0.0, standardization=False,
        ),
    ]


def forest_stages(seed: int, trees: int = 80, depth: int = 12, min_leaf: int = 20) -> list:
    stages, features = _encoder_stages(scale=False)
    return [
        *stages,
        RandomForestClassifier(
            featuresCol=features, labelCol=LABEL, weightCol="class_weight", numTrees=trees,
            maxDepth=depth, minInstancesPerNode=min_leaf, seed=seed,
            featureSubsetStrategy="sqrt",
        ),
    ]


def forest_inputs(train: DataFrame) -> list[list[str]]:
    """The texts of each categorical column that the forest with balanced samples takes as inputs, in order."""
    model = StringIndexer(
        inputCols=K.CATEGORICAL_FEATURES, outputCols=[f"{c}_ix" for c in K.CATEGORICAL_FEATURES],
        handleInvalid="keep", stringOrderType="alphabetAsc",
    ).fit(train)
    return [list(labels) for labels in model.labelsArray]


def encoded_rows(labels: list[list[str]], rows: DataFrame) -> DataFrame:
    """``rows`` with their inputs as ``x`` (numbers, then 0 or 1 per text) and the label as ``y``."""
    def number(name: str) -> Column:
        gap = F.col(name).isNull() | F.isnan(name)
        return F.when(gap, F.raise_error(F.lit(f"no number in {name}")).cast("double")).otherwise(F.col(name))

    flags = [
        F.coalesce((F.col(c) == label).cast("double"), F.lit(0.0))
        for c, own in zip(K.CATEGORICAL_FEATURES, labels) for label in own
    ]
    x = F.array(*[number(c) for c in K.NUMERIC_FEATURES], *flags)
    return rows.select(*rows.columns, x.alias("x"), F.col(LABEL).cast("int").alias("y"))


def train_balanced_subsample(
    features: DataFrame, seed: int = K.BOOTSTRAP_SEED, trees: int = 80, depth: int = 12, min_leaf: int = 20,
) -> tuple[Forest, DataFrame, list[str]]:
    """The forest with class weights per bootstrap sample; returns it, the scored test rows and its input names."""
    split, _ = use_or_make_split(features)
    train, test = split.filter("split = 'train'"), split.filter("split = 'test'")
    fill = impute_values(train)
    train, test = prepare(train, fill), prepare(test, fill)
    labels = forest_inputs(train)
    flags = [f"{column}_{label}" for column, own in zip(K.CATEGORICAL_FEATURES, labels) for label in own]
    names = [*K.NUMERIC_FEATURES, *flags]
    rows = encoded_rows(labels, train)
    forest = fit_balanced_forest(rows, len(names), trees, depth, min_leaf, seed=seed, id_col="transaction_id", flags=len(flags))
    scored = score_balanced_forest(encoded_rows(labels, test), forest, depth)
    return forest, scored, names


def train_baselines(
    features: DataFrame, seed: int = K.FEATURE_SEED, trees: int = 80, depth: int = 12,
    models: tuple[str, ...] = ("logistic_regression_balanced", "random_forest_balanced"),
) -> tuple[dict[str, PipelineModel], DataFrame, dict, str]:
    """Fit the baselines; returns models, prepared test rows, fill values and split strategy."""
    split, strategy = use_or_make_split(features, seed=seed)
    train, test = split.filter("split = 'train'"), split.filter("split = 'test'")
    fill = impute_values(train)
    fit = with_class_weight(prepare(train, fill))
    rows = fit.count()
    fitted = {}
    if "logistic_regression_balanced" in models:
        fitted["logistic_regression_balanced"] = fit_stages(logistic_stages(rows), fit, rows)
    if "random_forest_balanced" in models:
        fitted["random_forest_balanced"] = fit_stages(forest_stages(seed, trees, depth), fit, rows)
    return fitted, prepare(test, fill), fill, strategy


def predict(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """``score`` = probability of class 1, ``prediction`` 0/1, next to the input columns."""
    out = model.transform(rows)
    return out.select(
        *rows.columns, vector_to_array("probability")[1].alias("score"),
        F.col("prediction").cast("int").alias("prediction"),
    )


def metrics_once(scored: DataFrame, name: str) -> DataFrame:
    """Metrics of a model; they read the scores several times, so those are stored."""
    return binary_metrics(staged(scored.select(LABEL, "score", "prediction"), "scores"), name, LABEL)


def evaluate(fitted: dict[str, PipelineModel], test: DataFrame) -> DataFrame:
    parts = [metrics_once(predict(m, test), name) for name, m in fitted.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def importance(name: str, model: PipelineModel, rows: DataFrame) -> DataFrame:
    """(model, feature, importance, abs_importance), one row per model input."""
    spark = rows.sparkSession
    indexer, last = model.stages[0], model.stages[-1]
    names = list(K.NUMERIC_FEATURES)
    for column, labels in zip(K.CATEGORICAL_FEATURES, indexer.labelsArray):
        names += [f"{column}_{label}" for label in labels]
    raw = last.coefficients if hasattr(last, "coefficients") else last.featureImportances
    values = [float(v) for v in raw.toArray()]
    data = [(name, n, v, abs(v)) for n, v in zip(names, values)]
    return spark.createDataFrame(
        data, "model string, feature string, importance double, abs_importance double"
    )
