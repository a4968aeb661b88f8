"""A pointwise ranker: gradient-boosted trees on the label, scored by probability."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import Bucketizer, SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.models.nodes import by_round, logistic_loss, staged_margins
from plumbline.operators.ranking import compare_models, metric_table
from plumbline.operators.recommend import top_recommendations
from plumbline.settings import ModelSettings
from plumbline.sources.state import cut_lineage, small_reads

VECTOR = "__features"
VALIDATION = "__validation"
WEIGHT = "__weight"
#: Bytes of the stored rows in one task of a fit: some 500,000 rows of a few features.
FIT_BYTES = 2 << 20
#: Rows from which a fit looks for bins: the learner keeps some 260 bytes a row in its own form.
BINNED_FROM = 20_000_000
FILLED = "__filled_"
BINNED = "__binned_"
MISSING = "-1e300D"


def feature_matrix(
    df: DataFrame, features: Sequence[str], label: str, qid: str, ordered: bool = False
) -> DataFrame:
    """``__features``, label and query id; NULL features become NaN in the vector.

    ``ordered`` sorts by query id, for learners that want a query's rows together.
    """
    assembler = VectorAssembler(inputCols=list(features), outputCol=VECTOR, handleInvalid="keep")
    matrix = assembler.transform(df).select(VECTOR, label, qid)
    return matrix.orderBy(qid) if ordered else matrix


def feature_stages(
    features: Sequence[str], edges: Mapping[str, Sequence[float]] | None = None
) -> list[Transformer]:
    """Stages that make the feature vector.

    Trees of MLlib take no NaN: a missing value becomes one far below all others, which
    a split can set apart. Features with ``edges`` are replaced by the number of their bin.
    """
    filled = ", ".join(
        f"coalesce(nullif(CAST(`{c}` AS DOUBLE), double('NaN')), {MISSING}) AS `{FILLED}{c}`"
        for c in features
    )
    edges = edges or {}
    bins = Bucketizer(
        splitsArray=[[float("-inf"), *cuts, float("inf")] for cuts in edges.values()],
        inputCols=[f"{FILLED}{c}" for c in edges],
        outputCols=[f"{BINNED}{c}" for c in edges],
    )
    made = [f"{BINNED if c in edges else FILLED}{c}" for c in features]
    return [
        SQLTransformer(statement=f"SELECT *, {filled} FROM __THIS__"),
        *([bins] if edges else []),
        VectorAssembler(inputCols=made, outputCol=VECTOR),
    ]


def feature_names_of(model: PipelineModel) -> list[str]:
    made = model.stages[-2].getInputCols()
    return [c.removeprefix(FILLED).removeprefix(BINNED) for c in made]


def with_vectors(stages: Sequence[Transformer], df: DataFrame) -> DataFrame:
    """``df`` and its feature vector, by the stages of :func:`feature_stages`."""
    made = PipelineModel(list(stages)).transform(df)
    return made.select(*df.columns, VECTOR)


def fit_ranker(
    train: DataFrame,
    settings: ModelSettings,
    params: Mapping[str, Any] | None = None,
    val: DataFrame | None = None,
) -> PipelineModel:
    """Fit with the given MLlib parameters on top of the defaults.

    With ``val`` the rounds end when its loss stops falling, and the model has the
    trees up to the best round. Each boosting round is a distributed job; both tables
    should be stored ones. Where most rows are equal to others they are counted, and the
    trees are fitted to one weighted row of each kind: the sums are the same. In a table of
    ``BINNED_FROM`` rows or more, rows that differ within the learner's bins count as equal.
    """
    values = {"maxIter": settings.iterations, "seed": settings.random_state, **(params or {})}
    if val is not None:
        values = {"validationTol": 0.0, **values, "validationIndicatorCol": VALIDATION}
        train = train.withColumn(VALIDATION, F.lit(False)).unionByName(
            val.withColumn(VALIDATION, F.lit(True))
        )
    trees = GBTClassifier(featuresCol=VECTOR, labelCol=settings.label, **values)
    done, stages = [], feature_stages(settings.features)
    # Row by row are only what a node must hold at least, and the rows drawn for a tree.
    by_weight = trees.getMinInstancesPerNode() == 1 and trees.getSubsamplingRate() == 1.0
    if by_weight and not trees.isSet(trees.weightCol):
        others = [settings.label, *([] if val is None else [VALIDATION])]
        kinds = [*settings.features, *others]
        rows, different = seen_kinds(train, kinds)
        equal = 0 < 4 * different <= rows
        if not equal and rows >= BINNED_FROM:
            edges = bin_edges(train, settings.features, trees.getMaxBins())
            binned = feature_stages(settings.features, edges)
            made = PipelineModel(binned[:-1]).transform(train)
            columns = [*binned[-1].getInputCols(), *others]
            # Counting costs far less than what the learner does with a row.
            if edges and 2 * seen_kinds(made, columns)[1] <= rows:
                equal, train, kinds = True, made, columns
                done, stages = binned[:-1], binned[-1:]
        if equal:
            counted = train.groupBy(*kinds).agg(F.count(F.lit(1)).cast("double").alias(WEIGHT))
            train, trees = cut_lineage(counted, FIT_BYTES), trees.setWeightCol(WEIGHT)
    # The learner keeps each task's rows many times as large as they are stored.
    with small_reads(train.sparkSession, FIT_BYTES):
        fitted = Pipeline(stages=[*stages, trees]).fit(train)
    return PipelineModel([*done, *fitted.stages]) if done else fitted


def seen_kinds(df: DataFrame, columns: Sequence[str]) -> tuple[int, int]:
    """The number of rows, and about how many different ones there are."""
    seen = df.agg(F.count(F.lit(1)), F.approx_count_distinct(F.struct(*columns))).first()
    return seen[0], seen[1]


def bin_edges(df: DataFrame, features: Sequence[str], most: int) -> dict[str, list[float]]:
    """Inner edges of ``most`` bins, of about equally many rows, of each feature with more
    values than that; missing values have a bin of their own."""
    filled = feature_stages(features)[0].transform(df).select(*[f"{FILLED}{c}" for c in features])
    missing = F.expr(MISSING)
    counts = filled.agg(
        *[F.approx_count_distinct(f"{FILLED}{c}").alias(f"n_{c}") for c in features],
        *[F.count_if(F.col(f"{FILLED}{c}") == missing).alias(f"missing_{c}") for c in features],
    ).first()
    bins = {c: most - (counts[f"missing_{c}"] > 0) for c in features if counts[f"n_{c}"] > most}
    if not bins:
        return {}
    known = {c: F.nullif(F.col(f"{FILLED}{c}"), missing) for c in bins}
    found = filled.agg(
        *[
            F.percentile_approx(known[c], [i / n for i in range(1, n)], 1000).alias(c)
            for c, n in bins.items()
        ]
    ).first()
    apart = float(MISSING.rstrip("D")) / 2
    return {
        c: [*([apart] if n < most else []), *sorted(set(found[c]))] for c, n in bins.items()
    }


def mostly_equal(df: DataFrame, columns: Sequence[str]) -> bool:
    """Whether there are about four rows or more of each kind."""
    rows, different = seen_kinds(df, columns)
    return 0 < 4 * different <= rows


def trees_of(model: PipelineModel) -> GBTClassificationModel:
    return model.stages[-1]


def predict(model: PipelineModel, df: DataFrame, out: str = "pred") -> DataFrame:
    """Add the probability of label 1, or a listwise model's margin."""
    scored = model.transform(df)
    value = F.col("prediction")
    if isinstance(trees_of(model), GBTClassificationModel):
        value = F.get(vector_to_array("probability"), F.lit(1))
    return scored.withColumn(out, value).select(*[c for c in df.columns if c != out], out)


def evaluate_model(model: PipelineModel, df: DataFrame, settings: ModelSettings) -> DataFrame:
    """Metric table of a model on labelled rows."""
    return metric_table(
        predict(model, df),
        settings.list_k,
        label=settings.label,
        qid=settings.qid,
        item=settings.item,
    )


def evaluate_against_default(
    best: PipelineModel, default: PipelineModel, df: DataFrame, settings: ModelSettings
) -> DataFrame:
    return compare_models(
        evaluate_model(best, df, settings), evaluate_model(default, df, settings)
    )


def learning_curve(model: PipelineModel, train: DataFrame, val: DataFrame) -> DataFrame:
    """``iteration, train_loss, val_loss`` after each boosting round, from one pass."""
    names, label = feature_names_of(model), trees_of(model).getLabelCol()
    rows = train.select(*names, label, F.lit(False).alias(VALIDATION)).unionByName(
        val.select(*names, label, F.lit(True).alias(VALIDATION))
    )
    made = staged_margins(trees_of(model), with_vectors(model.stages[:-1], rows))
    staged = by_round(made.select(label, VALIDATION, "margins"))
    loss = logistic_loss(F.col(label), F.col("margin"))
    return staged.groupBy("iteration").agg(
        F.avg(F.when(~F.col(VALIDATION), loss)).alias("train_loss"),
        F.avg(F.when(F.col(VALIDATION), loss)).alias("val_loss"),
    )


def best_iteration(curve: DataFrame, patience: int) -> int:
    """The round with the lowest validation loss before ``patience`` rounds without a gain."""
    best, best_loss = 1, float("inf")
    for row in curve.orderBy("iteration").collect():
        if row["val_loss"] < best_loss:
            best, best_loss = row["iteration"], row["val_loss"]
        elif row["iteration"] - best >= patience:
            break
    return best


def refit_on_all(
    train: DataFrame,
    val: DataFrame,
    settings: ModelSettings,
    params: Mapping[str, Any],
    iterations: int,
) -> PipelineModel:
    """Fit on train and validation rows with a fixed number of rounds."""
    everything = train.unionByName(val)
    return fit_ranker(everything, settings, {**params, "maxIter": iterations})


def fit_default(train: DataFrame, val: DataFrame, settings: ModelSettings) -> PipelineModel:
    """The library's default parameters, on train and validation rows."""
    default_rounds = GBTClassifier().getMaxIter()
    return refit_on_all(train, val, settings, {}, default_rounds)


def retrain(
    df: DataFrame, settings: ModelSettings, params: Mapping[str, Any] | None = None
) -> PipelineModel:
    """Fit the same kind of model on new rows."""
    return fit_ranker(df, settings, params)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def score_top_k(
    model: PipelineModel,
    df: DataFrame,
    k: int = 3,
    user: str = "user_id",
    item: str = "movie_id",
    ordered: bool = False,
) -> DataFrame:
    """Predictions cut to the ``k`` best items per user."""
    return top_recommendations(predict(model, df), k, user, item, ordered=ordered)
