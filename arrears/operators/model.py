"""Search space, stages from raw features to probabilities, and Spark ML's own boosted classifier.

The training job fits the models of :mod:`arrears.operators.boosting`; Spark ML's
trees, which know no leaf penalties, can be searched with :func:`random_search`.
"""

from __future__ import annotations

import math
import random
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from arrears.operators.boosting import Model
from arrears.operators.metrics import hard_auc
from arrears.operators.scaling import Scaler
from arrears.schemas import quoted

# Model seed, search seed, candidates and folds of the search.
MODEL_SEED = 88
SEARCH_SEED = 42
SEARCH_CANDIDATES = 100
SEARCH_FOLDS = 3

# The lists the search draws from.
SEARCH_SPACE = {
    "n_estimators": [25, 50],
    "max_depth": [2, 3],
    "learning_rate": [0.01, 0.1],
    "subsample": [0.6, 0.8],
    "colsample_bytree": [0.6, 0.8],
    "gamma": [0, 0.1],
    "min_child_weight": [1, 3, 5],
    "reg_alpha": [0, 0.1, 1],
    "reg_lambda": [1, 1.5, 2],
}

#: A row's second derivative of the logistic loss is at most a quarter.
_ROWS_PER_WEIGHT = 4

# Spark's name of each parameter. The trees of Spark ML have no L1 or L2 penalty
# on their leaves: reg_alpha and reg_lambda are drawn, not applied.
GBT_PARAMS = {
    "n_estimators": "maxIter",
    "max_depth": "maxDepth",
    "learning_rate": "stepSize",
    "subsample": "subsamplingRate",
    "colsample_bytree": "featureSubsetStrategy",
    "gamma": "minInfoGain",
    "min_child_weight": "minInstancesPerNode",
}

Candidate = dict[str, float]


def draw_candidates(
    n: int = SEARCH_CANDIDATES,
    space: dict[str, list] | None = None,
    seed: int = SEARCH_SEED,
) -> list[Candidate]:
    """``n`` different combinations of the space, or all when it has fewer."""
    space = SEARCH_SPACE if space is None else space
    size = math.prod(map(len, space.values()))
    picks = random.Random(seed).sample(range(size), min(n, size))
    return [combination(space, pick) for pick in picks]


def combination(space: dict[str, list], number: int) -> Candidate:
    """The combination with this number; the last list's values follow each other."""
    chosen = {}
    for name, values in reversed(space.items()):
        number, place = divmod(number, len(values))
        chosen[name] = values[place]
    return {name: chosen[name] for name in space}


def spark_params(candidate: Candidate, n_rows: int) -> dict[str, object]:
    """Arguments of ``GBTClassifier`` for a candidate fitted on ``n_rows`` rows.

    ``gamma`` is a gain summed over the rows, Spark's is one per row;
    ``min_child_weight`` is a sum of second derivatives, Spark counts rows.
    """
    params = {GBT_PARAMS[name]: value for name, value in candidate.items() if name in GBT_PARAMS}
    if "featureSubsetStrategy" in params:
        params["featureSubsetStrategy"] = str(params["featureSubsetStrategy"])
    if "minInfoGain" in params:
        params["minInfoGain"] = params["minInfoGain"] / max(1, n_rows)
    if "minInstancesPerNode" in params:
        params["minInstancesPerNode"] = max(1, math.ceil(_ROWS_PER_WEIGHT * params["minInstancesPerNode"]))
    return params


def classifier(candidate: Candidate, n_rows: int, seed: int = MODEL_SEED) -> GBTClassifier:
    return GBTClassifier(
        featuresCol="features", labelCol="label", lossType="logistic", seed=seed,
        **spark_params(candidate, n_rows),
    )


def preparation(scaler: Scaler) -> list[Transformer]:
    """Stages from raw features to the model's vector; they are saved with the model.

    Scaled features keep missing values out of the trees: a missing one sits at
    the train mean and raises a flag of its own.
    """
    terms = []
    for i, name in enumerate(scaler.mean):
        value = f"CAST({quoted(name)} AS DOUBLE)"
        missing = f"({value} IS NULL OR isnan({value}))"
        mean, scale = scaler.mean[name], scaler.scale[name]
        scaled = "0D" if mean is None else f"({value} - {mean!r}D) / {scale!r}D"
        terms.append(f"CASE WHEN {missing} THEN 0D ELSE {scaled} END AS z_{i}")
        terms.append(f"CASE WHEN {missing} THEN 1D ELSE 0D END AS missing_{i}")
    count = range(len(scaler.mean))
    inputs = [f"z_{i}" for i in count] + [f"missing_{i}" for i in count]
    return [
        SQLTransformer(statement=f"SELECT *, {', '.join(terms)} FROM __THIS__"),
        VectorAssembler(inputCols=inputs, outputCol="features"),
    ]


def input_names(scaler: Scaler) -> list[str]:
    """What each element of the model's vector stands for."""
    return [*scaler.mean, *[f"{name} missing" for name in scaler.mean]]


def scaled_inputs(scaler: Scaler) -> SQLTransformer:
    """Stage from raw features to scaled ones, NULL where missing: trees route missing rows themselves."""
    terms = []
    for i, name in enumerate(scaler.mean):
        value = f"CAST({quoted(name)} AS DOUBLE)"
        mean, scale = scaler.mean[name], scaler.scale[name]
        scaled = "CAST(NULL AS DOUBLE)" if mean is None else f"({value} - {mean!r}D) / {scale!r}D"
        terms.append(f"CASE WHEN isnan({value}) THEN NULL ELSE {scaled} END AS z_{i}")
    return SQLTransformer(statement=f"SELECT *, {', '.join(terms)} FROM __THIS__")


def scaled_names(scaler: Scaler) -> list[str]:
    return [f"z_{i}" for i in range(len(scaler.mean))]


def boosted_pipeline(scaler: Scaler, model: Model) -> PipelineModel:
    """Scaling and a fitted model's trees as SQL: scoring stays one generated stage."""
    margin = model.margin(scaled_names(scaler))
    scores = SQLTransformer(statement=f"SELECT *, 1D / (1D + exp(-({margin}))) AS probability FROM __THIS__")
    return PipelineModel([scaled_inputs(scaler), scores])


def probability(scored: DataFrame) -> Column:
    """Probability of class 1 in a transformed frame."""
    column = F.col("probability")
    return column if scored.schema["probability"].dataType == DoubleType() else vector_to_array(column)[1]


@dataclass(frozen=True)
class SearchResult:
    model: GBTClassificationModel
    candidates: list[Candidate]
    scores: list[float]
    best: int
    n_rows: int


def random_search(
    train: DataFrame,
    candidates: list[Candidate],
    folds: int = SEARCH_FOLDS,
    parallelism: int = 8,
    seed: int = MODEL_SEED,
) -> SearchResult:
    """Cross-validate the candidates on ``fold`` and refit the best on all rows.

    ``train`` has ``features``, ``label`` and ``fold`` and is read once per fit,
    so it should be persisted. A candidate's score is the mean over folds of
    the AUC of its 0/1 predictions. Candidates that Spark cannot tell apart are
    fitted once. Each of the ``parallelism`` fits that run side by side keeps a
    copy of its rows while it runs.
    """
    distinct = {_identity(candidate): candidate for candidate in candidates}
    # One row per fold.
    sizes = {row.fold: row["count"] for row in train.groupBy("fold").count().collect()}
    n_rows = sum(sizes.values())

    def score(job: tuple[tuple, int]) -> float | None:
        identity, fold = job
        rest = train.where(F.col("fold") != fold)
        model = classifier(distinct[identity], n_rows - sizes.get(fold, 0), seed).fit(rest)
        held_out = model.transform(train.where(F.col("fold") == fold))
        row = hard_auc(held_out, "fold", "prediction").first()
        return None if row is None else row.auc

    jobs = [(identity, fold) for identity in distinct for fold in range(folds)]
    with ThreadPoolExecutor(parallelism) as pool:
        runs = [
            pool.submit(inheritable_thread_target(train.sparkSession)(score), job) for job in jobs
        ]
        results = dict(zip(jobs, [run.result() for run in runs], strict=True))

    means = {identity: _mean(results[identity, fold] for fold in range(folds))
             for identity in distinct}
    scores = [means[_identity(candidate)] for candidate in candidates]
    best = max(range(len(candidates)), key=lambda i: (not math.isnan(scores[i]), scores[i], -i))
    model = classifier(candidates[best], n_rows, seed).fit(train)
    return SearchResult(model, candidates, scores, best, n_rows)


def fitted_pipeline(scaler: Scaler, model: GBTClassificationModel) -> PipelineModel:
    return PipelineModel([*preparation(scaler), model])


def _identity(candidate: Candidate) -> tuple:
    return tuple(sorted((name, value) for name, value in candidate.items() if name in GBT_PARAMS))


def _mean(values) -> float:
    known = [value for value in values if value is not None]
    return sum(known) / len(known) if known else math.nan
