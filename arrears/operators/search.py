"""Random search whose fits run side by side and are kept in a ledger as they end."""

from __future__ import annotations

import json
import math
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arrears.operators.boosting import Blocks, Model, Settings, fit_all, fits_at_once, held_out_scores
from arrears.operators.model import MODEL_SEED, SEARCH_FOLDS, Candidate
from arrears.schemas import ddl

LEDGER_TYPES = {"training_set": "string", "seed": "bigint", "settings": "string", "fold": "int", "score": "double"}


@dataclass(frozen=True)
class BoostedSearch:
    model: Model
    candidates: list[Candidate]
    scores: list[float]
    best: int
    n_fits: int


def settings_text(candidate: Candidate) -> str:
    """The candidate as the ledger knows it."""
    return json.dumps({name: float(value) for name, value in sorted(candidate.items())})


class Ledger:
    """Scores of ended fits by training set, seed, candidate and fold, in a folder that readers can share."""

    def __init__(self, spark: SparkSession, path: str, training_set: str, seed: int):
        self.spark, self.path, self.training_set, self.seed = spark, path, training_set, seed

    def known(self) -> dict[tuple[str, int], float | None]:
        """Scores that this training set and seed already have; one row a fit."""
        try:
            table = read_ledger(self.spark, self.path)
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return {}
        own = table.where((F.col("training_set") == self.training_set) & (F.col("seed") == self.seed))
        return {(row.settings, row.fold): row.score for row in own.collect()}

    def add(self, fits: list[tuple[str, int]], scores: list[float | None]) -> None:
        rows = [(self.training_set, self.seed, text, fold, score) for (text, fold), score in zip(fits, scores, strict=True)]
        self.spark.createDataFrame(rows, ddl(LEDGER_TYPES)).coalesce(1).write.mode("append").parquet(self.path)


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(ddl(LEDGER_TYPES)).parquet(path)


def boosted_search(
    blocks: Blocks,
    candidates: list[Candidate],
    folds: int = SEARCH_FOLDS,
    seed: int = MODEL_SEED,
    ledger: Ledger | None = None,
    at_once: int | None = None,
) -> BoostedSearch:
    """Cross-validate the candidates on the blocks' folds and refit the best on all rows.

    A candidate's score is the mean over the folds of the AUC of its 0/1
    predictions. All fits grow level by level in the same jobs, ``at_once`` of
    them or as many as fit a task's memory. Fits that ``ledger`` knows are not
    repeated, and ended ones are added to it at once.
    """
    scores = ledger.known() if ledger else {}
    texts = [settings_text(c) for c in candidates]
    todo = {
        (text, fold): Settings(**candidate, fold=fold)
        for text, candidate in zip(texts, candidates, strict=True) for fold in range(folds) if (text, fold) not in scores
    }
    # Fits of as many trees end together, so those that share a wave should.
    names = sorted(todo, key=lambda name: todo[name].n_estimators)
    depth = max((s.max_depth for s in todo.values()), default=1)
    size = at_once or fits_at_once(blocks, depth)
    for a in range(0, len(names), size):
        wave = names[a : a + size]
        name_of = {todo[name]: name for name in wave}
        for models in fit_all(blocks, [todo[name] for name in wave], seed):
            ended = [name_of[m.settings] for m in models]
            found = held_out_scores(blocks, models)
            if ledger:
                ledger.add(ended, found)
            scores.update(zip(ended, found, strict=True))
    means = [_mean([scores[text, fold] for fold in range(folds)]) for text in texts]
    best = max(range(len(candidates)), key=lambda i: (not math.isnan(means[i]), means[i], -i))
    (model,) = next(fit_all(blocks, [Settings(**candidates[best])], seed))
    return BoostedSearch(model, candidates, means, best, len(names))


def _mean(values: list[float | None]) -> float:
    known = [value for value in values if value is not None]
    return sum(known) / len(known) if known else math.nan
