"""A trained deployment: feature model, fold models, calibrator and thresholds in one folder."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.regression import IsotonicRegressionModel
from pyspark.sql import DataFrame, SparkSession

from flowvigil.config import Thresholds
from flowvigil.operators import learning, prepare
from flowvigil.operators.features import FeatureModel
from flowvigil.sources.settings import load_thresholds, save_thresholds
from flowvigil.sources.sinks import load_models, read_text, save_models, write_text


@dataclass(frozen=True)
class Deployment:
    """What turns flows into calibrated scores. ``score`` fits ``LiveRun.score``."""

    features: FeatureModel
    models: Sequence[GBTClassificationModel]
    calibrator: IsotonicRegressionModel
    thresholds: Thresholds = Thresholds()

    def save(self, spark: SparkSession, folder: str) -> None:
        write_text(spark, self.features.to_json(), f"{folder}/features")
        save_models(self.models, f"{folder}/folds")
        self.calibrator.write().overwrite().save(f"{folder}/calibrator")
        # Last, so that a folder with thresholds is complete.
        save_thresholds(spark, self.thresholds, f"{folder}/thresholds")

    @staticmethod
    def load(spark: SparkSession, folder: str) -> Deployment:
        return Deployment(
            FeatureModel.from_json(read_text(spark, f"{folder}/features")),
            load_models(spark, f"{folder}/folds"),
            IsotonicRegressionModel.load(f"{folder}/calibrator"),
            load_thresholds(spark, f"{folder}/thresholds"),
        )

    def score(self, flows: DataFrame) -> DataFrame:
        """The flows with ``p_raw`` (mean of the fold models) and ``p_cal``."""
        kept = [c for c in flows.columns if c not in ("p_raw", "p_cal")]
        rows = prepare.with_direction(prepare.with_service_norm(flows.select(*kept)))
        matrix = learning.assemble(self.features.matrix(rows, kept), self.features.columns)
        scored = learning.ensemble_score(matrix, self.models, self.calibrator, self.thresholds.threshold)
        return scored.select(*kept, "p_raw", "p_cal")
