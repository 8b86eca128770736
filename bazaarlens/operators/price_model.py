"""A price model with its settings, for use without wiring the functions of ``operators.models`` together."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame

from bazaarlens.constants import SPLIT_SEED
from bazaarlens.operators import metrics, models
from bazaarlens.operators.features import FeatureSpec
from bazaarlens.operators.models import TunedModel
from bazaarlens.sources.artefacts import load_model, save_model


@dataclass
class PriceModel:
    """Settings of a price model and, once fitted or tuned, the model. With a ``path`` every fit is saved there."""

    model_name: str = "random_forest"
    spec: FeatureSpec = field(default_factory=FeatureSpec)
    folds: int = 3
    seed: int = SPLIT_SEED
    keys: Sequence[str] = ()
    path: str | None = None
    fitted: PipelineModel | None = None
    tuned: TunedModel | None = None

    def _keep(self, model: PipelineModel) -> PriceModel:
        self.fitted = model
        if self.path:
            save_model(model, self.path)
        return self

    def fit(self, train: DataFrame, **params) -> PriceModel:
        return self._keep(models.fit(train, self.model_name, self.spec, self.seed, **params))

    def tune(self, train: DataFrame, **options) -> PriceModel:
        """Searches the model's grid; the best point and all scores stay in ``tuned``."""
        self.tuned = models.tune(
            train, self.model_name, self.spec, folds=self.folds, seed=self.seed, keys=self.keys, **options
        )
        return self._keep(self.tuned.model)

    def predict(self, rows: DataFrame, load: bool = False) -> DataFrame:
        """``(price, log_prediction, prediction)``; ``load`` takes the model saved under ``path``."""
        if load:
            if not self.path:
                raise ValueError("no path to load a model from")
            self.fitted = load_model(self.path)
        if self.fitted is None:
            raise ValueError("fit, tune or load a model first")
        return models.predict(self.fitted, rows, self.spec)

    def evaluate(self, rows: DataFrame) -> DataFrame:
        """One row of scores of the model's predictions for the rows."""
        return metrics.evaluate(self.predict(rows))

    def save(self, path: str) -> None:
        """Saves the model under a path of its own, which must not exist yet."""
        if self.fitted is None:
            raise ValueError("fit, tune or load a model first")
        save_model(self.fitted, path, overwrite=False)
