"""What a reader of published artifacts asks: forecasts, movers, ranking and explanations."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weekpanel.operators import latest as L
from weekpanel.operators import model as M
from weekpanel.operators import movers as MV
from weekpanel.operators import trees as T
from weekpanel.operators.assemble import Features, from_contract, with_vector
from weekpanel.operators.encoding import category_codes
from weekpanel.operators.panel import HORIZONS
from weekpanel.sources import publish as PB

KEPT = ("id", "week_start", "name", "interest", "popularity", "vote_average")


@dataclass(frozen=True)
class Serving:
    """The published panel, metrics and models, with the category codes that the models were trained with."""

    panel: DataFrame
    metrics: DataFrame
    features: Features
    codes: DataFrame
    models: Mapping[int, T.Ensemble]


def load(spark: SparkSession, root: str, family: str = M.PRIMARY_FAMILY) -> Serving:
    """Follow the manifest; every reader of one manifest sees the same run."""
    found = PB.resolve(spark, root)
    panel = found["panel_clean"]
    models = M.load_models(spark, found["manifest"]["models"][f"{family}_dir"])
    features = from_contract(found["feature_columns"])
    codes = found["category_codes"]
    if codes is None:  # published without them: those of the published panel
        codes = category_codes(panel)
    return Serving(panel, found["metrics_history"], features, codes, models)


def latest_vectors(serving: Serving, panel: DataFrame | None = None) -> DataFrame:
    """Feature vectors of the latest rows, of all entities or of those in ``panel``."""
    latest = L.latest_per_entity(serving.panel if panel is None else panel)
    return with_vector(latest, serving.features, KEPT, serving.codes)


def entity_forecast(serving: Serving, entity_id, max_horizon: int = max(HORIZONS)) -> tuple[DataFrame, DataFrame]:
    """History and forecasts of one entity; raises if it is unknown."""
    rows = L.entity_history(serving.panel, entity_id)
    wanted = {h: m for h, m in serving.models.items() if h <= max_horizon}
    return rows.select("id", "week_start", "interest"), M.forecast_all(latest_vectors(serving, rows), wanted)


def trending(serving: Serving) -> DataFrame:
    """Every live entity with its t+1 prediction and the change it means, largest gain first."""
    scored = M.add_predictions(latest_vectors(serving), {1: serving.models[1]})
    return MV.movers_base(scored, "`raw_t+1`").orderBy(F.desc("`delta_t+1`"), F.asc("id"))


def overview(serving: Serving) -> DataFrame:
    """Every live entity with its prediction and popularity rank."""
    vectors = latest_vectors(serving)
    scored = M.add_predictions(vectors, {1: serving.models[1]})
    top = L.catalog_top(vectors.select("id", "popularity"))
    return MV.overview_ranked(MV.movers_base(scored, "`raw_t+1`"), top)


def explain(serving: Serving, entity_id, horizon: int = 1) -> tuple[DataFrame, DataFrame]:
    """The model's most important features, and what moved one entity's latest prediction."""
    rows = L.entity_history(serving.panel, entity_id)
    model, names = serving.models[horizon], serving.features.names()
    return (
        M.feature_importance(rows.sparkSession, model, names),
        M.local_contributions(latest_vectors(serving, rows), model, names),
    )
