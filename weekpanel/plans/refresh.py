"""The stages put together: panel, clean panel, training, validation, publication."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from weekpanel.functions.casts import clean_nonfinite
from weekpanel.functions.dates import utc_iso
from weekpanel.operators import features as X
from weekpanel.operators import metrics as MH
from weekpanel.operators import model as M
from weekpanel.operators import tfidf as T
from weekpanel.operators.assemble import GENRES, NETWORKS, PREFIXES, Features, describe, with_vector
from weekpanel.operators.encoding import category_codes
from weekpanel.operators.panel import (
    HORIZONS,
    add_targets,
    add_time_features,
    attach_catalog,
    clean_trends,
    prepare_catalog,
)
from weekpanel.operators.split import snapshot, time_split
from weekpanel.session import configured, cut_lineage
from weekpanel.sources import publish as PB
from weekpanel.sources.tables import read_parquet, write_by_key, write_parquet, write_vocabulary

#: Aggregates over rows that are sorted by their keys read them in order; all others stay as they are.
SORTED_AGGREGATES = {"spark.sql.execution.replaceHashWithSortAgg": "true"}


def clean_entities(
    panel: DataFrame,
    catalog: DataFrame,
    *,
    n_genres: int = X.TOP_GENRES,
    n_networks: int = X.TOP_NETWORKS,
    n_terms: int = X.TOP_TERMS,
    vocabulary: Sequence[str] | None = None,
) -> tuple[DataFrame, dict[str, list[str]], T.Terms]:
    """Entity features, the kept genres and networks, and the fitted terms.

    The weighted entity table feeds several aggregates and is written out once. The joins of the
    imputation come last, so that no other step repeats them.
    """
    entities = cut_lineage(X.weighted_entities(panel, prepare_catalog(catalog)))
    listed, kept = entities, {}
    for column, n, out in (("genres", n_genres, GENRES), ("networks", n_networks, NETWORKS)):
        kept[out] = X.names_of(X.top_tokens(entities, column, n))
        listed = X.keep_tokens(listed, column, kept[out], out)
    scored, fitted = T.tfidf(listed, "keywords", n_terms, "n_weeks", vocabulary)
    return X.impute_group_median(X.impute_mode(scored)), kept, fitted


def clean_panel(panel: DataFrame, entities: DataFrame) -> DataFrame:
    """Panel rows with their entity's features and the freshness columns, in narrow form."""
    own = [c for c in panel.columns if c == "id" or c not in entities.columns]
    return X.freshness(panel.select(*own).join(entities.drop("n_weeks"), "id"))


def fitted_frame(
    clean: DataFrame,
    spec: Features,
    horizons: Sequence[int] = HORIZONS,
    codes: DataFrame | None = None,
    *,
    purge: int = 0,
) -> DataFrame:
    """Feature vectors with split and targets, ready for all horizons.

    Targets that the rows bring along are used; else they are computed here.
    """
    targets = [f"interest_t+{h}" for h in horizons]
    known = clean if set(targets) <= set(clean.columns) else add_targets(clean, horizons)
    split = time_split(known, purge=purge)
    return with_vector(split, spec, ["id", "week_start", "split", "cutoff_week", *targets], codes)


def frame_shape(clean: DataFrame, spec: Features, horizons: Sequence[int]) -> dict:
    """The snapshot kept with the metrics; columns are counted in wide form with the targets."""
    names = spec.names()
    shape = snapshot(clean, len(names)).first().asDict()
    narrow = [c for c in clean.columns if c not in PREFIXES]
    shape["n_cols"] = len(narrow) + len(names) - len(spec.scalars) + len(horizons)
    return shape


def refresh(
    spark: SparkSession,
    trends: DataFrame,
    catalog: DataFrame,
    root: str,
    run: Mapping[str, str],
    *,
    retrain: bool = True,
    horizons: Sequence[int] = HORIZONS,
    settings: Mapping[str, Mapping[str, object]] | None = None,
    sizes: Mapping[str, int] | None = None,
    vocabulary: Sequence[str] | None = None,
    purge: int = 0,
    collapse: bool = True,
    min_week: str | None = None,
    max_week: str | None = None,
    catalog_order: Sequence[str] | None = None,
) -> dict:
    """Build and, with ``retrain``, train, validate and publish one run under ``root``.

    Each stage is written before the next reads it, so a lost executor repeats only its own stage.
    """
    # A folder of its own for each attempt: what is published from it is never written over.
    stage = f"{root}/stages/run_id={run['run_id']}/week_start={run['week_start']}/{uuid.uuid4().hex}"
    # Everything that meets by id is staged in buckets by id, so that no later step moves it again.
    catalog = write_by_key(prepare_catalog(catalog, catalog_order), f"{stage}/catalog", dealt=True)
    bounds = {"min_week": min_week, "max_week": max_week, "collapse": collapse}
    # The series with features and targets stays narrow; only the published tables carry metadata.
    series = add_targets(add_time_features(clean_trends(trends, **bounds)), horizons)
    # A series that comes sorted by id and week is averaged in that order, without a hash table of its rows.
    with configured(spark, SORTED_AGGREGATES):
        series = write_by_key(series, f"{stage}/series", order=["week_start"], dealt=True)
    targets = [f"interest_t+{h}" for h in horizons]
    panel = clean_nonfinite(attach_catalog(series.drop(*targets), catalog))
    entities, kept, fitted = clean_entities(series, catalog, vocabulary=vocabulary, **(sizes or {}))
    entities = write_by_key(entities, f"{stage}/entities")
    write_parquet(clean_nonfinite(clean_panel(series, entities)), f"{stage}/panel_clean")
    write_vocabulary(fitted.frame(spark), f"{stage}/tfidf_vocab")
    staged = read_parquet(spark, f"{stage}/panel_clean")
    clean = staged.drop(*targets)
    spec = describe(clean, kept[GENRES], kept[NETWORKS], fitted.names)
    out = {"panel": panel, "panel_clean": clean, "features": spec, "terms": fitted}
    if not retrain:
        return out

    # The categories are an entity's own, so that its rows need not be read for them.
    write_parquet(category_codes(entities), f"{stage}/category_codes")
    codes = read_parquet(spark, f"{stage}/category_codes")
    # Written first, so that the fits read partitions sized by data, and lost ones come back from files.
    write_parquet(fitted_frame(staged, spec, horizons, codes, purge=purge), f"{stage}/training")
    frame = read_parquet(spark, f"{stage}/training").persist(StorageLevel.MEMORY_AND_DISK)
    records, folders = [], {}
    for family in M.FAMILIES:
        models, found = M.train_family(frame, family, horizons, (settings or {}).get(family))
        folder = f"{PB.models_root(root, run['run_id'], run['week_start'])}/{family}"
        M.save_models(spark, models, folder)
        folders[f"{family}_dir"] = folder
        records += found
    frame.unpersist()
    context = {**run, **frame_shape(clean, spec, horizons)}
    new = MH.with_run(M.records_frame(spark, records).drop("n_trees"), context).withColumn("created_utc", utc_iso())

    for folder in folders.values():
        M.require_valid(M.validate(clean, spec, codes=codes, folder=folder))
    seen = PB.current_generation(spark, root)
    generation = PB.publish(
        clean, spec.names(), root, run, folders, new_metrics=new, codes=codes, panel_path=f"{stage}/panel_clean",
        expected_generation=seen,
    )
    return {**out, "codes": codes, "records": records, "generation": generation, "folders": folders}
