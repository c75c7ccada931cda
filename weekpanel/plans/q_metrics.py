"""Queries on the metrics history."""

from __future__ import annotations

from pyspark.sql import functions as F

from weekpanel.operators import metrics as MH
from weekpanel.plans import inputs as I
from weekpanel.plans.registry import query
from weekpanel.plans.sql import with_ctes

_RECORD = "run_id, family, horizon, created_utc, rmse_train, rmse_val, r2_train, r2_val, n_train, n_val"


@query("metrics_append_dedupe", with_ctes("history", f"select {_RECORD} from history"))
def metrics_append_dedupe(spark, sf):
    return I.history(spark, sf)


@query(
    "metrics_append_plain",
    with_ctes(
        "metrics_old metrics_new",
        f"""select {_RECORD}, null as note, 'old' as ts from metrics_old
union all select {_RECORD}, 'second batch', 'new' from metrics_new""",
    ),
)
def metrics_append_plain(spark, sf):
    old = MH.append_plain(None, I.metric_records(spark, sf, "old").withColumn("ts", F.lit("old")))
    new = I.metric_records(spark, sf, "new").withColumn("note", F.lit("second batch"))
    # New records get the current time; only whether they have one can be compared.
    both = MH.append_plain(old, new)
    stamped = F.col("ts").rlike(r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\dZ$")
    return both.withColumn("ts", F.when(stamped, "new").otherwise(F.col("ts")))


@query(
    "metrics_run_kpis",
    with_ctes(
        "history",
        """select family, run_id, string_agg(distinct cast(horizon as varchar), ',' order by cast(horizon as varchar)) as horizons,
        min(rmse_val) as rmse_best, round(avg(rmse_val), 8) as rmse_avg, round(avg(r2_val), 8) as r2_avg
from history group by family, run_id""",
    ),
)
def metrics_run_kpis(spark, sf):
    kpis = MH.run_kpis(I.history(spark, sf))
    text = F.array_join(F.transform("horizons", lambda h: h.cast("string")), ",")
    return I.rounded(kpis.withColumn("horizons", text), "rmse_avg", "r2_avg", digits=8)


@query(
    "metrics_of_run",
    with_ctes("history", f"select {_RECORD} from history where family = 'urgent' and run_id = 'run_1998'"),
)
def metrics_of_run(spark, sf):
    return MH.of_run(I.history(spark, sf), "urgent", "run_1998")


@query(
    "metrics_by_horizon",
    with_ctes(
        "history",
        """select run_id, horizon, round(avg(rmse_val), 8) as rmse_val, round(avg(r2_val), 8) as r2_val,
        round(avg(rmse_train), 8) as rmse_train, round(avg(r2_train), 8) as r2_train,
        max(n_train) as n_train, max(n_val) as n_val
from history group by run_id, horizon""",
    ),
)
def metrics_by_horizon(spark, sf):
    means = MH.by_horizon(I.history(spark, sf), ("run_id",))
    return I.rounded(means, "rmse_val", "r2_val", "rmse_train", "r2_train", digits=8)


@query(
    "metrics_runs",
    with_ctes("history", "select distinct created_utc, run_id, left(created_utc, 10) as week_start from history"),
)
def metrics_runs(spark, sf):
    return MH.runs(I.history(spark, sf).withColumn("week_start", F.left("created_utc", F.lit(10))))


@query(
    "metrics_family_counts",
    with_ctes("history", "select run_id, family, count(*) as n from history group by run_id, family"),
)
def metrics_family_counts(spark, sf):
    return MH.family_counts(I.history(spark, sf))
