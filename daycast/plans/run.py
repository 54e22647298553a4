"""The full batch pipeline composed from the operators.

    ingest -> process -> merge -> prepare/validate -> gate -> decide ->
    train (flagged series only) -> load model (new, else registry) ->
    evaluate -> retrain flag -> forecast -> sinks

Everything is keyed by ``series_id``; the only rows that reach the driver are
the parameter table of the tuner, whose size is the number of trials.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daycast.operators import evaluate as EV
from daycast.operators import ridge as RG
from daycast.operators import validate as V
from daycast.operators.tune import best_trial, search
from daycast.plans import stages as P
from daycast.session import drop_stage, stage
from daycast.sources import sinks as SK

Preparator = Callable[[DataFrame, bool], tuple[DataFrame, DataFrame]]

BUSINESS_RULES = {"target": {"allow_negative": False}}


def default_preparator(full: DataFrame, is_training: bool) -> tuple[DataFrame, DataFrame]:
    """``DataFrame -> (prepared, report)``; training drops rows without a target."""
    prepared = P.prepared_train(full) if is_training else P.prepared_forecast(full)
    report = V.validation_report(prepared, target_col="y" if is_training else None, is_training=is_training,
                                 rules=BUSINESS_RULES)
    return prepared, report


def run_pipeline(spark: SparkSession, sf_dir: str, root: str, as_of: str, n_trials: int = 50,
                 preparator: Preparator = default_preparator) -> dict[str, DataFrame]:
    model_name = P.MODEL_RIDGE
    full = P.full_data(spark, sf_dir)

    # prepare + validate + gate (E5): invalid series go to the rejects frame
    prepared, report = preparator(full, True)
    nulls = V.null_counts(prepared.filter(F.col("y").isNotNull()))
    SK.save_report(V.report_document(report, nulls, V.data_types(prepared), as_of), root)
    valid_full, rejected = EV.gate(full, report)

    # decide (S12): flags of the last run, default True
    flags_in = EV.flags_with_default(valid_full.select("series_id"), SK.read_flags(spark, root))

    # train the flagged series (E6) with the tuner (M12-M14), keep the table
    design = stage(P.ridge_design(valid_full), "design")
    to_train = EV.train_flagged_only(design, flags_in)
    if not to_train.isEmpty():
        best = stage(best_trial(search(to_train, RG.Ridge(), n_trials), [*RG.DEFAULT_PARAMS, "mode_used"]), "best")
        # the fits of series not trained this run stay in the table
        SK.merge_artifact(RG.coefficients_table(RG.fit(to_train, best), model_name), root, "model",
                          ["model_name", "series_id"], ["model_name"])
        drop_stage(best)

    # load (M11): the model table now holds the new fits and, for series not
    # retrained, the previous run's fits; series with neither are unavailable
    if SK.has_artifact(spark, root, "model"):
        coef = RG.coefficients_from_table(SK.read_artifact(spark, root, "model").filter(F.col("model_name") == model_name))
    else:
        coef = spark.createDataFrame([], RG.COEF_SCHEMA)
    unavailable = design.select("series_id").distinct().join(coef, "series_id", "left_anti")

    # evaluate (E3) and flag
    scored = stage(P.ridge_scored(design, coef), "scored")
    metrics = EV.window_report(scored.filter(F.col("y").isNotNull()), model_name)
    SK.save_metrics(metrics, root, as_of)
    SK.append_metrics_history(metrics.withColumn("timestamp_utc", F.lit(as_of)), root)
    flags = EV.retrain_flag(metrics).select("series_id", "should_retrain")
    SK.save_flags(flags, root, as_of)

    # the forecast side has a gate of its own: series whose regressors do not
    # validate get no forecast, nor do series without a model
    from daycast.operators.serve import forecast_with_actuals

    _, report_forecast = preparator(valid_full, False)
    usable, rejected_forecast = EV.gate(valid_full, report_forecast)
    # forecast with actuals (J4) -> sink
    forecast = forecast_with_actuals(scored.filter(F.col("yhat").isNotNull()), usable)
    SK.save_forecast(forecast, root, model_name)
    return {"report": report, "rejected": rejected, "report_forecast": report_forecast,
            "rejected_forecast": rejected_forecast, "metrics": metrics, "flags": flags,
            "forecast": forecast, "unavailable": unavailable}
