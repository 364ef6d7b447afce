"""Feature table to fitted models, scores and lookups."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from trackfuse.functions.draws import fold_of
from trackfuse.functions.features import entity_id
from trackfuse.learning.stages import KINDS
from trackfuse.learning.train import (
    fit_prepared,
    label_counts,
    labelled,
    prepare,
    report_of,
    run_stamp,
    save_model,
    score,
)
from trackfuse.operators.averages import out_of_fold_join
from trackfuse.operators.enrich import inverse_count_weight
from trackfuse.operators.sampling import bootstrap_sample, poisson_bootstrap, random_split
from trackfuse.plans.features import AVERAGED
from trackfuse.schemas import CATEGORICAL, LABEL, NUMERICAL, PREDICTION_TABLE, PREDICTIONS
from trackfuse.session import stage
from trackfuse.streaming.sinks import (
    append_stream,
    ensure_tables,
    fan_out,
    key_value_json,
    message_sink,
    metrics_json,
    multi_sink,
)

ENTITY = ("ident", "origin_airport_icao", "scheduled_out")


def training_rows(
    features: DataFrame,
    fraction: float = 1.0,
    seed: int = 42,
    entity: Sequence[str] = ENTITY,
    categorical: Sequence[str] = CATEGORICAL,
    numerical: Sequence[str] = NUMERICAL,
    label: str = LABEL,
    folds: int | None = None,
    averaged: tuple[str, str] = AVERAGED,
    stable: bool = False,
) -> DataFrame:
    """Bootstrap, entity id and weight, in this order: the weights count drawn copies.

    The draw is written once, because counting and weighting both read it; a ``stable`` one depends on
    the rows' values alone (``poisson_bootstrap``) and needs no copy. The stored averages
    of the label hold the row's own label, which at scoring time nobody knows. With ``folds``
    the column ``averaged`` (its key, and its name) is made anew from entities of other folds.
    """
    columns = [*entity, *categorical, *numerical, label, *(averaged if folds else ())]
    rows = features.select(*dict.fromkeys(columns)).withColumn("flight_id", entity_id(*(F.col(c) for c in entity)))
    if folds:
        key, name = averaged
        rows = stage(rows.drop(name).withColumn("_fold", fold_of("flight_id", folds)), "folded")
        rows = out_of_fold_join(rows, key, label, "_fold", folds, name).drop("_fold")
    drawn = poisson_bootstrap(rows, fraction, seed) if stable else stage(bootstrap_sample(rows, fraction, seed), "drawn")
    return inverse_count_weight(drawn, "flight_id", "sample_weight")


def train_all(
    features: DataFrame,
    root: str,
    kinds: Sequence[str] = ("linear_regression", "decision_tree_regression", "boosted_regression"),
    test: float = 0.2,
    by_entity: bool = False,
    params: Mapping[str, Mapping] | None = None,
    categorical: Sequence[str] = CATEGORICAL,
    numerical: Sequence[str] = NUMERICAL,
    label: str = LABEL,
    entity: Sequence[str] = ENTITY,
    fraction: float = 1.0,
    seeds: tuple[int, int] = (42, 45),
    parts: tuple[DataFrame, DataFrame] | None = None,
    folds: int | None = None,
) -> tuple[dict[str, PipelineModel], DataFrame]:
    """Fit, save and evaluate each kind on one split; returns the models and the report.

    Columns, label, entity, drawn fraction and the seeds of draw and split are the
    caller's; ``folds`` keeps a row's own label out of the averages (``training_rows``). ``parts`` hands in (training, held-out) rows with a ``sample_weight`` instead.
    Rows are indexed and filled once for all kinds, and one pass over the held-out rows
    evaluates all of them. Rows without a label are left out; the report counts them.
    """
    if parts is None:
        rows = training_rows(features, fraction, seeds[0], entity, categorical, numerical, label, folds)
        parts = random_split(rows, test, seeds[1], split_by="flight_id" if by_entity else None)
    train, held_out = parts
    stamp = run_stamp()
    shared = PipelineModel(prepare(train, label, categorical, numerical))
    used = [*categorical, *numerical, label, "sample_weight"]
    ready, unseen = (
        stage(shared.transform(rows.select(*dict.fromkeys(used))), "prepared") for rows in (train, held_out)
    )
    models, scored = {}, labelled(unseen, label)
    for kind in kinds:
        extra = (params or {}).get(kind, {})
        models[kind], fitted = fit_prepared(
            ready, kind, label, categorical, numerical, "sample_weight", prepared=shared.stages, **extra
        )
        save_model(models[kind], root, kind, stamp)
        before = scored.columns
        scored = fitted.transform(scored).select(*before, F.col("prediction").alias(f"_{kind}"))
    lacking = label_counts(train.select(label).unionAll(held_out.select(label)), label)
    report = report_of(scored, {kind: f"_{kind}" for kind in kinds}, label, stamp).withColumn(
        "Unlabelled", lacking.select("unlabelled").scalar()
    )
    report = stage(report, "report")
    for kind in kinds:
        name = KINDS[kind][0]
        metrics_json(report.filter(F.col("Model") == name).drop("Unlabelled"), f"{root}/metrics_{name}_{stamp}.json")
    return models, report


def start_scoring(
    model: PipelineModel,
    features: DataFrame,
    checkpoints: str,
    messages: Mapping[str, str],
    table: str = PREDICTION_TABLE,
    fmt: str = "parquet",
    message_fmt: str = "kafka",
    root: str | None = None,
    trigger: Mapping | None = None,
    partition_by: Sequence[str] = (),
    shared_folders: Mapping[str, str] | None = None,
) -> list[StreamingQuery]:
    """Score a feature stream into a table and, keyed by flight, into a topic.

    The two sinks fail and resume apart, and each runs the model. With
    ``shared_folders`` (``rows`` and ``messages``) one query scores each batch once and writes both
    there, the second as key and value.
    """
    scored = score(model, features)
    if shared_folders is not None:
        shapes = {"rows": lambda rows: rows, "messages": lambda rows: key_value_json(rows, "ident")}
        return [fan_out(scored, shared_folders, shapes, f"{checkpoints}/shared", trigger)]
    ensure_tables(features.sparkSession, {table: PREDICTIONS}, fmt, root, {table: partition_by})
    return multi_sink(
        scored,
        [
            lambda rows: append_stream(
                rows, table, f"{checkpoints}/table", fmt, trigger=trigger, partition_by=partition_by
            ),
            lambda rows: message_sink(
                key_value_json(rows, "ident"), messages, f"{checkpoints}/messages", message_fmt, trigger
            ),
        ],
    )
