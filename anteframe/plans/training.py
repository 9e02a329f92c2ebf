"""The training table: labelled procedures, lab features, comorbidity flags."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import vocab
from ..columns import col
from ..functions import codes
from ..operators.joins import attach
from .cohort import comorbidity_flags
from .labs import (
    ANCHOR,
    CASE,
    lab_features,
    latest_labs,
    procedures_with_lab_features,
    with_window_start,
)
from .profiles import coverage_curve

EFFECTIVE_ID = "parameterid_effektiv"


def procedures_for_training(labelled: DataFrame) -> DataFrame:
    """Distinct procedures with one of the two clear labels, given with confidence."""
    sure = codes.confident_label(col("predicted_label"), col("confidence"))
    return labelled.distinct().where(sure)


def training_table(
    labelled: DataFrame,
    labs: DataFrame,
    diags: DataFrame,
    hours: float = vocab.LOOKBACK_HOURS,
    ids: Sequence[str] | None = None,
    variant: str = "complete",
    keep_unmatched: bool = False,
) -> DataFrame:
    """One row per labelled procedure with a lab value (or all, with ``keep_unmatched``)."""
    procs = procedures_for_training(labelled)
    rows = attach(
        with_window_start(procs, hours),
        lab_features(procs, labs, hours, variant, ids),
        on=[CASE, ANCHOR],
        keep_unmatched=keep_unmatched,
    )
    return with_comorbidities(rows, procs, diags).withColumn(
        "predicted_label_int", codes.binary_label(col("predicted_label"))
    )


def with_comorbidities(rows: DataFrame, procs: DataFrame, diags: DataFrame) -> DataFrame:
    return attach(
        rows,
        comorbidity_flags(procs, diags),
        on=[CASE, ANCHOR],
        keep_unmatched=True,
        fill_false=vocab.COMORBIDITY_FLAGS,
    )


def merge_labs(procs: DataFrame, labs: DataFrame, hours: float = vocab.LOOKBACK_HOURS) -> DataFrame:
    """Every procedure with text key and lab features, null where there is no value."""
    return procedures_with_lab_features(procs, labs, hours, keep_unmatched=True)


def merge_diagnoses(procs: DataFrame, diags: DataFrame) -> DataFrame:
    """Every procedure with its flags, null where there is no earlier diagnosis."""
    return attach(procs, comorbidity_flags(procs, diags), on=[CASE, ANCHOR], keep_unmatched=True)


def feature_tradeoff(
    labelled: DataFrame, labs: DataFrame, hours: float = vocab.LOOKBACK_HOURS
) -> DataFrame:
    """How many procedures stay when the k most frequent parameters are required."""
    latest = latest_labs(procedures_for_training(labelled), labs, hours)
    return coverage_curve(latest, case=[CASE, ANCHOR], dim=EFFECTIVE_ID)


def selection_counts(labelled: DataFrame) -> DataFrame:
    """Labelled rows and how many of them are used for training."""
    kept = procedures_for_training(labelled).agg(F.count("*")).scalar()
    return labelled.agg(F.count("*").alias("n_labelled")).withColumn("n_used", kept)
