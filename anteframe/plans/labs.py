"""Laboratory values: merged sources, numeric and harmonised, as features of procedures."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .. import vocab
from ..columns import all_present, col
from ..functions import codes, ranges, times
from ..functions.numbers import add_numeric_columns, lenient_decimal
from ..operators.asof import latest_per_dimension, maybe_known
from ..operators.features import complete_cases, completeness, pivot_values
from ..operators.joins import attach, null_safe_join
from ..operators.sets import union_all

CASE, ANCHOR = "Fallnummer", "prozedur_datetime"
SAMPLED, RESULTED = "Probeneingangsdatum", "Ergebnisdatum"
RESULT, LAB_ID = "Ergebniswert", "Parameter-ID primär"
NUMBER, EFFECTIVE_AT, EFFECTIVE_ID = (
    "ergebniswert_num",
    "abnahmezeitpunkt_effektiv",
    "parameterid_effektiv",
)
LAB_COLUMNS = [CASE, SAMPLED, RESULTED, RESULT, LAB_ID]
DEVICE_COLUMNS = ["FallNr", "AuftSortDatZeit", "ErgeDatZeit", "Ergebnis", "AnfoCode"]


def from_device_columns(df: DataFrame) -> DataFrame:
    """The device exports under the common column names."""
    return df.select(*[col(a).alias(b) for a, b in zip(DEVICE_COLUMNS, LAB_COLUMNS)])


def complete_labs(
    main: DataFrame,
    late: DataFrame,
    blood_gas: DataFrame,
    potassium: DataFrame,
    glucose: DataFrame,
    distinct: bool = True,
) -> DataFrame:
    """All five sources as one table of distinct complete rows.

    Without ``distinct`` copies stay: for callers that remove them later anyway.
    """
    gas = blood_gas.withColumn(SAMPLED, F.coalesce(col(SAMPLED), col(RESULTED))).where(
        codes.differs(col(LAB_ID), vocab.SAMPLE_KIND_ID)
    )
    parts = [main, late, gas, from_device_columns(potassium), from_device_columns(glucose)]
    rows = union_all(*[p.select(*map(col, LAB_COLUMNS)) for p in parts]).drop(RESULTED)
    rows = rows.na.drop("any")
    return rows.distinct() if distinct else rows


def relevant_labs(labs: DataFrame, variant: str = "complete") -> DataFrame:
    """Rows with a numeric result, a case and a time; ``reduced`` keeps the short id list."""
    _check_variant(variant)
    rows = labs.withColumn(NUMBER, lenient_decimal(col(RESULT)))
    if variant == "reduced":
        rows = rows.where(col(LAB_ID).isin(*vocab.LAB_IDS_REDUCED))
    return rows.where(all_present([NUMBER, CASE, SAMPLED]))


def unusable_times(labs: DataFrame) -> DataFrame:
    """Rows, and how many have a sampling time that is no ISO time with an offset."""
    fits = times.offset_timestamp(col(SAMPLED), strict=False).isNotNull()
    return labs.agg(
        F.count("*").alias("n_rows"),
        F.count_if(col(SAMPLED).isNotNull() & ~fits).alias("n_unusable"),
    )


def harmonised_labs(
    labs: DataFrame, local_tz: str | None = None, strict: bool = True
) -> DataFrame:
    """Effective sampling time and common parameter id; distinct rows.

    Times are naive UTC; with ``local_tz`` they are local, as procedure times are, and a clock
    time in an id is then put on the local day. A wrong time raises; with ``strict=False`` it is
    null, and ``unusable_times`` counts such rows.
    """
    return (
        labs.withColumn(SAMPLED, times.offset_timestamp(col(SAMPLED), local_tz, strict))
        .withColumn(
            EFFECTIVE_AT,
            times.embedded_clock_time(col(LAB_ID), col(SAMPLED), vocab.CLOCK_ID_PATTERN),
        )
        .withColumn(EFFECTIVE_ID, codes.common_code(col(LAB_ID)))
        .distinct()
    )


def labs_from_sources(
    sources: dict[str, DataFrame], variant: str = "complete", local_tz: str | None = None
) -> DataFrame:
    rows = complete_labs(**sources, distinct=False)
    return harmonised_labs(relevant_labs(rows, variant), local_tz)


def distinct_lab_ids(labs: DataFrame) -> DataFrame:
    return labs.select(col(EFFECTIVE_ID)).distinct()


def latest_labs(
    procedures: DataFrame,
    labs: DataFrame,
    hours: float = vocab.LOOKBACK_HOURS,
    ids: Sequence[str] | None = None,
) -> DataFrame:
    """The newest value per procedure and parameter in the look-back window."""
    return latest_per_dimension(
        procedures,
        maybe_known(labs, procedures, key=CASE),
        key=CASE,
        anchor_ts=ANCHOR,
        fact_ts=EFFECTIVE_AT,
        dim=EFFECTIVE_ID,
        value=NUMBER,
        hours=hours,
        dims=ids,
    )


def with_window_start(procedures: DataFrame, hours: float) -> DataFrame:
    start = col(ANCHOR) - F.make_dt_interval(hours=F.lit(hours))
    return procedures.withColumn("prozedur_fenster_start", start)


def _check_variant(variant: str) -> None:
    if variant not in ("complete", "reduced"):
        raise ValueError(f"unknown variant {variant!r}")


#: A table gets at most so many columns of parameters that are not listed beforehand.
MOST_COLUMNS = 2000


def _ids(labs: DataFrame, variant: str, ids: Sequence[str] | str | None) -> list[str]:
    _check_variant(variant)
    if isinstance(ids, str):
        if ids != "all":
            raise ValueError(f"ids is a list or 'all', not {ids!r}")
        found = distinct_lab_ids(labs).where(col(EFFECTIVE_ID).isNotNull())
        every = [r[0] for r in found.limit(MOST_COLUMNS + 1).collect()]
        if len(every) > MOST_COLUMNS:
            raise ValueError(f"more than {MOST_COLUMNS} parameters: use feature_maps")
        return sorted(every)
    reduced = variant == "reduced"
    return list(ids or (vocab.LAB_FEATURES_REDUCED if reduced else vocab.LAB_FEATURES))


def _of_variant(labs: DataFrame, variant: str) -> DataFrame:
    """The reduced variant goes by the ids as they come, before synonyms are merged."""
    return labs.where(col(LAB_ID).isin(*vocab.LAB_IDS_REDUCED)) if variant == "reduced" else labs


def unlisted_values(labs: DataFrame, ids: Sequence[str] = tuple(vocab.LAB_FEATURES)) -> DataFrame:
    """Parameters without a feature column, with their number of values."""
    return labs.where(~col(EFFECTIVE_ID).isin(*ids)).groupBy(col(EFFECTIVE_ID)).agg(F.count("*").alias("n"))


def lab_features(
    procedures: DataFrame,
    labs: DataFrame,
    hours: float = vocab.LOOKBACK_HOURS,
    variant: str = "complete",
    ids: Sequence[str] | str | None = None,
) -> DataFrame:
    """One row per procedure with at least one value of any parameter, a column per parameter id.

    ``ids`` sets the columns, not the rows; with "all" they are those that occur, by one more pass
    (``unlisted_values`` counts what has no column). ``reduced`` looks only at the ids of the short
    list, as they come, and keeps only procedures with every value.
    """
    labs = _of_variant(labs, variant)
    wanted = _ids(labs, variant, ids)
    # Parameters without a column still make the row of their procedure.
    latest = latest_labs(procedures, labs, hours)
    wide = pivot_values(latest, index=[CASE, ANCHOR], dim=EFFECTIVE_ID, value=NUMBER, values=wanted)
    return complete_cases(wide, wanted) if variant == "reduced" else wide


def feature_maps(procedures: DataFrame, labs: DataFrame, hours: float = vocab.LOOKBACK_HOURS) -> DataFrame:
    """The newest value of every parameter as a map, one row per procedure with any value.

    For parameters that nobody has listed: no pass on the driver and no column per parameter.
    ``feature_dictionary`` numbers the keys as a table of its own, and ``feature_vectors`` puts
    the numbers in place of the keys.
    """
    latest = latest_labs(procedures, labs, hours)
    entries = F.sort_array(F.collect_list(F.struct(col(EFFECTIVE_ID), col(NUMBER))))
    return latest.groupBy(col(CASE), col(ANCHOR)).agg(F.map_from_entries(entries).alias("features"))


def feature_dictionary(maps: DataFrame) -> DataFrame:
    """Each parameter in ``maps`` with its column number from 0, by name, and its number of values.

    The window without a partition holds one row per parameter, as the dictionary does.
    """
    keys = maps.select(F.explode(F.map_keys("features")).alias(EFFECTIVE_ID))
    counts = keys.groupBy(col(EFFECTIVE_ID)).agg(F.count("*").alias("n_values"))
    number = F.row_number().over(W.orderBy(col(EFFECTIVE_ID))) - 1
    return counts.select(number.alias("column_number"), col(EFFECTIVE_ID), "n_values")


def feature_vectors(maps: DataFrame, dictionary: DataFrame) -> DataFrame:
    """``maps`` as sparse rows: the sorted column numbers and their values."""
    cells = maps.select(col(CASE), col(ANCHOR), F.explode("features").alias(EFFECTIVE_ID, "_value"))
    numbered = cells.join(dictionary.select("column_number", col(EFFECTIVE_ID)), EFFECTIVE_ID)
    entries = F.sort_array(F.collect_list(F.struct("column_number", "_value")))
    rows = numbered.groupBy(col(CASE), col(ANCHOR)).agg(entries.alias("_e"))
    return rows.select(
        col(CASE), col(ANCHOR), F.col("_e.column_number").alias("columns"), F.col("_e._value").alias("values")
    )


def reduced_completeness(
    procedures: DataFrame, labs: DataFrame, hours: float = vocab.LOOKBACK_HOURS
) -> DataFrame:
    """How many procedures with a value have every value of the reduced list."""
    wanted = vocab.LAB_FEATURES_REDUCED
    rows = lab_features(procedures, _of_variant(labs, "reduced"), hours, ids=wanted)
    return completeness(rows, wanted)


def procedures_with_lab_features(
    procedures: DataFrame,
    labs: DataFrame,
    hours: float = vocab.LOOKBACK_HOURS,
    ids: Sequence[str] | None = None,
    keep_unmatched: bool = True,
) -> DataFrame:
    """Procedure rows with window start, text key and features; all procedures by default."""
    rows = with_window_start(procedures, hours).withColumn(
        "Fall_dt", times.anchor_key(col(CASE), col(ANCHOR))
    )
    features = lab_features(procedures, labs, hours, ids=ids)
    return attach(rows, features, on=[CASE, ANCHOR], keep_unmatched=keep_unmatched)


def mean_features_per_case(
    values: DataFrame, ids: Sequence[str] = tuple(vocab.LAB_FEATURES)
) -> DataFrame:
    """One row per case, the mean value per parameter."""
    return pivot_values(
        values, index=CASE, dim=EFFECTIVE_ID, value=NUMBER, values=ids, how="mean"
    )


def with_definitions(labs: DataFrame, definitions: DataFrame | None) -> DataFrame:
    """Labs of defined parameters with their category; unchanged if they have it, or without definitions."""
    if definitions is None or "Kategorie" in labs.columns:
        return labs
    return null_safe_join(labs, definitions, on=[LAB_ID, "LOINC-Code"])


def with_normalised_values(labs: DataFrame, definitions: DataFrame | None) -> DataFrame:
    """Adds ``Ergebniswert_normalisiert``; expects the ``_num`` columns, else makes them."""
    if definitions is None:
        return labs
    texts = [RESULT, "Referenzwert unten", "Referenzwert oben"]
    rows = add_numeric_columns(labs, [t for t in texts if f"{t}_num" not in labs.columns])
    return with_definitions(rows, definitions).withColumn(
        "Ergebniswert_normalisiert",
        ranges.range_normalised(
            col("Ergebniswert_num"),
            col("Referenzwert unten_num"),
            col("Referenzwert oben_num"),
            col("Kategorie"),
        ),
    )
