"""The clinical sources: which columns, which format, which types."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..columns import col
from .delimited import (
    COMMA,
    FREE_TEXT,
    NAMES_ELSEWHERE,
    SEMICOLON,
    Format,
    bad_lines_of,
    names_from_file,
    read_delimited,
)

# Columns of the sources.
LAB = {
    "Fallnummer": "long",
    "Probeneingangsdatum": "string",
    "Ergebnisdatum": "string",
    "Ergebniswert": "string",
    "Parameter-ID primär": "string",
}
DEVICE = {
    "FallNr": "long",
    "AuftSortDatZeit": "string",
    "ErgeDatZeit": "string",
    "Ergebnis": "string",
    "AnfoCode": "string",
}
FULL_LAB = {
    "Auftragsnummer": "long",
    "Fallnummer": "long",
    "Probeneingangsdatum": "string",
    "Ergebnisdatum": "string",
    "Parameterbezeichnung": "string",
    "Ergebniswert": "string",
    "Ergebniseinheit": "string",
    "Ergebniseinheit (UCUM)": "string",
    "Referenzwert unten": "string",
    "Referenzwert oben": "string",
    "Parameter-ID primär": "string",
    "LOINC-Code": "string",
    "Probenart": "string",
}
DEFINITION = {"Parameter-ID primär": "string", "LOINC-Code": "string", "Kategorie": "int"}
DIAGNOSIS = {
    "Fall": "long",
    "Diagnoseschlüssel": "string",
    "DiagDatum": "string",
    "Zeit": "string",
}
COMORBIDITY_MAP = {"icd-10-code": "string", "charlson_group": "int"}
PROCEDURE = {"Fall": "long", "OP-Code Beg.": "string", "BegZeit": "string", "OP-Code": "string"}
LATE_PROCEDURE = {
    "Fallnummer": "long",
    "Prozedurdatum": "string",
    "Prozedurzeit": "string",
    "PrzCode": "string",
}
MASTER = {
    "Fallnummer": "long",
    "Patientennummer": "string",
    "Geschlecht": "string",
    "Alter": "long",
    "Bewegung Behandlungsart": "string",
}
LATE_MASTER = {
    "Fall": "long",
    "Patient": "string",
    "G": "string",
    "GebDatum": "string",
    "Fa": "string",
}
REPORT = {
    "FALNR": "long",
    "DOKNR": "long",
    "CONTENT": "string",
    "ZBEFALL04D": "string",
    "DODAT": "string",
    "ERDAT": "string",
}
LABELLED = {
    "Fallnummer": "long",
    "prozedur_datetime": "string",
    "Patientennummer": "string",
    "geschlecht": "string",
    "alter_bei_prozedur": "int",
    "predicted_label": "string",
    "confidence": "double",
}
# The kinds of full lab file: an extract as is, the export with its names elsewhere, a cleaned one.
LAB_PROFILES: dict[str, Format] = {
    "mini": COMMA,
    "original": NAMES_ELSEWHERE,
    "clean": COMMA,
}


def read_lab_sources(
    spark: SparkSession,
    *,
    main: str,
    main_names: str,
    late: str,
    blood_gas: str,
    potassium: str,
    glucose: str,
) -> dict[str, DataFrame]:
    """The five lab sources by name, as ``plans.labs.complete_labs`` takes them."""

    def lab(path: str, **how) -> DataFrame:
        return read_delimited(spark, path, LAB, required=["Fallnummer"], **how)

    def device(path: str) -> DataFrame:
        return read_delimited(spark, path, DEVICE, fmt=SEMICOLON, required=["FallNr"])

    return {
        "main": lab(main, fmt=NAMES_ELSEWHERE, names=names_from_file(spark, main_names)),
        "late": lab(late, fmt=SEMICOLON),
        "blood_gas": lab(blood_gas, fmt=SEMICOLON),
        "potassium": device(potassium),
        "glucose": device(glucose),
    }


def read_full_labs(
    spark: SparkSession, path: str, profile: str, names_path: str | None = None
) -> DataFrame:
    """Lab rows with units and reference bounds, for a profile named in ``LAB_PROFILES``."""
    if profile not in LAB_PROFILES:
        raise ValueError(f"unknown profile {profile!r}, use one of {sorted(LAB_PROFILES)}")
    fmt = LAB_PROFILES[profile]
    names = None
    if not fmt.header:
        if names_path is None:
            raise ValueError(f"profile {profile!r} needs the file with the column names")
        names = names_from_file(spark, names_path)
    return read_delimited(spark, path, FULL_LAB, fmt=fmt, names=names)


def read_definitions(spark: SparkSession, path: str) -> DataFrame:
    return read_delimited(spark, path, DEFINITION)


def read_diagnoses(spark: SparkSession, path: str) -> DataFrame:
    return read_delimited(spark, path, DIAGNOSIS, required=["Fall"])


def read_comorbidity_map(spark: SparkSession, path: str) -> DataFrame:
    return read_delimited(spark, path, COMORBIDITY_MAP)


def read_procedures(spark: SparkSession, path: str, late_path: str) -> tuple[DataFrame, DataFrame]:
    return (
        read_delimited(spark, path, PROCEDURE, required=["Fall"]),
        read_delimited(spark, late_path, LATE_PROCEDURE, required=["Fallnummer"]),
    )


def read_master(spark: SparkSession, path: str, late_path: str) -> tuple[DataFrame, DataFrame]:
    return (
        read_delimited(spark, path, MASTER, required=["Fallnummer", "Alter"]),
        read_delimited(spark, late_path, LATE_MASTER, required=["Fall"]),
    )


def read_reports(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """(all reports of a folder, lines with too many cells); texts hold line breaks, empty cells
    stay empty texts."""
    return _read_folder(spark, folder, REPORT, ["FALNR", "DOKNR"])


def read_labelled(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """(all labelled procedures of a folder, lines with too many cells); an empty confidence or
    time is null."""
    rows, bad = _read_folder(spark, folder, LABELLED, ["Fallnummer", "alter_bei_prozedur"])
    at = F.to_timestamp(F.nullif(F.trim(col("prozedur_datetime")), F.lit("")))
    return rows.withColumn("prozedur_datetime", at), bad


def _read_folder(
    spark: SparkSession, folder: str, columns: dict[str, str], required: list[str]
) -> tuple[DataFrame, DataFrame]:
    rows = read_delimited(
        spark, folder, columns, fmt=FREE_TEXT, required=required, bad_lines="set_aside"
    )
    return rows, bad_lines_of(spark, folder, columns, fmt=FREE_TEXT)
