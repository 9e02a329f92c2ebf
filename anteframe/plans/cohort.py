"""Master data, procedures, reports and diagnoses up to the cohort that gets labelled."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import vocab
from ..columns import col
from ..functions import codes, text, times
from ..operators.aggregate import single_or_null
from ..operators.dedup import keep_singletons, latest_version, unique_keys
from ..operators.history import history_flags
from ..operators.joins import null_safe_join
from ..operators.prefix import longest_prefix_group
from ..operators.sets import union_all

TEXT_SUM, ROW_SUM = "_text_sum", "_row_sum"
CASE, DAY, TIME, AT = "Fallnummer", "prozedur_datum", "prozedur_zeit", "prozedur_datetime"


def inpatients(master: DataFrame, late_master: DataFrame) -> DataFrame:
    """Distinct master rows of in-patients; a source without age or birth date leaves it null."""
    first = master.select(
        col(CASE),
        col("Patientennummer"),
        col("Geschlecht").alias("geschlecht"),
        col("Alter").alias("alter_bei_prozedur"),
        col("Bewegung Behandlungsart").alias("behandlungsart"),
    )
    late = late_master.select(
        col("Fall").alias(CASE),
        col("Patient").alias("Patientennummer"),
        col("G").alias("geschlecht"),
        F.to_date(col("GebDatum"), "yyyy-MM-dd").alias("geburtsdatum"),
        col("Fa").alias("behandlungsart"),
    )
    rows = union_all(first, late, fill_missing=True)
    return rows.where(col("behandlungsart") == vocab.INPATIENT).distinct()


def procedures(
    source: DataFrame, late: DataFrame, code: str = vocab.PROCEDURE_CODE
) -> DataFrame:
    """Distinct case, day and time of the wanted procedure; midnight means "no time given"."""
    rows = union_all(
        source.select(
            col("Fall").alias(CASE),
            col("OP-Code Beg.").alias(DAY),
            codes.blank_sentinel(col("BegZeit"), vocab.NO_TIME).alias(TIME),
            col("OP-Code"),
        ),
        late.select(
            col(CASE),
            col("Prozedurdatum").alias(DAY),
            codes.blank_sentinel(col("Prozedurzeit"), vocab.NO_TIME).alias(TIME),
            col("PrzCode").alias("OP-Code"),
        ),
    )
    return rows.where(col("OP-Code") == code).select(CASE, DAY, TIME).distinct()


def procedure_counts(source: DataFrame, late: DataFrame, code: str = vocab.PROCEDURE_CODE) -> DataFrame:
    """Wanted procedures, how many are distinct, and the number of cases in both sources."""
    coded = union_all(
        source.select(col("Fall").alias(CASE), col("OP-Code")),
        late.select(col(CASE), col("PrzCode").alias("OP-Code")),
    )
    wanted = coded.agg(F.count_if(col("OP-Code") == code).alias("n_procedures"))
    return wanted.select(
        "n_procedures",
        procedures(source, late, code).agg(F.count("*")).scalar().alias("n_distinct"),
        coded.select(CASE).distinct().agg(F.count("*")).scalar().alias("n_cases"),
    )


def parsed_reports(reports: DataFrame) -> DataFrame:
    """Reports with identification, dates and the day of the procedure they belong to.

    A day that cannot be told stays null; ``unusable_reports`` counts those.
    """
    head = text.report_head(col("CONTENT"))
    rows = reports.withColumns(
        {
            CASE: col("FALNR"),
            "CONTENT_length": F.length(col("CONTENT")),
            "datum_zbefall": times.german_timestamp(col("ZBEFALL04D")),
            "datum_dodat": times.german_timestamp(col("DODAT")),
            "datum_erdat": times.german_timestamp(col("ERDAT")),
            "_head": head,
        }
    )
    day = times.date_unless_year(col("datum_zbefall"), col("datum_dodat"), vocab.NO_DATE_YEAR)
    return rows.withColumns(
        {
            "jahr_zbefall": F.year("datum_zbefall"),
            "CONTENT_head": F.col("_head.head"),
            "befund_nummer": F.col("_head.number"),
            "befund_datum_head": F.col("_head.date"),
            "befund_datum": F.coalesce(
                times.german_date(F.col("_head.date")), F.col("datum_erdat")
            ),
            DAY: F.date_format(day, "yyyy-MM-dd"),
        }
    ).drop("_head")


def unusable_reports(reports: DataFrame) -> DataFrame:
    return reports.agg(F.count("*").alias("n_reports"), F.count_if(col(DAY).isNull()).alias("n_no_day"))


def newest_reports(reports: DataFrame) -> DataFrame:
    """One version per report: the newest, then the highest document number, then any one text."""
    text_sum = col(TEXT_SUM) if TEXT_SUM in reports.columns else _sum(col("CONTENT"))
    return latest_version(
        reports,
        [CASE, DAY, "befund_nummer", "CONTENT_head"],
        [F.desc_nulls_last("befund_datum"), F.desc_nulls_last("DOKNR"), text_sum.desc_nulls_last()],
    )


def reports_alone_on_their_day(reports: DataFrame) -> DataFrame:
    return keep_singletons(reports, [CASE, DAY])


def report_choice(reports: DataFrame) -> DataFrame:
    """The newest version of each report that is alone on its case and day, without its text.

    Columns: what ``parsed_reports`` adds, ``_row_sum`` (a checksum of the whole row, by which the
    row can be fetched) and ``_copies`` (how many rows have it). Every report is parsed once here.
    Versions and days are settled by mergeable maxima: one report on a day means that the least
    and the greatest (number, head) are the same, and the greatest (date, document number, text)
    is the newest version. Of rows that differ in other columns only, the greatest checksum wins.
    """
    added = [c for c in parsed_reports(reports).columns if c not in reports.columns]
    rows = parsed_reports(reports.withColumn(ROW_SUM, _row_sum(reports)))
    rows = rows.withColumn(TEXT_SUM, _sum(col("CONTENT")))
    version = ["befund_datum", "DOKNR", TEXT_SUM, ROW_SUM]
    small = [c for c in added if c not in (CASE, DAY, *version)]
    distinct = rows.groupBy(*map(col, [CASE, DAY, *version])).agg(
        F.count("*").alias("_copies"), *[F.first(col(c)).alias(c) for c in small]
    )
    report = F.struct("befund_nummer", "CONTENT_head")
    newest = F.max(F.struct(*map(col, [*version, "_copies", *small])))
    days = distinct.groupBy(col(CASE), col(DAY)).agg(
        F.min(report).alias("_least"), F.max(report).alias("_greatest"), newest.alias("_newest")
    )
    # The second condition always holds; for it every use of the choice, however few columns it
    # needs, is the same exchange, and the reports are parsed once for all of them.
    one = F.col("_least").eqNullSafe(F.col("_greatest")) & (F.col("_newest._copies") >= 1)
    alone = days.where(one)
    return alone.select(*[col(c) if c in (CASE, DAY) else F.col("_newest").getField(c).alias(c) for c in [*added, ROW_SUM, "_copies"]])


def _sum(value: Column) -> Column:
    """The first 128 bits of SHA-256 as bytes: they travel in every shuffle, and no codec makes them smaller."""
    return F.substring(F.unhex(F.sha2(value, 256)), 1, 16)


def _row_sum(reports: DataFrame) -> Column:
    return _sum(F.to_json(F.struct(*map(col, reports.columns))))


def usable_reports(reports: DataFrame, choice: DataFrame | None = None) -> DataFrame:
    """The newest version of each report, if no other one is of its case and day.

    ``report_choice`` settles which, without the texts; these are fetched by the checksum of their
    row and not parsed again. Of exact copies one stays; only reports that have copies are shuffled
    for it. Callers that need the choice too pass it, so it is made once.
    """
    choice = report_choice(reports) if choice is None else choice
    rows = reports.withColumn(ROW_SUM, _row_sum(reports))
    columns = [*reports.columns, *[c for c in choice.columns if c not in reports.columns]]
    single = rows.join(choice.where("_copies = 1"), ROW_SUM).select(*map(col, columns))
    several = rows.join(choice.where("_copies > 1"), ROW_SUM).select(*map(col, columns))
    return single.unionByName(several.dropDuplicates([ROW_SUM])).drop(ROW_SUM, "_copies")


def reports_with_procedure(
    reports: DataFrame, procs: DataFrame, check: bool = True, keys: DataFrame | None = None
) -> DataFrame:
    """Reports with the one procedure time of their case and day.

    With ``check`` the query fails if there are several reports for one of them. ``keys``: a table
    with case and day of each of ``reports``, where that is cheaper to look at than these.
    """
    timed = single_or_null(procs, [CASE, DAY], TIME, "num_start_times")
    if check:
        found = unique_keys(reports if keys is None else keys, [CASE, DAY])
        timed = null_safe_join(found, timed, on=[CASE, DAY])
    return null_safe_join(reports, timed, on=[CASE, DAY])


def procedures_for_labelling(
    reports: DataFrame,
    procs: DataFrame,
    master: DataFrame,
    check: bool = True,
    keys: DataFrame | None = None,
) -> DataFrame:
    """Adult in-patients' procedures with their report; age is filled from the birth date."""
    rows = reports_with_procedure(reports, procs, check, keys).join(master, CASE)
    rows = rows.withColumn(AT, times.iso_timestamp(col(DAY), col(TIME)))
    rows = rows.withColumn(
        "alter_bei_prozedur",
        times.age_in_years(col("alter_bei_prozedur"), col("geburtsdatum"), col(AT)),
    )
    rows = rows.withColumn(
        "altersdekade_bei_prozedur", times.age_decade(col("alter_bei_prozedur"))
    )
    return rows.where(col("alter_bei_prozedur") >= vocab.MIN_AGE)


def diagnoses(source: DataFrame, mapping: DataFrame) -> DataFrame:
    """Distinct diagnoses with time and comorbidity group (by the longest listed prefix)."""
    rules = mapping.select(
        codes.as_prefix(col("icd-10-code")).alias("prefix"), col("charlson_group")
    )
    rows = longest_prefix_group(
        source,
        rules,
        code="Diagnoseschlüssel",
        prefix="prefix",
        group="charlson_group",
        out="charlson_group",
    )
    return rows.select(
        col("Fall").alias(CASE),
        col("Diagnoseschlüssel"),
        "charlson_group",
        times.us_timestamp(col("DiagDatum"), col("Zeit")).alias("diagnose_datetime"),
    ).distinct()


def comorbidity_flags(procs: DataFrame, diags: DataFrame) -> DataFrame:
    """The 17 flags per procedure from diagnoses made no later."""
    return history_flags(
        procs,
        diags,
        key=CASE,
        anchor_ts=AT,
        event_ts="diagnose_datetime",
        group="charlson_group",
        groups=vocab.COMORBIDITY_GROUPS,
        prefix=vocab.COMORBIDITY_PREFIX,
    )
