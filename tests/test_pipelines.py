"""From CSV files to the training table and to the cohort, on a handful of cases."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from anteframe import vocab
from anteframe.plans import cohort, labs, profiles, training
from anteframe.sources import clinic
from helpers import rows


def at(s):
    return dt.datetime.fromisoformat(s)


@pytest.fixture(scope="module")
def files(tmp_path_factory):
    root = tmp_path_factory.mktemp("clinic")

    def put(name, text, encoding="utf-8"):
        path = root / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(text.encode(encoding))

    lab_header = "Fallnummer;Probeneingangsdatum;Ergebnisdatum;Ergebniswert;Parameter-ID primär\n"
    put("names.csv", "Auftragsnummer;" + lab_header, "iso-8859-1")
    put("main.csv", "9;1;2020-01-10T10:00:00+0100;x;4,1;K_S\n"
                    "9;1;2020-01-10T10:00:00+0100;y;4,1;K_S\n"
                    "9;1;2020-01-09T10:00:00+0100;x;3,0;K_S\n"
                    "9;1;2020-01-10T11:00:00+0100;x;<0,5;CRP_S\n"
                    "9;1;2020-01-10T11:00:00+0100;x;negativ;TSH_S\n"
                    "9;1;2020-01-01T11:00:00+0100;x;7;TSH_S\n"
                    "9;3;2020-01-10T11:00:00+0100;x;7;TSH_S\n")
    put("late.csv", lab_header + "2;2020-02-01T08:00:00+01:00;;140;NA_S\n2;NA;;141;NA_S\n")
    put("gas.csv", lab_header + "2;;2020-02-01T09:00:00+0100;7,4;O-PH_Z\n2;2020-02-01T09:00:00+0100;x;1;O-PROBENTYP\n")
    device = "FallNr;AuftSortDatZeit;ErgeDatZeit;Ergebnis;AnfoCode\n"
    put("kalium.csv", device + "1;2020-01-10T10:30:00+0100;x;4,4;K_H\n")
    put("glukose.csv", device + "2;2020-02-01T10:00:00+0100;x;> 500;O-GLU_Z.0815\n")
    put("diag.csv", "Fall,Diagnoseschlüssel,DiagDatum,Zeit\n"
                    "1,C91.10,1/9/2020,1:05:09 PM\n1,E11.90,01/10/2020,12:00:00 AM\n1,C64,1/11/2020,8:00:00 AM\n"
                    "2,Z99,1/1/2020,8:00:00 AM\n1,C91.10,1/9/2020,1:05:09 PM\n")
    put("map.csv", "icd-10-code,charlson_group\nC91.x,1\nC91.10,2\nE11.x,3\nC64,4\n")
    put("labelled/a.csv", "Fallnummer,prozedur_datetime,Patientennummer,geschlecht,alter_bei_prozedur,predicted_label,confidence\n"
                          f"1,2020-01-10 12:00:00,P1,W,50,{vocab.LABEL_POSITIVE},0.95\n"
                          f"1,2020-01-10 12:00:00,P1,W,50,{vocab.LABEL_POSITIVE},0.95\n"
                          f"2,2020-02-01 12:00:00,P2,M,60,{vocab.LABEL_NEGATIVE},0.9\n")
    put("labelled/b.csv", "Fallnummer,prozedur_datetime,Patientennummer,geschlecht,alter_bei_prozedur,predicted_label,confidence\n"
                          f"4,2020-03-01 12:00:00,P4,M,60,{vocab.LABEL_NEGATIVE},1.0\n"
                          f"5,2020-03-01 12:00:00,P5,M,60,{vocab.LABEL_NEGATIVE},0.5\n"
                          f"6,2020-03-01 12:00:00,P6,M,60,{vocab.LABEL_NEGATIVE},\n"
                          "7,2020-03-01 12:00:00,P7,M,60,LE unklar (2),0.99\n")
    put("proz.csv", "Fall,OP-Code Beg.,BegZeit,OP-Code\n1,2020-01-10,12:00:00,3-222\n1,2020-01-10,12:00:00,3-222\n"
                    "2,2020-02-01,00:00:00,3-222\n3,2020-01-05,10:00:00,3-200\n8,2020-01-05,10:00:00,3-222\n8,2020-01-05,11:00:00,3-222\n")
    put("proz_late.csv", "Fallnummer,Prozedurdatum,Prozedurzeit,PrzCode\n2,2020-02-01,13:00:00,3-222\n9,2020-04-01,09:00:00,3-222\n")
    put("master.csv", "Fallnummer,Patientennummer,Geschlecht,Alter,Bewegung Behandlungsart\n"
                      "1,P1,W,50,Stationär\n1,P1,W,50,Stationär\n2,P2,M,60,Ambulant\n")
    put("master_late.csv", "Fall,Patient,G,GebDatum,Fa\n9,P9,M,2000-04-02,Stationär\n2,P2,M,1960-02-01,Stationär\n")
    line = "10.01.2020 ------ RAD -----  Arztbrief  -----  7/20  -----"
    head = "FALNR,DOKNR,CONTENT,ZBEFALL04D,DODAT,ERDAT\n"
    put("reports/a.csv", head + f'1,11,"Kopf\n{line}\nalt",10.01.2020 08:00:00,,\n'
                                f'1,12,"{line}\nneu",10.01.2020 08:00:00,,\n')
    put("reports/b.csv", head + '2,21,"a\n\nb",01.01.1900 00:00:00,01.02.2020 00:00:00,02.02.2020 00:00:00\n'
                                '9,91,"x",01.04.2020 00:00:00,,\n9,92,"y",01.04.2020 00:00:00,,\n'
                                '8,81,"z",kein Datum,05.01.2020 00:00:00,\n')
    return str(root)


@pytest.fixture(scope="module")
def lab_sources(spark, files):
    return clinic.read_lab_sources(
        spark, main=f"{files}/main.csv", main_names=f"{files}/names.csv", late=f"{files}/late.csv",
        blood_gas=f"{files}/gas.csv", potassium=f"{files}/kalium.csv", glucose=f"{files}/glukose.csv",
    )


@pytest.fixture(scope="module")
def diags(spark, files):
    return cohort.diagnoses(
        clinic.read_diagnoses(spark, f"{files}/diag.csv"),
        clinic.read_comorbidity_map(spark, f"{files}/map.csv"),
    )


def test_lab_cleaning(lab_sources):
    got = labs.labs_from_sources(lab_sources).select(
        "Fallnummer", "parameterid_effektiv", "ergebniswert_num", "abnahmezeitpunkt_effektiv"
    )
    assert rows(got) == sorted(
        [
            (1, "x-K_x", 4.1, at("2020-01-10 09:00:00")),
            (1, "x-K_x", 3.0, at("2020-01-09 09:00:00")),
            (1, "CRP_S", 0.5, at("2020-01-10 10:00:00")),
            (1, "TSH_S", 7.0, at("2020-01-01 10:00:00")),
            (3, "TSH_S", 7.0, at("2020-01-10 10:00:00")),
            (2, "x-NA_x", 140.0, at("2020-02-01 07:00:00")),
            (2, "O-PH_Z", 7.4, at("2020-02-01 08:00:00")),
            (1, "x-K_x", 4.4, at("2020-01-10 09:30:00")),
            (2, "x-GLU_x", 500.0, at("2020-02-01 08:15:00")),
        ],
        key=repr,
    )
    reduced = labs.labs_from_sources(lab_sources, "reduced").select("parameterid_effektiv").distinct()
    assert rows(reduced) == [("x-K_x",), ("x-NA_x",)]
    with pytest.raises(ValueError, match="unknown variant"):
        labs.labs_from_sources(lab_sources, "all")


def test_diagnoses(diags):
    assert rows(diags.select("Diagnoseschlüssel", "charlson_group", "diagnose_datetime")) == sorted(
        [
            ("C91.10", 2, at("2020-01-09 13:05:09")),
            ("E11.90", 3, at("2020-01-10 00:00:00")),
            ("C64", 4, at("2020-01-11 08:00:00")),
            ("Z99", None, at("2020-01-01 08:00:00")),
        ],
        key=repr,
    )


def test_training_table(spark, files, lab_sources, diags):
    labelled, bad = clinic.read_labelled(spark, f"{files}/labelled")
    assert bad.count() == 0
    assert rows(training.selection_counts(labelled)) == [(7, 3)]
    values = labs.labs_from_sources(lab_sources)
    table = training.training_table(labelled, values, diags)
    assert [c for c in vocab.LAB_FEATURES if c not in table.columns] == []
    got = table.select(
        "Fallnummer", "x-K_x", "CRP_S", "TSH_S", "x-NA_x", "O-PH_Z", "x-GLU_x",
        "charlson_group_1", "charlson_group_2", "charlson_group_3", "charlson_group_4", "predicted_label_int",
    )
    assert rows(got) == [
        (1, 4.4, 0.5, None, None, None, None, False, True, True, False, 1),
        (2, None, None, None, 140.0, 7.4, 500.0, False, False, False, False, 0),
    ]
    assert table.first()["prozedur_fenster_start"] in {at("2020-01-03 12:00:00"), at("2020-01-25 12:00:00")}
    kept = training.training_table(labelled, values, diags, keep_unmatched=True)
    assert rows(kept.select("Fallnummer", "CRP_S")) == [(1, 0.5), (2, None), (4, None)]
    merged = training.merge_labs(training.procedures_for_training(labelled), values)
    assert rows(merged.select("Fall_dt", "CRP_S")) == [
        ("1+2020-01-10_12:00:00", 0.5), ("2+2020-02-01_12:00:00", None), ("4+2020-03-01_12:00:00", None)
    ]
    flags = training.merge_diagnoses(training.procedures_for_training(labelled), diags)
    assert rows(flags.select("Fallnummer", "charlson_group_2")) == [(1, True), (2, False), (4, None)]
    curve = training.feature_tradeoff(labelled, values).orderBy("k_num_params").first()
    assert tuple(curve)[:3] == (1, "CRP_S", 1)
    profile = profiles.training_profile(
        table, shares_of=["predicted_label_int"], nulls_in=["alter_bei_prozedur"], complete_over=vocab.LAB_FEATURES_SMALL
    )
    assert rows(profile["complete"].select("n_rows", "n_complete")) == [(2, 0)]


def test_reduced_variant_keeps_complete_rows_only(spark):
    wanted = vocab.LAB_FEATURES_REDUCED
    t = at("2020-01-10 12:00:00")
    procs = spark.createDataFrame([(1, t), (2, t)], "Fallnummer long, prozedur_datetime timestamp")
    raw = {"x-K_x": "O-K_Z", "x-NA_x": "NA_S"}
    values = [(1, raw.get(p, p), p) for p in wanted] + [(2, raw.get(p, p), p) for p in wanted if p != "x-K_x"]
    # Case 2 has its potassium only from an id that is not on the short list.
    values.append((2, "K_H", "x-K_x"))
    df = spark.createDataFrame(
        [(c, t, r, p, t, 1.0) for c, r, p in values],
        "Fallnummer long, Probeneingangsdatum timestamp, `Parameter-ID primär` string, parameterid_effektiv string,"
        " abnahmezeitpunkt_effektiv timestamp, ergebniswert_num double",
    )
    assert rows(labs.lab_features(procs, df, variant="reduced").select("Fallnummer")) == [(1,)]
    assert rows(labs.reduced_completeness(procs, df)) == [(2, 1, 1, 50.0)]
    assert rows(labs.mean_features_per_case(df, wanted[:1])) == [(1, 1.0), (2, 1.0)]


def test_cohort(spark, files):
    reports, bad = clinic.read_reports(spark, f"{files}/reports")
    assert bad.count() == 0
    parsed = cohort.parsed_reports(reports)
    assert rows(cohort.unusable_reports(parsed)) == [(6, 1)]
    heads = parsed.select("DOKNR", "befund_nummer", "CONTENT_head", "prozedur_datum", "CONTENT_length")
    assert rows(heads)[:3] == [
        (11, "7/20", None, "2020-01-10", 67), (12, "7/20", None, "2020-01-10", 62), (21, None, "ab", "2020-02-01", 4)
    ]
    usable = cohort.usable_reports(reports)
    # The newer version (higher number) stays; case 9 has two reports on one day.
    assert rows(usable.select("DOKNR")) == [(12,), (21,), (81,)]
    source, late = clinic.read_procedures(spark, f"{files}/proz.csv", f"{files}/proz_late.csv")
    assert rows(cohort.procedure_counts(source, late)) == [(7, 6, 5)]
    procs = cohort.procedures(source, late)
    master = cohort.inpatients(*clinic.read_master(spark, f"{files}/master.csv", f"{files}/master_late.csv"))
    assert rows(master.select("Fallnummer", "alter_bei_prozedur")) == [(1, 50), (2, None), (9, None)]
    # Case 2 has two rows on its day, one without time: it passes, but with no time and so no age.
    joined = cohort.reports_with_procedure(usable, procs)
    assert rows(joined.select("Fallnummer", "prozedur_zeit")) == [(1, "12:00:00"), (2, None)]
    final = cohort.procedures_for_labelling(usable, procs, master)
    assert rows(final.select("Fallnummer", "prozedur_datetime", "alter_bei_prozedur", "altersdekade_bei_prozedur")) == [
        (1, at("2020-01-10 12:00:00"), 50, 5)
    ]
    with pytest.raises(Exception, match="not unique"):
        cohort.reports_with_procedure(parsed, procs).collect()
    assert rows(cohort.usable_reports(reports.unionByName(reports)).select("DOKNR", "CONTENT")) == rows(usable.select("DOKNR", "CONTENT"))


def test_range_pipeline(spark):
    columns = list(clinic.FULL_LAB)

    def lab(value, low, high, code, loinc, name="Name"):
        row = dict.fromkeys(columns)
        row.update({"Ergebniswert": value, "Referenzwert unten": low, "Referenzwert oben": high,
                    "Parameter-ID primär": code, "LOINC-Code": loinc, "Parameterbezeichnung": name})
        return tuple(row.values())

    schema = ", ".join(f"`{c}` string" for c in columns)
    df = spark.createDataFrame(
        [lab("5", "4", "8", "A", "1"), lab("4", None, "8", "B", None), lab("4", "1", "8", "B", None),
         lab("x", "4", "8", "A", "1"), lab("5", "4", "8", "A", "1", None), lab("5", "0", "8", "A", "1"),
         lab("5", "4", "8", "A", "2")],
        schema,
    )
    defs = spark.createDataFrame([("A", "1", 0), ("B", None, 2)], "`Parameter-ID primär` string, `LOINC-Code` string, Kategorie int")
    clean, statistics = profiles.clean_ranges(labs.with_definitions(df, defs))
    assert rows(statistics) == [(6, 3, 3, 50.0)]
    normalised = labs.with_normalised_values(clean.drop("Kategorie"), defs)
    assert rows(labs.with_normalised_values(clean, defs).select("Ergebniswert_normalisiert")) == [(0.25,), (0.5,), (None,)]
    assert rows(normalised.select("Ergebniswert_normalisiert")) == [(0.25,), (0.5,), (None,)]
    assert labs.with_definitions(df, None) is df and labs.with_normalised_values(df, None) is df
    fresh = labs.with_normalised_values(df.where("Ergebniswert = '4' AND `Referenzwert unten` IS NULL"), defs)
    assert rows(fresh.select("Ergebniswert_normalisiert", F.col("Ergebniswert_num"))) == [(0.5, 4.0)]


def test_rows_do_not_depend_on_the_listed_ids(spark):
    t = at("2020-01-10 12:00:00")
    procs = spark.createDataFrame([(1, t), (2, t), (3, t)], "Fallnummer long, prozedur_datetime timestamp")
    df = spark.createDataFrame(
        [(1, t, "CRP_S", 1.0), (1, t, "NEW_S", 2.0), (2, t, "NEW_S", 3.0)],
        "Fallnummer long, abnahmezeitpunkt_effektiv timestamp, parameterid_effektiv string, ergebniswert_num double",
    ).withColumns({"Probeneingangsdatum": F.col("abnahmezeitpunkt_effektiv"), "Parameter-ID primär": F.col("parameterid_effektiv")})
    assert rows(labs.lab_features(procs, df).select("Fallnummer", "CRP_S")) == [(1, 1.0), (2, None)]
    every = labs.lab_features(procs, df, ids="all")
    assert every.columns[2:] == ["CRP_S", "NEW_S"]
    assert rows(every.select("Fallnummer", "CRP_S", "NEW_S")) == [(1, 1.0, 2.0), (2, None, 3.0)]
    assert rows(labs.unlisted_values(df)) == [("NEW_S", 2)]
    with pytest.raises(ValueError, match="all"):
        labs.lab_features(procs, df, ids="every")


def test_wrong_sampling_times(spark):
    texts = ["2020-01-10T10:00:00+0100", "2020-01-10T10:00:00.5Z", "10.01.2020 10:00", "2020-01-10T10:00:00", None]
    df = spark.createDataFrame([(x, "CRP_S") for x in texts], "Probeneingangsdatum string, `Parameter-ID primär` string")
    assert rows(labs.unusable_times(df)) == [(5, 2)]
    got = labs.harmonised_labs(df.where("Probeneingangsdatum RLIKE '(Z|[+]0100)$'")).select("Probeneingangsdatum")
    assert rows(got) == [(at("2020-01-10 10:00:00.500000"),), (at("2020-01-10 09:00:00"),)]
    with pytest.raises(Exception, match="not a time with an offset"):
        labs.harmonised_labs(df).collect()
    lenient = labs.harmonised_labs(df, strict=False)
    assert lenient.where("Probeneingangsdatum IS NULL").count() == 1


def test_blood_gas_delays(spark):
    gas = spark.createDataFrame(
        [("2020-01-10T10:00:00+0100", "2020-01-10T10:30:00+0100", "O-PH_Z"), (None, "2019-12-31T23:30:00+0000", "O-PH_Z"),
         ("2020-01-10T10:00:00Z", "2020-01-10T09:50:00Z", "O-PH_Z"), ("2020-01-10T10:00:00Z", None, "O-K_Z"), (None, None, "O-K_Z")],
        "Probeneingangsdatum string, Ergebnisdatum string, `Parameter-ID primär` string",
    )
    assert rows(profiles.blood_gas_delays(gas).select("delay_minutes")) == [(-10.0,), (30.0,)]
    bins = profiles.blood_gas_delay_histogram(gas, bins=4).orderBy("bin").collect()
    assert [(r["lower"], r["n"]) for r in bins] == [(-10.0, 1), (0.0, 0), (10.0, 0), (20.0, 1)]
    assert rows(profiles.blood_gas_counts_by_year(gas)) == [("O-K_Z", 2020, 1), ("O-PH_Z", 2019, 1), ("O-PH_Z", 2020, 2)]


def test_open_vocabulary(spark, monkeypatch):
    t = at("2024-01-10 12:00:00")
    procs = spark.createDataFrame([(1, t), (2, t), (3, t)], "Fallnummer long, prozedur_datetime timestamp")
    values = [(1, "b new", 2.0), (1, "A_1", 1.0), (2, "b new", 3.0), (9, "other", 4.0)]
    df = spark.createDataFrame(
        [(c, t, "1", p, t, p, x) for c, p, x in values],
        "Fallnummer long, Probeneingangsdatum timestamp, Ergebniswert string, `Parameter-ID primär` string,"
        " abnahmezeitpunkt_effektiv timestamp, parameterid_effektiv string, ergebniswert_num double",
    )
    maps = labs.feature_maps(procs, df)
    assert rows(maps.select("Fallnummer", "features")) == [(1, {"A_1": 1.0, "b new": 2.0}), (2, {"b new": 3.0})]
    words = labs.feature_dictionary(maps)
    assert rows(words) == [(0, "A_1", 1), (1, "b new", 2)]
    vectors = labs.feature_vectors(maps, words).select("Fallnummer", "columns", "values")
    assert rows(vectors) == [(1, [0, 1], [1.0, 2.0]), (2, [1], [3.0])]
    monkeypatch.setattr(labs, "MOST_COLUMNS", 2)
    with pytest.raises(ValueError, match="feature_maps"):
        labs.lab_features(procs, df, ids="all")


def test_copies_of_reports(spark, files):
    """Of rows that differ in a column beside the text one stays, as of exact copies."""
    reports, _ = clinic.read_reports(spark, f"{files}/reports")
    marked = reports.withColumn("extra", F.lit("a"))
    both = marked.unionByName(marked).unionByName(reports.withColumn("extra", F.lit("b")))
    usable = cohort.usable_reports(both)
    once = cohort.usable_reports(marked)
    assert rows(usable.drop("extra")) == rows(once.drop("extra"))
    assert rows(cohort.usable_reports(both.limit(0))) == [] and usable.columns == once.columns
    # The choice alone says how often a row occurs.
    assert {r["_copies"] for r in cohort.report_choice(marked.unionByName(marked)).collect()} == {2}
