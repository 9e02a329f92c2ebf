import pytest

from anteframe.sources import clinic, delimited, tables
from anteframe.sources.delimited import COMMA, FREE_TEXT, Format
from helpers import rows


@pytest.fixture
def folder(tmp_path):
    def make(**files):
        for name, content in files.items():
            data = content if isinstance(content, bytes) else content.encode()
            (tmp_path / name.replace("__", ".")).write_bytes(data)
        return str(tmp_path)

    return make


def test_folder_of_equal_files(spark, folder):
    path = folder(a__csv="x,y\n1,q\n", b__csv="x,y\n2,r\n", notes__txt="not data\n")
    assert rows(delimited.read_delimited(spark, path)) == [("1", "q"), ("2", "r")]


@pytest.mark.parametrize("other", ["y,x\n2,r\n", "x,y,z\n2,r,s\n", "x\n2\n", "x,w\n2,r\n", "X,y\n2,r\n"])
def test_files_with_other_columns_are_refused(spark, folder, other):
    path = folder(a__csv="x,y\n1,q\n", b__csv=other)
    with pytest.raises(ValueError, match="header"):
        delimited.read_delimited(spark, path)


@pytest.mark.parametrize("other", ["y,x\n2,r\n", "x\n2\n", "x,Y\n2,r\n"])
def test_files_with_other_wanted_columns_are_refused(spark, folder, other):
    path = folder(a__csv="x,y\n1,q\n", b__csv=other)
    with pytest.raises(ValueError, match="header"):
        delimited.read_delimited(spark, path, {"x": "string", "y": "string"})


def test_other_columns_may_differ(spark, folder):
    path = folder(a__csv="x,y\n1,q\n", b__csv="x,extra,y\n2,e,r\n", c__csv="y,x\n1,2\n".replace("y,x", "x,w,y").replace("1,2", "3,,s"))
    assert rows(delimited.read_delimited(spark, path, {"x": "long", "y": "string"})) == [(1, "q"), (2, "r"), (3, "s")]


def test_missing_folder_is_refused(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        delimited.read_delimited(spark, str(tmp_path / "none"))


def test_unknown_column_is_refused(spark, folder):
    path = folder(a__csv="x,y\n1,q\n")
    with pytest.raises(ValueError, match="not in"):
        delimited.read_delimited(spark, path, {"z": "long"})


TRAPS = 'x,y,z\n1,"a ""q"" b",NA\n2,,""\n3,short\n4,b,c,d\n5,"two\nlines",q\n'


def test_blank_cells_stay_text(spark, folder):
    path = folder(a__csv=TRAPS)
    got = rows(delimited.read_delimited(spark, path, {"x": "long", "y": "string", "z": "string"}, fmt=FREE_TEXT, bad_lines="set_aside"))
    assert got == [(1, 'a "q" b', "NA"), (2, "", ""), (3, "short", ""), (5, "two\nlines", "q")]


def test_na_tokens_become_null(spark, folder):
    path = folder(a__csv=TRAPS.replace("two\nlines", "one line"))
    got = rows(delimited.read_delimited(spark, path, {"x": "long", "z": "string"}, bad_lines="set_aside"))
    assert got == [(1, None), (2, None), (3, None), (5, "q")]


@pytest.mark.parametrize("columns", [["x"], ["z"], ["x", "y", "z"]])
@pytest.mark.parametrize("multiline", [True, False])
def test_overlong_lines_are_set_aside(spark, folder, columns, multiline):
    fmt = Format(multiline=multiline)
    path = folder(a__csv="x,y,z\n1,2,3\n4,b,c,d\n5,6\n")
    good, bad = delimited.split_bad_lines(delimited.read_raw(spark, path, fmt), fmt)
    assert good.select(*columns).count() == 2
    assert len(good.select(*columns).collect()) == 2
    assert bad.count() == 1
    assert [r[0] for r in bad.collect()] == ["4,b,c,d"]


@pytest.mark.parametrize("multiline", [True, False])
def test_overlong_lines_are_refused_unless_set_aside(spark, folder, multiline):
    fmt = Format(multiline=multiline)
    path = folder(a__csv="x,y\n1,2\n", b__csv="x,y\n3,4,5\n6\n")
    read = delimited.read_delimited(spark, path, {"x": "long"}, fmt=fmt)
    with pytest.raises(Exception, match="too many cells: 3,4,5"):
        read.collect()
    kept = delimited.read_delimited(spark, path, {"x": "long"}, fmt=fmt, bad_lines="set_aside")
    assert rows(kept) == [(1,), (6,)] and kept.count() == 2
    assert rows(delimited.bad_lines_of(spark, path, {"x": "long"}, fmt=fmt)) == [("3,4,5",)]
    with pytest.raises(ValueError, match="bad_lines"):
        delimited.read_delimited(spark, path, bad_lines="skip")


def test_labelled_folder(spark, folder):
    names = ",".join(clinic.LABELLED)
    path = folder(
        a__csv=f"{names}\n1,2020-01-10 12:00:00,P1,W,57.0,x,0.9\n2, ,P2,M,60,x,\n",
        b__csv=f"extra,{names}\nq,3,2020-01-11 08:00:00,P3,M,61,x,1\nq,3,2020-01-11 08:00:00,P3,M,61,x,1,1\n",
    )
    good, bad = clinic.read_labelled(spark, path)
    got = rows(good.select("Fallnummer", good.prozedur_datetime.cast("string"), "alter_bei_prozedur", "confidence"))
    assert got == [(1, "2020-01-10 12:00:00", 57, 0.9), (2, None, 60, None), (3, "2020-01-11 08:00:00", 61, 1.0)]
    assert bad.count() == 1


def test_wrong_number_is_refused(spark, folder):
    path = folder(a__csv="x,y\nabc,2\n")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        delimited.read_delimited(spark, path, {"x": "long"}).collect()


def test_missing_required_cell_is_refused(spark, folder):
    path = folder(a__csv="x,y\n,2\n")
    with pytest.raises(Exception, match="column x holds a missing value"):
        delimited.read_delimited(spark, path, {"x": "long"}, required=["x"]).collect()
    assert rows(delimited.read_delimited(spark, path, {"x": "long"})) == [(None,)]


def test_header_in_another_file_and_encoding(spark, folder):
    header = "Fallnummer;Probeneingangsdatum;Ergebnisdatum;Extra;Ergebniswert;Parameter-ID primär\n"
    path = folder(
        names__csv=header.encode("iso-8859-1"),
        main__csv="7;2020-01-01T10:00:00+0100;;weg;1,5;K_S\n",
    )
    names = delimited.names_from_file(spark, f"{path}/names.csv")
    assert names[-1] == "Parameter-ID primär"
    got = delimited.read_delimited(
        spark, f"{path}/main.csv", clinic.LAB, fmt=delimited.NAMES_ELSEWHERE, names=names
    )
    assert rows(got) == [(7, "2020-01-01T10:00:00+0100", None, "1,5", "K_S")]
    assert got.columns == list(clinic.LAB)


def test_full_lab_profiles(spark, folder):
    header = list(clinic.FULL_LAB)
    line = ["1", "2", "t1", "t2", "Kalium", "4,1", "mmol/l", "mmol/L", "3,5", "5,1", "K_S", "2823-3", "S"]
    path = folder(
        mini__csv=",".join(header) + "\n" + ",".join(f'"{c}"' for c in line) + "\n",
        original__csv=";".join(line) + "\n",
        names__csv=";".join(header).encode("iso-8859-1"),
    )
    want = [(1, 2, *line[2:])]
    assert rows(clinic.read_full_labs(spark, f"{path}/mini.csv", "mini")) == want
    assert rows(clinic.read_full_labs(spark, f"{path}/mini.csv", "clean")) == want
    original = clinic.read_full_labs(spark, f"{path}/original.csv", "original", f"{path}/names.csv")
    assert rows(original) == want
    with pytest.raises(ValueError, match="unknown profile"):
        clinic.read_full_labs(spark, path, "other")
    with pytest.raises(ValueError, match="column names"):
        clinic.read_full_labs(spark, path, "original")


def test_written_csv_reads_back(spark, tmp_path):
    df = spark.createDataFrame([(1, 'a "b", c'), (2, "zwei\nZeilen")], "x long, y string")
    path = tables.write_csv(df, str(tmp_path / "out.csv"))
    back = delimited.read_delimited(
        spark, path, {"x": "long", "y": "string"}, fmt=Format(multiline=True)
    )
    assert rows(back) == rows(df)
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        tables.write_csv(df, path)


def test_written_table_reads_back(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "x long, y string")
    path = tables.write_table(df, tables.stamped(str(tmp_path / "t")), partition_by=("y",))
    assert path.rpartition("/")[2][4] == "-" and path.endswith("_t")
    assert rows(tables.read_table(spark, path).select("x", "y")) == rows(df)


def test_formats_are_plain_options():
    assert COMMA.options()["sep"] == ","
    assert FREE_TEXT.options()["multiLine"] == "true"
