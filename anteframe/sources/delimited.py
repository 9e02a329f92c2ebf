"""Delimited text files with untidy cells.

Every cell is read as text. Missing-value tokens, types and required columns are dealt with by
expressions afterwards, so a wrong cell is found by name instead of silently emptying its row.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..columns import col
from ..operators.sets import union_all

# The cells that count as missing.
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

RAW_LINE = "_raw_line"


@dataclass(frozen=True)
class Format:
    """How a family of files is written.

    ``blank_text``: empty cells stay empty texts and no token means "missing".
    ``multiline``: quoted cells may hold line breaks. Such files cannot be split, so large ones
    are best converted to parquet once.
    """

    sep: str = ","
    encoding: str = "UTF-8"
    header: bool = True
    multiline: bool = False
    blank_text: bool = False

    def options(self) -> dict[str, str]:
        return {
            "sep": self.sep,
            "encoding": self.encoding,
            "header": str(self.header).lower(),
            "multiLine": str(self.multiline).lower(),
            "quote": '"',
            "escape": '"',
            # The header of each file is compared with the schema while it is read, and cells are
            # counted. Both need whole lines; unused cells are still not turned into columns.
            "enforceSchema": "false",
            "columnPruning": "false",
            "mode": "PERMISSIVE",
            "columnNameOfCorruptRecord": RAW_LINE,
        }


COMMA = Format()
SEMICOLON = Format(sep=";")
NAMES_ELSEWHERE = Format(sep=";", header=False)
NAMES_FILE = Format(sep=";", header=False, encoding="ISO-8859-1")
FREE_TEXT = Format(multiline=True, blank_text=True)


def blank_na(c: Column) -> Column:
    """Null for a missing-value token."""
    return F.when(~c.isin(*NA_TOKENS), c)


def header_of(spark: SparkSession, path: str | Sequence[str], fmt: Format = COMMA) -> list[str]:
    """Column names in the first line of the (first) file."""
    line = _reader(spark, replace(fmt, header=False)).csv(path).first()
    if line is None:
        raise ValueError(f"no header line in {path}")
    return list(line)


def names_from_file(spark: SparkSession, path: str, fmt: Format = NAMES_FILE) -> list[str]:
    """Column names for files without a header, kept in a file of their own."""
    return [n for n in header_of(spark, path, fmt) if n is not None]


def _reader(spark: SparkSession, fmt: Format):
    # Only *.csv files of a folder are data.
    return spark.read.options(**fmt.options()).option("pathGlobFilter", "*.csv")


def read_raw(
    spark: SparkSession,
    path: str | Sequence[str],
    fmt: Format = COMMA,
    names: Sequence[str] | None = None,
) -> DataFrame:
    """All columns as text, plus the raw line of rows with a wrong number of cells.

    All files must have the same columns in the same order, else the read fails.
    """
    names = list(names) if names else header_of(spark, path, fmt)
    if len(set(names)) != len(names):
        raise ValueError(f"column names are not unique: {names}")
    fields = [T.StructField(n, T.StringType()) for n in [*names, RAW_LINE]]
    return _reader(spark, fmt).schema(T.StructType(fields)).csv(path)


def overlong(df: DataFrame, fmt: Format) -> Column:
    """True for rows with more cells than columns; short rows are merely filled with nulls."""
    cells = [c for c in df.columns if c != RAW_LINE]
    n = len(cells)
    wider = ", ".join(f"c{i} STRING" for i in range(n + 1))
    options = {"sep": fmt.sep, "quote": '"', "escape": '"', "mode": "PERMISSIVE"}
    extra = F.from_csv(col(RAW_LINE), wider, options)[f"c{n}"]
    # Spark reads the raw line only together with a cell, so one is named in the condition.
    with_a_cell = F.length(F.concat_ws("", col(cells[0]))) >= 0
    return F.coalesce(extra.isNotNull() & with_a_cell, F.lit(False))


def split_bad_lines(df: DataFrame, fmt: Format) -> tuple[DataFrame, DataFrame]:
    """(usable rows, raw lines with too many cells)."""
    bad = overlong(df, fmt)
    return df.where(~bad).drop(RAW_LINE), df.where(bad).select(RAW_LINE)


def typed(
    df: DataFrame,
    columns: Mapping[str, str],
    required: Sequence[str] = (),
    blank_text: bool = False,
) -> DataFrame:
    """The given columns with their types, in the given order.

    A cell that does not fit its type fails the query, and so does a missing required cell.
    """
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"columns {missing} are not in {df.columns}")

    def cell(name: str, kind: str) -> Column:
        if kind == "string":
            text = F.coalesce(col(name), F.lit("")) if blank_text else blank_na(col(name))
            return text.alias(name)
        text = blank_na(col(name))
        if kind in ("int", "long"):
            # Columns with missing cells come as 57.0 from tools that know whole numbers only as floats.
            text = F.regexp_replace(text, r"^(\s*[+-]?\d+)\.0*\s*$", "$1")
        value = text.cast(kind)
        if name in required:
            message = F.lit(f"column {name} holds a missing value")
            value = F.when(value.isNull(), F.raise_error(message).cast(kind)).otherwise(value)
        return value.alias(name)

    return df.select(*[cell(c, kind) for c, kind in columns.items()])


def files_by_header(
    spark: SparkSession, path: str | Sequence[str], fmt: Format, wanted: Sequence[str] | None
) -> dict[tuple[str, ...], list[str]]:
    """The files of each header. The ``wanted`` columns (default: all) must be the same in all,
    in the same order and case; other columns may differ.

    One small read per file: a folder holds a few exports, each of any size.
    """
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(path)
    files = sorted(r.path for r in listed.select("path").collect())
    if not files:
        raise ValueError(f"no *.csv file in {path}")
    found: dict[tuple[str, ...], list[str]] = {}
    for file in files:
        found.setdefault(tuple(header_of(spark, file, fmt)), []).append(file)
    kept = {tuple(c for c in h if wanted is None or c in wanted): f for h, f in found.items()}
    if len(kept) > 1:
        raise ValueError(f"files have other columns in their header: {kept}")
    missing = [c for c in wanted or () if c not in next(iter(kept))]
    if missing:
        raise ValueError(f"columns {missing} are not in {files}")
    return found


def with_bad_lines_refused(df: DataFrame, fmt: Format) -> DataFrame:
    """All rows; a line with too many cells fails the query."""
    wrong = F.raise_error(F.concat(F.lit("line with too many cells: "), col(RAW_LINE)))
    return df.where(F.when(overlong(df, fmt), wrong.cast("boolean")).otherwise(True)).drop(RAW_LINE)


def read_delimited(
    spark: SparkSession,
    path: str | Sequence[str],
    columns: Mapping[str, str] | None = None,
    *,
    fmt: Format = COMMA,
    names: Sequence[str] | None = None,
    required: Sequence[str] = (),
    bad_lines: str = "error",
) -> DataFrame:
    """Columns of one file, several files or all ``*.csv`` files of a folder.

    Without ``columns`` every column is read as text. A line with too many cells fails the query;
    with ``bad_lines="set_aside"`` it is left out, and ``bad_lines_of`` returns all such lines.
    """
    if bad_lines not in ("error", "set_aside"):
        raise ValueError(f"bad_lines is 'error' or 'set_aside', not {bad_lines!r}")
    parts = []
    for part in _raw_parts(spark, path, columns, fmt, names):
        refused = bad_lines == "error"
        rows = with_bad_lines_refused(part, fmt) if refused else split_bad_lines(part, fmt)[0]
        kinds = columns or dict.fromkeys(rows.columns, "string")
        parts.append(typed(rows, kinds, required, fmt.blank_text))
    return union_all(*parts)


def bad_lines_of(
    spark: SparkSession,
    path: str | Sequence[str],
    columns: Mapping[str, str] | None = None,
    *,
    fmt: Format = COMMA,
    names: Sequence[str] | None = None,
) -> DataFrame:
    """The raw lines with too many cells, as ``read_delimited`` sets them aside."""
    parts = _raw_parts(spark, path, columns, fmt, names)
    return union_all(*[split_bad_lines(p, fmt)[1] for p in parts])


def _raw_parts(
    spark: SparkSession,
    path: str | Sequence[str],
    columns: Mapping[str, str] | None,
    fmt: Format,
    names: Sequence[str] | None,
) -> list[DataFrame]:
    """The files read as they are, one part for each header; mostly one."""
    if names or not fmt.header:
        return [read_raw(spark, path, fmt, names)]
    found = files_by_header(spark, path, fmt, list(columns) if columns else None)
    return [read_raw(spark, files, fmt, header) for header, files in found.items()]
