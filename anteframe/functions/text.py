"""Identification of a report by the head of its text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Character classes (Unicode line breaks, the other blanks, digits) and the header
# line, e.g. "01.02.2003 -- ABC --  Befund  --  4/05  --".
BREAKS = r"\n\r\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}"
BLANKS = r"\t\x1f \x{a0}\x{1680}\x{2000}-\x{200a}\x{202f}\x{205f}\x{3000}"
BLANK = f"[{BLANKS}]"
DIGIT = r"\p{Nd}"
HEADER = (
    f"{DIGIT}{{2}}\\.{DIGIT}{{2}}\\.{DIGIT}{{4}}{BLANK}-+{BLANK}[A-Z0-9-]{{3,6}}{BLANK}-+{BLANK}+"
    f"[A-Za-z]{{5,12}}{BLANK}+-+{BLANK}+{DIGIT}{{1,9}}/{DIGIT}{{2}}{BLANK}+-+"
)
HEAD_LINES = 4

# A line break together with all blank lines after it.
NEXT_TEXT = f"[{BREAKS}](?:[{BREAKS}{BLANKS}]*[{BREAKS}])?"
NOT_BLANK = f"[^{BREAKS}{BLANKS}]"


def report_head(content: Column) -> Column:
    """Struct ``(head, number, date)`` of a report text.

    A header line gives number and date. Without one the first four lines that are not blank,
    joined, stand in as ``head``. A missing text gives three nulls.
    """
    # The line of the first header: what precedes the header since the last break, and the rest.
    before = F.regexp_replace(F.regexp_replace(content, f"{HEADER}[\\s\\S]*", ""), f"[{BREAKS}]", "\n")
    rest = F.regexp_extract(content, f"{HEADER}[^{BREAKS}]*", 0)
    line = F.concat(F.substring_index(before, "\n", -1), rest)
    header = F.when(content.rlike(HEADER), line)
    without_rules = F.regexp_replace(header, f"{BLANK}+-+{BLANK}*", " ")
    parts = F.split(F.regexp_replace(without_rules, f"^{BLANK}+|{BLANK}+$", ""), " ")
    # Only the first piece and the end of the text can be blank. What follows the pieces looked at
    # stays unsplit, so a long text is not taken apart for its head.
    looked_at = HEAD_LINES + 1
    top = F.slice(F.split(content, NEXT_TEXT, looked_at + 1), 1, looked_at)
    lines = F.slice(F.filter(top, lambda x: x.rlike(NOT_BLANK)), 1, HEAD_LINES)
    # Bound as a lambda argument, the parts are worked out once for all three fields.
    found = F.transform(
        F.array(parts),
        lambda p: F.struct(
            F.when(p.isNull(), F.array_join(lines, "")).alias("head"),
            F.element_at(p, -1).alias("number"),
            F.get(p, F.lit(0)).alias("date"),
        ),
    )
    return F.get(found, F.lit(0))
