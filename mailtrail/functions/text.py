"""Text clean-up and field splitting. All Column -> Column, evaluated in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters a strict trim removes (Unicode white space and U+001C-U+001F).
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    + "".join(chr(c) for c in range(0x2000, 0x200B))
    + "\u2028\u2029\u202f\u205f\u3000"
)

# One CSV field after a comma: quoted (doubled quotes inside, closed or running to the end
# of the line, text after the closing quote kept) or plain. Possessive loops: no backtracking.
_FIELD = r',("[^"]*+(?:""[^"]*+)*+(?:"[^,]*+|\z)|[^,]*+)'
_QUOTED = r'(?s)^"([^"]*+(?:""[^"]*+)*+)(?:"(.*))?\z'


def strip(value: Column) -> Column:
    """Trim every kind of white space."""
    return F.btrim(value, F.lit(WHITESPACE))


def is_blank_mark(trimmed: Column) -> Column:
    """True for null, '' and '-' (never null)."""
    return trimmed.isNull() | trimmed.isin("", "-")


def optional_text(trimmed: Column) -> Column:
    """Null, '' and '-' become null."""
    return F.when(~is_blank_mark(trimmed), trimmed)


def counter_text(trimmed: Column) -> Column:
    """Null, '' and '-' become '0'."""
    return F.when(is_blank_mark(trimmed), F.lit("0")).otherwise(trimmed)


def split_fields(line: Column) -> Column:
    """Fields of one physical CSV line; a blank line has none.

    Lines without a quote, nearly all of them, take the plain split.
    """
    found = F.regexp_extract_all(F.concat(F.lit(","), line), F.lit(_FIELD), F.lit(1))
    unquoted = F.transform(
        found,
        lambda f: F.when(
            f.startswith('"'),
            F.concat(
                F.replace(F.regexp_extract(f, _QUOTED, 1), F.lit('""'), F.lit('"')),
                F.regexp_extract(f, _QUOTED, 2),
            ),
        ).otherwise(f),
    )
    return (
        F.when(line == "", F.array().cast("array<string>"))
        .when(~F.contains(line, F.lit('"')), F.split(line, ",", -1))
        .otherwise(unquoted)
    )


def two_digits(value: Column) -> Column:
    return F.lpad(value.cast("string"), 2, "0")
