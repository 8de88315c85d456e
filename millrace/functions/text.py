"""Text helpers built from native column functions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character up to and including U+0020.
CONTROL_AND_SPACE = "".join(chr(code) for code in range(0x21))

# Fixed value: characters that are not ASCII letters, digits or spaces.
SPECIAL_CHARACTERS = "[^A-Za-z0-9 ]"


def trim_control(value: Column) -> Column:
    """Strip control characters and spaces (<= U+0020) from both ends.

    Spark's plain ``trim`` strips spaces only, so tabs would survive.
    """
    return F.trim(value, F.lit(CONTROL_AND_SPACE))


def tokens(value: Column, separator: str = ",") -> Column:
    """Split on a literal separator, keeping trailing empty tokens."""
    return F.split(value, re.escape(separator), -1)


def has_letters(value: Column) -> Column:
    """True when upper- and lower-casing differ; NULL for NULL."""
    return F.upper(value) != F.lower(value)


def strip_special(value: Column, pattern: str = SPECIAL_CHARACTERS) -> Column:
    """Remove special characters, inside whole-stage codegen."""
    return F.regexp_replace(value, pattern, "")


def strip_special_udf(pattern: str = SPECIAL_CHARACTERS):
    """The same rule as an Arrow-batched UDF, to be registered under a name that SQL text calls.

    Where columns can be used, ``strip_special`` is the faster one.  The body
    is nested so that it ships to executors by value and needs no installed
    copy of this package there.
    """
    import pandas as pd

    def strip(values):
        return values.str.replace(pattern, "", regex=True)

    strip.__annotations__ = {"values": pd.Series, "return": pd.Series}
    return F.pandas_udf(strip, "string")


def known_or_default(value: Column, cleaned: Column, default: str = "Unknown") -> Column:
    """``cleaned`` where ``value`` is present, otherwise the default text."""
    return F.when(value.isNotNull(), cleaned).otherwise(F.lit(default))


def composite_key(*parts: Column, separator: str = "") -> Column:
    """Concatenate parts as strings; NULL if any part is NULL.

    Without a separator (1, 23) and (12, 3) give the same key.
    """
    texts = [part.cast("string") for part in parts]
    if not separator:
        return F.concat(*texts)
    spaced = [texts[0]]
    for text in texts[1:]:
        spaced += [F.lit(separator), text]
    return F.concat(*spaced)


def protocol_of(url: Column) -> Column:
    """Classify a URL by the scheme text found anywhere in it.

    The secure scheme contains the other one, so it has to be tested first.
    A NULL URL has no protocol.
    """
    return (
        F.when(F.instr(url, "https") > 0, F.lit("httpsecured"))
        .when(F.instr(url, "http") > 0, F.lit("httpnonsecured"))
        .otherwise(F.lit("noprotocol"))
    )
