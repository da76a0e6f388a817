"""Text cleaning: delete every character that is not on an allow-list."""

from __future__ import annotations

import re
import string
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that cleaning keeps, and the text a null turns into.
KEPT_CHARACTERS = string.ascii_letters + string.digits + ",.\\\"'"
NULL_TOKEN = "None"


def other_than(keep: str) -> str:
    """Regular expression for one character outside ``keep``.

    The class names every character instead of using ranges like ``a-z``: Java turns a class of
    single Latin-1 characters into one bitmap lookup, but tests ranges one after the other. On long
    text that is about ten times faster, and the matches are the same.
    """
    return "[^" + "".join(c if c.isalnum() else "\\" + c for c in keep) + "]"


def clean_text(
    column: Column, keep: str = KEPT_CHARACTERS, null_token: str | None = NULL_TOKEN
) -> Column:
    """``column`` as text without the characters outside ``keep``.

    A null becomes ``null_token`` (cleaned like any other text); with ``null_token=None`` it stays null.
    """
    text = column.cast("string")
    if null_token is not None:
        text = F.coalesce(text, F.lit(null_token))
    return F.regexp_replace(text, other_than(keep), "")


def value_cleaner(
    keep: str = KEPT_CHARACTERS, null_token: str | None = NULL_TOKEN
) -> Callable[[object], str | None]:
    """Python twin of :func:`clean_text`, for columns whose Python text differs from Spark's."""
    unwanted = re.compile(other_than(keep))

    def clean(value):  # without annotations, which Spark would take for the kind of UDF
        if value is None:
            if null_token is None:
                return None
            value = null_token
        return unwanted.sub("", str(value))

    return clean
