"""Text functions whose edge cases differ from Spark's own."""

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_not_blank(text: Column) -> Column:
    """Not null, and something is left after stripping every character up to U+0020.

    ``trim`` strips spaces only; here tabs, line ends and control characters are blank too.
    """
    return text.isNotNull() & text.rlike(r"[^\x00-\x20]")


def split_list(text: Column, separator: str = ",") -> Column:
    """Split at ``separator``; empty parts at the end are dropped, all others are kept.

    ``'1,2,,'`` has 2 parts, ``','`` none, ``'1,,2'`` 3, and the empty text one empty part.
    """
    pattern = re.escape(separator)
    body = F.regexp_replace(text, rf"(?:{pattern})+\z", "")
    return (
        F.when(~text.endswith(separator), F.split(text, pattern))
        .when(body == "", F.array().cast("array<string>"))
        .otherwise(F.split(body, pattern))
    )


def zero_last_character(text: Column) -> Column:
    """Replace the last character by ``0`` (seconds ``25`` become ``20``)."""
    return F.concat(F.substr(text, F.lit(1), F.length(text) - 1), F.lit("0"))


def json_text_field(document: Column, key: str) -> Column:
    """One field of a JSON text, as text."""
    return F.get_json_object(document, f"$.{key}")
