"""Fields of JSON documents by type, through the variant form: a document is parsed once, whatever is taken from it."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def document(text: Column, strict: bool = True) -> Column:
    """A JSON text as a variant; text that is no JSON fails the query, or is null where ``strict`` is off."""
    return F.parse_json(text) if strict else F.try_parse_json(text)


def typed_field(value: Column, path: str, kind: str, strict: bool = True) -> Column:
    """The field at ``path`` (``$.a.b[0]``) as a value of type ``kind``; null where there is none.

    A field that is no such value fails the query, or is null where ``strict`` is off.
    """
    return (F.variant_get if strict else F.try_variant_get)(value, path, kind)


def document_text(value: Column) -> Column:
    """A variant as JSON text, without blanks."""
    return F.to_json(value)
