"""Payload access: fields as the text that the document holds, and values of
a document parsed into a VARIANT."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# A number literal with all that precedes it: strings, and text outside of strings. Possessive
# throughout, so a match is one pass without recursion, and \\G goes on where the last number ended.
_NUMBER = r'(?s)\G((?:[^"0-9-]++|-(?![0-9])|"(?:[^"\\]++|\\.)*+")*+)(-?[0-9][0-9.eE+-]*+)'


def numbers_as_texts(payload: Column) -> Column:
    """The document with its number literals in quotes."""
    return F.regexp_replace(payload, _NUMBER, '$1"$2"')


def read_documents(df: DataFrame, payload: str, fields: dict[str, str], variant: Column | None = None) -> DataFrame:
    """``df`` with one- and two-level fields of its JSON documents as columns, as
    the text that the document holds: a number keeps its literal (``12.0``, ``1.50``
    and ``1e3`` stay as they are), of repeated keys the last counts, JSON null and a
    missing key give NULL. All are NULL for documents that are no objects. ``variant``
    (the document as a VARIANT) is added as ``_v``.

    The documents come out of a generator: above it every field is a plain
    column, so neither a filter nor a second use of a field reads the document again."""
    top: dict[str, list[str]] = {}
    for path in fields.values():
        head, _, rest = path.partition(".")
        top.setdefault(head, [])
        if rest:
            top[head].append(rest)
    kinds = ", ".join(f"{h}: " + (f"struct<{', '.join(f'{r}: string' for r in rest)}>" if rest else "string")
                      for h, rest in top.items())
    p = F.col(payload)
    # Read in the mode that nulls what does not fit: that the document is well-formed is checked on its own.
    doc = F.from_json(F.when(p.rlike(r"^\s*\{"), numbers_as_texts(p)), f"struct<{kinds}>")
    parts = [doc.alias("_doc"), *([] if variant is None else [variant.alias("_v")])]
    read = df.select("*", F.inline(F.array(F.struct(*parts))))
    return read.select(*df.columns, *([] if variant is None else ["_v"]),
                       *(_at(F.col("_doc"), path).alias(name) for name, path in fields.items()))


def _at(doc: Column, path: str) -> Column:
    for step in path.split("."):
        doc = doc[step]
    return doc


def payload_field(v: Column, path: str) -> Column:
    """A field as text, like ``->>``: JSON null and a missing key give NULL;
    numbers and booleans give their text."""
    return F.variant_get(v, f"$.{path}", "string")


def payload_text(v: Column, path: str) -> Column:
    """A nested object re-serialized as JSON text (NULL when absent)."""
    return F.to_json(F.variant_get(v, f"$.{path}", "variant"))


def json_timestamp_text(ts: Column) -> Column:
    """ISO text with microseconds and a ``Z`` suffix, as events carry it."""
    return F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z"))
