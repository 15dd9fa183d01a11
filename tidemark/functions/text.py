"""Text expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The two shell literals of a document-database dump.
OBJECT_ID_LITERAL = r'ObjectId\("([0-9a-fA-F]+)"\)'
ISO_DATE_LITERAL = r'ISODate\("([^"]+)"\)'


def excerpt(text: Column, length: int = 50) -> Column:
    """At most ``length`` characters, followed by ``...`` when text was cut."""
    cut = F.concat(F.substring(text, 1, length), F.lit("..."))
    return F.when(F.length(text) > length, cut).otherwise(text)


def extended_json(line: Column) -> Column:
    """Rewrite shell object-id and date literals to extended JSON."""
    ids = F.regexp_replace(line, OBJECT_ID_LITERAL, r'{"\$oid": "$1"}')
    return F.regexp_replace(ids, ISO_DATE_LITERAL, r'{"\$date": "$1"}')


def safe_metric_name(name: Column) -> Column:
    """Lower-case; every run of characters outside ``[a-zA-Z0-9:_]`` becomes one ``_``."""
    return F.lower(F.regexp_replace(name, "[^a-zA-Z0-9:]+", "_"))
