"""String and path expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body) -> Column:
    """body(value) with value computed once, also where body uses it inside a lambda."""
    return F.transform(F.array(value), body)[0]


def strip(c: Column) -> Column:
    """Without white space of any kind at either end."""
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def parent(path: Column) -> Column:
    """Path without its last component; empty for a bare name."""
    return F.when(path.contains("/"), F.regexp_replace(path, "/[^/]*$", "")).otherwise(F.lit(""))


def name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def stem(path: Column) -> Column:
    """Last component without its last suffix."""
    return F.regexp_replace(name(path), r"(?<=.)\.[^.]*$", "")


def relative_parts(path: Column, root: str) -> Column:
    """Directories between root and the file."""
    inner = F.regexp_replace(parent(path), "^" + _quoted(root.rstrip("/")) + "/?", "")
    return F.filter(F.split(inner, "/"), lambda x: x != "")


def _quoted(text: str) -> str:
    return "\\Q" + text.replace("\\E", "\\E\\\\E\\Q") + "\\E"


def normalize_alphabet(text: Column) -> Column:
    """Text reduced to letters, digits, spaces and . , ' ` : tags go, exclamation and question marks end sentences."""
    untagged = F.regexp_replace(text, "<[^>]*>", "")
    mapped = F.translate(untagged, "!?;:", "..,,")
    return F.regexp_replace(mapped, "[^a-zA-Z0-9 .,'`]", "")
