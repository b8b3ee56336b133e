"""Word intervals and punctuation from pauses."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.strings import strip


def to_json(intervals: Column) -> Column:
    return F.to_json(intervals)


def punctuate(intervals: Column, comma: float = 0.15, period: float = 0.3) -> Column:
    """Words in order; a silence, unless it is first, gives a comma or a period if it is longer than that.

    The text is stripped, ends in a period, and runs of marks and spaces are reduced in a fixed order.
    """
    pause = lambda x: F.when(x["duration"] > period, ". ").when(x["duration"] > comma, ", ").otherwise("")
    part = lambda x, i: F.when(x["text"] != "", F.concat(x["text"], F.lit(" "))).when(i == 0, "").otherwise(pause(x))
    text = F.concat(strip(F.array_join(F.transform(intervals, part), "")), F.lit("."))
    text = F.regexp_replace(F.regexp_replace(text, "[,.]{2,}", "."), r"\s{2,}", " ")
    return F.replace(F.replace(text, F.lit(" ."), F.lit(".")), F.lit(" ,"), F.lit(","))
