"""Pluggable batch models: recognition, enhancement, alignment. A model is loaded once a task and sees batches."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def run_model(rows: DataFrame, key: str, value: str, load: Callable[[], Callable[[list], list]], output: str, kind: str, batch: int = 10) -> DataFrame:
    """key and the model's output for each row; outputs may be None.

    Rows that are done should be taken out before (``incremental.new_rows``): no filter passes a model.
    """

    def run(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = load()
        for frame in frames:
            for i in range(0, len(frame), batch):
                some = frame.iloc[i : i + batch]
                yield pd.DataFrame({key: some[key], output: pd.Series(model(list(some[value])), index=some.index, dtype=object)})

    return rows.select(key, value).mapInPandas(run, f"{key} {dict(rows.dtypes)[key]}, {output} {kind}")


def processed(results: DataFrame, output: str) -> DataFrame:
    return results.where(F.col(output).isNotNull())


def report(results: DataFrame, output: str) -> DataFrame:
    """total and unprocessed rows."""
    return results.agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col(output).isNull()).alias("unprocessed"))


def fake_recognizer() -> Callable[[list], list]:
    """Deterministic stand-in: names a clip by its length and sign changes; nothing for silence."""

    def model(clips: list) -> list:
        out = []
        for c in clips:
            signs = [x > 0 for x in c]
            out.append(f"clip of {len(c)} with {sum(a != b for a, b in zip(signs, signs[1:], strict=False))} turns" if any(c) else None)
        return out

    return model


def identity_enhancer() -> Callable[[list], list]:
    return lambda clips: [[float(x) for x in c] for c in clips]
