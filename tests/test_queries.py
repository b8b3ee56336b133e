"""Every registered query against its SQL twin on the small tables."""

from __future__ import annotations

import math

import duckdb
import numpy as np
import pytest

from voxloom import registry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def shown(rows):
    return sorted(tuple("" if v is None or isinstance(v, float) and math.isnan(v) else repr(float(v)) if isinstance(v, int | float) else str(v) for v in r) for r in rows)


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, duck, name):
    df = registry.queries()[name](spark, SF)
    columns = sorted(df.columns)
    got = [tuple(r) for r in df.select(*columns).collect()]
    if name not in registry.oracle_sql():
        assert got
        return
    want = duck.sql(f"SELECT {', '.join(columns)} FROM ({registry.oracle_sql()[name]})").fetchall()
    assert shown(got) == shown(want)


def edits(a, b) -> int:
    """Edit distance, the whole square row by row."""
    seen = {}
    a, b = (np.array([seen.setdefault(x, len(seen)) for x in s], dtype=np.int64) for s in (a, b))
    at = np.arange(len(b) + 1)
    row = at.copy()
    for i, x in enumerate(a, 1):
        down = np.minimum(row[1:] + 1, row[:-1] + (b != x))
        row = np.minimum.accumulate(np.concatenate([[i], down]) - at) + at
    return int(row[-1])


@pytest.fixture(scope="module")
def rates(duck):
    """hash -> (WER, CER) of whole texts."""
    pairs = duck.sql(registry.fixtures.sql(registry._PAIRS)).fetchall()
    out = {}
    for key, r, h in pairs:
        rw, hw = ([w for w in t.split(" ") if w] for t in (r, h))
        rc, hc = r.strip(" "), h.strip(" ")
        out[key] = (edits(rw, hw) / len(rw) if rw else None, edits(rc, hc) / len(rc) if rc else None)
    return out


def test_rates_of_whole_texts(spark, duck, rates):
    assert sum(w > 0 for w, _ in rates.values()) > len(rates) / 2
    assert dict(map(tuple, registry.queries()["wer_pairs"](spark, SF).select("audio_md5_hash", "WER").collect())) == {k: w for k, (w, _) in rates.items() if w is not None}
    assert dict(map(tuple, registry.queries()["cer_pairs"](spark, SF).select("audio_md5_hash", "CER").collect())) == {k: c for k, (_, c) in rates.items()}
    done = {k for (k,) in duck.sql("SELECT md5(CAST(doc_id AS VARCHAR)) FROM documents WHERE doc_id % 5 = 0").fetchall()}
    got = registry.queries()["wer_cer_incremental"](spark, SF).select("audio_md5_hash", "WER", "CER").collect()
    assert {k: (w, c) for k, w, c in got} == {k: v for k, v in rates.items() if k not in done}


@pytest.mark.parametrize("name", ["filter_wer_range", "filter_cer_range", "filter_all_combined"])
def test_filters_by_rates(spark, duck, rates, name):
    low, high = {"filter_wer_range": ((0.1, 0.5), None), "filter_cer_range": (None, (0.01, 0.3)), "filter_all_combined": ((0, 0.95), (0, 0.9))}[name]
    more = ""
    if name == "filter_all_combined":
        more = """ AND m.sample_rate = 44100 AND m.channels = 1 AND m.duration_seconds BETWEEN 1 AND 60 AND m.SNR BETWEEN -45e-1 AND 14 AND m.dBFS >= -55
            AND a.cps BETWEEN 5e-1 AND 400 AND d.speaker_id <> -1 AND a.text IS NOT NULL AND o.text IS NOT NULL"""
    rows = duck.sql(registry.fixtures.sql(registry._JOIN + more)).fetchall()
    inside = lambda x, span: span is None or x is not None and span[0] <= x <= span[1]
    want = [r for r in rows if r[2] in rates and inside(rates[r[2]][0], low) and inside(rates[r[2]][1], high)]
    got = registry.queries()[name](spark, SF).select("path_to_wav", "speaker_id", "hash", "original_text", "asr_text").collect()
    assert sorted(map(tuple, got)) == sorted(want) and want


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
