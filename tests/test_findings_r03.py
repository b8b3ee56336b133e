"""Cases of round 3's findings: zero durations, sums that meet a cap exactly, long texts with many edits."""

from __future__ import annotations

import math
import os
import random
import time
from itertools import accumulate

import duckdb
import pandas as pd
import pytest

from voxloom import registry
from voxloom.operators import caps, text_metrics

SF = "/root/testdata/sf0.001"
TABLES = "events documents labels".split()


@pytest.fixture(scope="module")
def zero_durations(tmp_path_factory):
    """The small tables, where each fifth event lasts no time, among them events with a text pair."""
    to = str(tmp_path_factory.mktemp("zero"))
    for t in TABLES:
        what = "* REPLACE (CASE WHEN event_id % 5 = 1 THEN 0e0 ELSE value END AS value)" if t == "events" else "*"
        duckdb.sql(f"COPY (SELECT {what} FROM read_parquet('{SF}/{t}.parquet')) TO '{to}/{t}.parquet' (FORMAT parquet)")
    return to


def ask(sf_dir, sql):
    c = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"{sf_dir}/{t}.parquet"):
            c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return c.sql(sql).fetchall()


def test_all_combined_with_zero_durations(spark, zero_durations):
    """Zero durations have no characters a second; they only lose their own rows."""
    run = lambda d: sorted(map(tuple, registry.queries()["filter_all_combined"](spark, d).collect()))
    silent = {h for (h,) in ask(zero_durations, "SELECT md5(CAST(event_id AS VARCHAR)) FROM events WHERE value = 0")}
    assert ask(zero_durations, "SELECT count(*) FROM events JOIN labels ON event_id = doc_id WHERE value = 0")[0][0] > 0
    whole = run(SF)
    assert run(zero_durations) == [r for r in whole if r[2] not in silent] != whole


def test_cps_range_with_zero_durations(spark, zero_durations):
    df = registry.queries()["filter_cps_range"](spark, zero_durations)
    want = ask(zero_durations, f"SELECT {', '.join(df.columns)} FROM ({registry.oracle_sql()['filter_cps_range']})")
    assert sorted(map(repr, map(tuple, df.collect()))) == sorted(map(repr, want)) and want


@pytest.fixture(scope="module")
def at_the_bounds():
    """speaker -> durations in hundredths, in order: 40 speakers whose clips add up to 2100 s exactly before more follow, 40 with just that in all, 40 with 1500 s."""
    draw, out = random.Random(3), {}
    for speaker in range(1, 121):
        of = 210000 if speaker <= 80 else 150000
        clips = []
        while sum(clips) < of - 9000:
            clips.append(draw.randint(1, 9000))
        out[speaker] = [*clips, of - sum(clips), *([4321, 17] if speaker <= 40 else [])]
    return out


@pytest.mark.parametrize("minimum", [None, 1500])
def test_minutes_that_meet_the_bounds(spark, at_the_bounds, minimum):
    rows = [(s * 1000 + i, f"{s}-{i}", s, c / 100) for s, cs in at_the_bounds.items() for i, c in enumerate(cs)]
    one_by_one = lambda cs: [*accumulate(c / 100 for c in cs)][-1]
    assert any(one_by_one(cs[:-2]) > 2100 for s, cs in at_the_bounds.items() if s <= 40) and any(one_by_one(cs) < 1500 for s, cs in at_the_bounds.items() if s > 80)
    clips = spark.createDataFrame(rows, "id long, audio_md5_hash string, speaker_id int, duration_seconds double").repartition(7)
    want = sorted(h for i, h, s, _ in rows if s > 40 or i % 1000 < len(at_the_bounds[s]) - 1)
    assert sorted(r[0] for r in caps.minutes_per_speaker(clips.drop("duration_seconds"), clips.select("audio_md5_hash", "duration_seconds"), 35, minimum).collect()) == want


def test_minutes_that_are_no_decimals(spark):
    rows = [(i, f"{s}-{i}", s, x) for s, xs in {1: [2000.0, math.nan, 5.0], 2: [1e300, 5.0], 3: [math.inf, 5.0], 4: [None, 5.0], 5: [None, None], 6: [1e300, -1e300, 5.0]}.items() for i, x in enumerate(xs)]
    clips = spark.createDataFrame(rows, "id long, audio_md5_hash string, speaker_id int, duration_seconds double")
    got = sorted(r[0] for r in caps.minutes_per_speaker(clips.drop("duration_seconds"), clips.select("audio_md5_hash", "duration_seconds"), 35).collect())
    assert got == ["1-0", "1-1", "2-0", "3-0", "4-0", "4-1", "6-0", "6-1", "6-2"]


def test_both_caps_where_minutes_meet_the_bound(spark, at_the_bounds, tmp_path):
    """The first speakers, each with as many clips more as a sample cap of 42 to 50 wants, after those that meet 2100 s."""
    ids, rows = (i for i in range(10**6) if i % 10 < 7 and i % 13), []
    for s, cs in at_the_bounds.items():
        if s <= 40 and s % 25:
            rows += [(next(ids), s, c / 100, j) for j, c in enumerate(cs)]
    last = {s: max(j for _, x, _, j in rows if x == s) for _, s, _, _ in rows}
    spark.createDataFrame([r[:3] for r in rows], "event_id long, user_id long, value double").write.parquet(str(tmp_path / "events.parquet"))
    for t in TABLES[1:]:
        os.symlink(f"{SF}/{t}.parquet", tmp_path / f"{t}.parquet")
    want = sorted(f"speaker_{s}/wavs/{i}.wav" for i, s, _, j in rows if j < last[s] and j < 50 and last[s] + 1 >= 42)
    assert sorted(r.path_to_wav for r in registry.queries()["speaker_caps_intersection"](spark, str(tmp_path)).collect()) == want and want


def square(a, b) -> int:
    """Edit distance, row by row."""
    row = [*range(len(b) + 1)]
    for i, x in enumerate(a, 1):
        old, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(old[j] + 1, row[-1] + 1, old[j - 1] + (x != y)))
    return row[-1]


def edited(draw, text: str, edits: int, letters: str) -> str:
    out = [*text]
    for _ in range(edits):
        at, kind = draw.randrange(len(out) + 1), draw.randrange(3)
        out[at : at + (kind < 2)] = [draw.choice(letters)] if kind else []
    return "".join(out)


@pytest.mark.parametrize("words", [False, True])
def test_edits_of_many_pairs(words):
    """Short pairs in one batch, from equal to unrelated, of few letters (many ways of one length) and of wide ones."""
    draw, pairs = random.Random(8), []
    for letters in ("ab", "abcdefgh ", "aé€", "a\U0001f600b"):
        for _ in range(60):
            a = "".join(draw.choices(letters, k=draw.choice([0, 1, 2, 9, 40, 150])))
            pairs += [(a, edited(draw, a, draw.choice([0, 1, 2, 5, len(a) // 8, len(a)]), letters)), (a, "".join(draw.choices(letters, k=draw.choice([0, 1, 30]))))]
    a, b = (pd.Series([[*p[i]] if words else p[i] for p in pairs] + [None, "x"][: 2 - words] + [["x"]] * words) for i in (0, 1))
    b.iloc[-1] = None
    assert text_metrics._counter()(a, b).tolist() == [square(*p) for p in pairs] + [pd.NA] * 2


def test_edits_of_long_pairs_take_a_band():
    """Pairs with few edits for their length: exact, and by a narrow part of the square."""
    draw = random.Random(9)
    long = ["".join(draw.choices("etaoin shrdlu", k=k)) for k in (60000, 59000, 58000, 57000)]
    a, b = pd.Series(long), pd.Series([x[:100] + x[104:30000] + "#" + x[30001:50000] + "##" + x[50000:-9] + "#" + x[-9:] for x in long])
    began = time.process_time()
    assert text_metrics._counter()(a, b).tolist() == [8] * 4
    assert time.process_time() - began < 1.2
