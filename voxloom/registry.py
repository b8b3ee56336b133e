"""Named queries over the driver tables, each with its SQL twin where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import strings
from .operators import alignment, caps, incremental, layout, lookups, models, signal, text_metrics
from .plans import fixtures
from .plans.config import DEFAULT
from .plans.filter_dataset import filter_dataset, with_text
from .sources import texts

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}
MAIN = "ds_main"


def query(name: str, sql: str | None = None):
    def keep(f: Callable[[SparkSession, str], DataFrame]):
        _QUERIES[name] = f
        if sql is not None:
            _SQL[name] = fixtures.sql(sql)
        return f

    return keep


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


# Filters: one configuration each. Error rates have no SQL: DuckDB's edit distance counts bytes and is quadratic in whole texts, so tests compare them with brute force.
_JOIN = """SELECT d.path_to_file AS path_to_wav, d.speaker_id, d.audio_md5_hash AS hash, o.text AS original_text, a.text AS asr_text
FROM v_audio_to_dataset d LEFT JOIN v_audio_metrics m ON m.audio_md5_hash = d.audio_md5_hash
LEFT JOIN v_audio_to_original_text o ON o.audio_md5_hash = d.audio_md5_hash
LEFT JOIN v_audio_to_asr_text a ON a.audio_md5_hash = d.audio_md5_hash WHERE d.dataset_name = 'ds_main'"""
_DEFAULT_SQL = " AND m.sample_rate = 44100 AND m.channels = 1 AND m.duration_seconds BETWEEN 1 AND 15 AND d.speaker_id <> -1"
_CAP_SAMPLES = """SELECT audio_md5_hash FROM (SELECT *, count(audio_md5_hash) OVER (PARTITION BY speaker_id) AS cnt,
  row_number() OVER (PARTITION BY speaker_id ORDER BY id, audio_md5_hash) AS rn FROM v_audio_to_dataset WHERE dataset_name = 'ds_main')
WHERE (cnt > {max} AND rn <= {max}) OR (cnt <= {max} AND cnt >= {min})"""
_CAP_MINUTES = """SELECT audio_md5_hash FROM (SELECT d.*, m.duration_seconds AS s, sum(m.duration_seconds) OVER (PARTITION BY speaker_id) AS t,
  coalesce(sum(m.duration_seconds) OVER (PARTITION BY speaker_id ORDER BY m.duration_seconds IS NULL, id, d.audio_md5_hash ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM v_audio_to_dataset d LEFT JOIN v_audio_metrics m ON m.audio_md5_hash = d.audio_md5_hash WHERE dataset_name = 'ds_main')
WHERE CASE WHEN t > {max} * 60 THEN s IS NOT NULL AND before <= {max} * 60 ELSE t IS NOT NULL AND t >= {min} END"""
_BOTH_CAPS = f" AND d.audio_md5_hash IN ({_CAP_SAMPLES.format(max=50, min=42)}) AND d.audio_md5_hash IN ({_CAP_MINUTES.format(max=35, min=1500)})"
_CAPS = {"samples_per_speaker": {"min": 42, "max": 50}, "minutes_per_speaker": {"min": 1500, "max": 35}}
_EVERYTHING = {
    "sample_rate": 44100, "channels": 1, "duration": {"min": 1, "max": 60}, "SNR": {"min": -4.5, "max": 14.0}, "dBFS": {"min": -55.0, "max": None}, "CER": {"min": None, "max": 0.9},
    "WER": {"min": None, "max": 0.95}, "CPS": {"min": 0.5, "max": 400.0}, "use_unknown_speakers": False, "only_with_ASR_texts": True, "only_with_Original_texts": True,
}
_CONFIGS = {
    "filter_default_config": (DEFAULT, _DEFAULT_SQL),
    "filter_sample_rate": ({"sample_rate": 22050}, " AND m.sample_rate = 22050"),
    "filter_channels": ({"channels": 2}, " AND m.channels = 2"),
    "filter_duration_range": ({"duration": {"min": 5, "max": 20}}, " AND m.duration_seconds BETWEEN 5 AND 20"),
    "filter_duration_min_only": ({"duration": {"min": 40, "max": None}}, " AND m.duration_seconds >= 40"),
    "filter_duration_max_only": ({"duration": {"max": 10}}, " AND m.duration_seconds <= 10"),
    "filter_snr_range": ({"SNR": {"min": 0.5, "max": 9.5}}, " AND m.SNR BETWEEN 5e-1 AND 95e-1"),
    "filter_dbfs_range": ({"dBFS": {"min": -30.0, "max": -5.0}}, " AND m.dBFS BETWEEN -30 AND -5"),
    "filter_wer_range": ({"WER": {"min": 0.1, "max": 0.5}}, None),
    "filter_cer_range": ({"CER": {"min": 0.01, "max": 0.3}}, None),
    "filter_cps_range": ({"CPS": {"min": 2.0, "max": 30.0}}, " AND a.cps BETWEEN 2 AND 30"),
    "filter_known_speakers": ({"use_unknown_speakers": False}, " AND d.speaker_id <> -1"),
    "filter_with_asr_text": ({"only_with_ASR_texts": True}, " AND a.text IS NOT NULL"),
    "filter_with_original_text": ({"only_with_Original_texts": True}, " AND o.text IS NOT NULL"),
    "filter_all_combined": (_EVERYTHING, None),
    "speaker_caps_intersection": (_CAPS, _BOTH_CAPS),
    "filter_default_with_caps": (DEFAULT | _CAPS, _DEFAULT_SQL + _BOTH_CAPS),
    "filter_lone_minimum": ({"samples_per_speaker": {"min": 60, "max": None}}, ""),
}
for _name, (_config, _where) in _CONFIGS.items():
    query(_name, None if _where is None else _JOIN + _where)(lambda spark, sf_dir, c=_config: filter_dataset(fixtures.tables(spark, sf_dir), MAIN, c))


@query("filter_include_text", f"SELECT path_to_wav, speaker_id, hash, coalesce(original_text, asr_text) AS text FROM ({_JOIN}{_DEFAULT_SQL}) WHERE coalesce(original_text, asr_text) IS NOT NULL")
def _(spark, sf_dir):
    return with_text(filter_dataset(fixtures.tables(spark, sf_dir), MAIN, DEFAULT), include_text=True)


@query("filter_without_text", f"SELECT path_to_wav, speaker_id, hash FROM ({_JOIN}{_DEFAULT_SQL})")
def _(spark, sf_dir):
    return with_text(filter_dataset(fixtures.tables(spark, sf_dir), MAIN, DEFAULT))


# Speakers.
def _main(spark, sf_dir):
    t = fixtures.tables(spark, sf_dir)
    return t["audio_to_dataset"].where(F.col("dataset_name") == MAIN), t["audio_metrics"]


@query("speaker_sample_counts", "SELECT speaker_id, count(audio_md5_hash) AS n FROM v_audio_to_dataset WHERE dataset_name = 'ds_main' GROUP BY speaker_id")
def _(spark, sf_dir):
    return _main(spark, sf_dir)[0].groupBy("speaker_id").agg(F.count("audio_md5_hash").alias("n"))


@query("speaker_total_duration", "SELECT speaker_id, round(sum(duration_seconds), 4) AS seconds FROM v_audio_to_dataset JOIN v_audio_metrics USING (audio_md5_hash) WHERE dataset_name = 'ds_main' GROUP BY speaker_id")
def _(spark, sf_dir):
    clips, metrics = _main(spark, sf_dir)
    return clips.join(metrics, "audio_md5_hash").groupBy("speaker_id").agg(F.round(F.sum("duration_seconds"), 4).alias("seconds"))


for _name, _max, _min in (("samples_per_speaker_max", 50, None), ("samples_per_speaker_min_max", 50, 42)):
    query(_name, _CAP_SAMPLES.format(max=_max, min=_min or 0))(lambda spark, sf_dir, a=_max, b=_min: caps.samples_per_speaker(_main(spark, sf_dir)[0], a, b))
for _name, _max, _min in (("minutes_per_speaker_max", 35, None), ("minutes_per_speaker_min_max", 35, 1500)):
    query(_name, _CAP_MINUTES.format(max=_max, min=_min or 0))(lambda spark, sf_dir, a=_max, b=_min: caps.minutes_per_speaker(*_main(spark, sf_dir), a, b))


@query("first_n_per_speaker", "SELECT id, speaker_id FROM (SELECT *, row_number() OVER (PARTITION BY speaker_id ORDER BY id) AS rn FROM v_audio_to_dataset) WHERE rn <= 5")
def _(spark, sf_dir):
    return incremental.first_n(fixtures.tables(spark, sf_dir)["audio_to_dataset"], "speaker_id", ["id"], 5).select("id", "speaker_id")


@query("speaker_enumeration", "SELECT user_id, row_number() OVER (ORDER BY user_id) - 1 AS speaker_id FROM (SELECT DISTINCT user_id FROM events)")
def _(spark, sf_dir):
    return layout.number_speakers(fixtures.table(spark, sf_dir, "events"), ["user_id"]).select("user_id", F.col("speaker_id").cast("long").alias("speaker_id"))


@query("batch_numbering", "SELECT event_id, (row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1) // 10 AS batch FROM events")
def _(spark, sf_dir):
    from pyspark.sql import Window as W

    rn = F.row_number().over(W.partitionBy("user_id").orderBy("event_id"))
    return fixtures.table(spark, sf_dir, "events").select("event_id", F.floor((rn - 1) / 10).alias("batch"))


@query("all_processed_speakers", "SELECT user_id, bool_and(event_type <> 'purchase') AS processed FROM events GROUP BY user_id")
def _(spark, sf_dir):
    return fixtures.table(spark, sf_dir, "events").groupBy("user_id").agg(F.bool_and(F.col("event_type") != "purchase").alias("processed"))


@query("merge_datasets_rekey_speakers", """WITH k AS (SELECT dataset_name, speaker_id, row_number() OVER (ORDER BY dataset_name, speaker_id) - 1 AS n FROM (SELECT DISTINCT dataset_name, speaker_id FROM v_audio_to_dataset WHERE speaker_id <> -1))
SELECT d.audio_md5_hash, d.dataset_name || '/' || d.path_to_file AS path_to_wav, CAST(coalesce(k.n, -1) AS INT) AS speaker_id FROM v_audio_to_dataset d LEFT JOIN k ON k.dataset_name = d.dataset_name AND k.speaker_id = d.speaker_id""")
def _(spark, sf_dir):
    return layout.merge_datasets(fixtures.tables(spark, sf_dir)["audio_to_dataset"])


@query("list_parent_directories", "SELECT DISTINCT regexp_replace(path_to_file, '/[^/]*$', '') AS directory FROM v_audio_to_dataset")
def _(spark, sf_dir):
    return fixtures.tables(spark, sf_dir)["audio_to_dataset"].select(strings.parent(F.col("path_to_file")).alias("directory")).distinct()


# Hashes, duplicates, incremental work.
@query("dedupe_full_rows", "SELECT DISTINCT md5(text) AS hash, lang FROM documents")
def _(spark, sf_dir):
    return fixtures.table(spark, sf_dir, "documents").select(F.md5(F.col("text").cast("binary")).alias("hash"), "lang").distinct()


@query("dedupe_by_hash_keep_first", "SELECT doc_id, hash FROM (SELECT doc_id, md5(text) AS hash, row_number() OVER (PARTITION BY md5(text) ORDER BY doc_id) AS rn FROM documents) WHERE rn = 1")
def _(spark, sf_dir):
    hashed = fixtures.table(spark, sf_dir, "documents").select("doc_id", F.md5(F.col("text").cast("binary")).alias("hash"))
    return incremental.keep_first(hashed, "hash", ["doc_id"])


@query("content_md5", "SELECT 'd' || CAST(doc_id AS VARCHAR) AS item, md5(text) AS hash FROM documents UNION ALL SELECT 'p' || CAST(page_id AS VARCHAR), md5(html) FROM pages")
def _(spark, sf_dir):
    each = lambda t, p, i, c: fixtures.table(spark, sf_dir, t).select(F.concat(F.lit(p), F.col(i).cast("string")).alias("item"), F.md5(F.col(c).cast("binary")).alias("hash"))
    return each("documents", "d", "doc_id", "text").unionByName(each("pages", "p", "page_id", "html"))


@query("new_samples_anti_join", "SELECT audio_md5_hash FROM v_audio_to_dataset d WHERE NOT EXISTS (SELECT 1 FROM v_audio_metrics m WHERE m.audio_md5_hash = d.audio_md5_hash)")
def _(spark, sf_dir):
    t = fixtures.tables(spark, sf_dir)
    return incremental.new_rows(t["audio_to_dataset"].select("audio_md5_hash"), t["audio_metrics"], ["audio_md5_hash"])


@query("existing_samples_semi_join", "SELECT audio_md5_hash, speaker_id FROM v_audio_to_dataset WHERE audio_md5_hash IN (SELECT audio_md5_hash FROM v_audio_metrics)")
def _(spark, sf_dir):
    t = fixtures.tables(spark, sf_dir)
    return incremental.existing_rows(t["audio_to_dataset"].select("audio_md5_hash", "speaker_id"), t["audio_metrics"], ["audio_md5_hash"])


@query("upsert_metrics", """WITH n AS (SELECT md5(CAST(event_id AS VARCHAR)) AS audio_md5_hash, value * 2 AS duration_seconds FROM events WHERE event_id % 4 = 0)
SELECT audio_md5_hash, duration_seconds FROM v_audio_metrics WHERE audio_md5_hash NOT IN (SELECT audio_md5_hash FROM n) UNION ALL SELECT * FROM n""")
def _(spark, sf_dir):
    new = fixtures.table(spark, sf_dir, "events").where("event_id % 4 = 0").select(F.md5(F.col("event_id").cast("string").cast("binary")).alias("audio_md5_hash"), (F.col("value") * 2).alias("duration_seconds"))
    return incremental.upsert(fixtures.tables(spark, sf_dir)["audio_metrics"].select("audio_md5_hash", "duration_seconds"), new, ["audio_md5_hash"])


@query("dataset_scoped_new_members", "SELECT audio_md5_hash FROM v_audio_to_dataset WHERE id % 2 = 0 AND audio_md5_hash NOT IN (SELECT audio_md5_hash FROM v_audio_to_dataset WHERE dataset_name = 'ds_main')")
def _(spark, sf_dir):
    clips = fixtures.tables(spark, sf_dir)["audio_to_dataset"]
    return incremental.new_rows(clips.where("id % 2 = 0").select("audio_md5_hash"), clips.where(F.col("dataset_name") == MAIN), ["audio_md5_hash"])


_PAIRS = "SELECT o.audio_md5_hash, o.text AS r, a.text AS h FROM v_audio_to_original_text o JOIN v_audio_to_asr_text a ON o.audio_md5_hash = a.audio_md5_hash"


@query("text_pairs_intersect", "SELECT audio_md5_hash FROM v_audio_to_original_text INTERSECT SELECT audio_md5_hash FROM v_audio_to_asr_text")
def _(spark, sf_dir):
    t = fixtures.tables(spark, sf_dir)
    return t["audio_to_original_text"].select("audio_md5_hash").intersect(t["audio_to_asr_text"].select("audio_md5_hash"))


@query("pairs_to_add_except", f"SELECT audio_md5_hash FROM ({_PAIRS}) EXCEPT SELECT md5(CAST(doc_id AS VARCHAR)) FROM documents WHERE doc_id % 5 = 0")
def _(spark, sf_dir):
    t = fixtures.tables(spark, sf_dir)
    done = fixtures.table(spark, sf_dir, "documents").where("doc_id % 5 = 0").select(F.md5(F.col("doc_id").cast("string").cast("binary")).alias("audio_md5_hash"))
    return incremental.new_rows(t["audio_to_original_text"].select("audio_md5_hash").join(t["audio_to_asr_text"], "audio_md5_hash", "left_semi"), done, ["audio_md5_hash"])


@query("text_coverage_report", f"""WITH a AS (SELECT DISTINCT audio_md5_hash FROM v_audio_to_dataset WHERE dataset_name = 'ds_main'), p AS (SELECT audio_md5_hash FROM ({_PAIRS})),
f AS (SELECT a.audio_md5_hash IN (SELECT audio_md5_hash FROM p) AS b, a.audio_md5_hash IN (SELECT md5(CAST(doc_id AS VARCHAR)) FROM documents WHERE doc_id % 5 = 0) AS d FROM a)
SELECT count(*) AS total, count(*) FILTER (b) AS pairs, count(*) FILTER (b) * 100e0 / count(*) AS percentage, count(*) FILTER (b AND NOT d) AS to_add, count(*) FILTER (b AND d) AS to_update FROM f""")
def _(spark, sf_dir):
    t = fixtures.tables(spark, sf_dir)
    done = fixtures.table(spark, sf_dir, "documents").where("doc_id % 5 = 0").select(F.md5(F.col("doc_id").cast("string").cast("binary")).alias("audio_md5_hash"))
    return incremental.coverage(t["audio_to_dataset"].where(F.col("dataset_name") == MAIN), t["audio_to_original_text"], t["audio_to_asr_text"], done)


# Text metrics.
for _name, _t in (("cps_original", "audio_to_original_text"), ("cps_asr", "audio_to_asr_text")):

    @query(_name, f"SELECT x.audio_md5_hash, length(x.text) / nullif(m.duration_seconds, 0) AS cps FROM v_{_t} x LEFT JOIN v_audio_metrics m ON m.audio_md5_hash = x.audio_md5_hash")
    def _(spark, sf_dir, name=_t):
        t = fixtures.tables(spark, sf_dir)
        return t[name].join(t["audio_metrics"], "audio_md5_hash", "left").select("audio_md5_hash", text_metrics.cps(F.col("text"), F.col("duration_seconds")).alias("cps"))


def _pairs(t):
    return t["audio_to_original_text"].select("audio_md5_hash", F.col("text").alias("r")).join(t["audio_to_asr_text"].select("audio_md5_hash", F.col("text").alias("h")), "audio_md5_hash")


@query("wer_pairs")
def _(spark, sf_dir):
    return _pairs(fixtures.tables(spark, sf_dir)).select("audio_md5_hash", text_metrics.wer(F.col("r"), F.col("h")).alias("WER")).where("WER IS NOT NULL")


@query("cer_pairs")
def _(spark, sf_dir):
    return _pairs(fixtures.tables(spark, sf_dir)).select("audio_md5_hash", text_metrics.cer(F.col("r"), F.col("h")).alias("CER"))


@query("wer_cer_incremental")
def _(spark, sf_dir):
    done = fixtures.table(spark, sf_dir, "documents").where("doc_id % 5 = 0").select(F.md5(F.col("doc_id").cast("string").cast("binary")).alias("audio_md5_hash"))
    pairs = incremental.new_rows(_pairs(fixtures.tables(spark, sf_dir)), done, ["audio_md5_hash"])
    return pairs.select("audio_md5_hash", text_metrics.wer(F.col("r"), F.col("h")).alias("WER"), text_metrics.cer(F.col("r"), F.col("h")).alias("CER"))


@query("duration_map_lookup", "SELECT d.id, m.duration_seconds FROM v_audio_to_dataset d LEFT JOIN v_audio_metrics m ON m.audio_md5_hash = d.audio_md5_hash")
def _(spark, sf_dir):
    t = fixtures.tables(spark, sf_dir)
    return t["audio_to_dataset"].join(t["audio_metrics"], "audio_md5_hash", "left").select("id", "duration_seconds")


@query("normalize_text_alphabet", """SELECT doc_id, regexp_replace(translate(regexp_replace(text, '<[^>]*>', '', 'g'), '!?;:', '..,,'), '[^a-zA-Z0-9 .,''`]', '', 'g') AS text FROM documents""")
def _(spark, sf_dir):
    return fixtures.table(spark, sf_dir, "documents").select("doc_id", strings.normalize_alphabet(F.col("text")).alias("text"))


# Signals.
def _pcm(spark, sf_dir):
    return fixtures.table(spark, sf_dir, "embeddings")


_LIST = "list_transform(embedding, lambda x: CAST(x AS DOUBLE))"


@query("snr_per_clip", f"SELECT vec_id, round(list_avg({_LIST}) / list_stddev_pop({_LIST}), 4) + 0e0 AS snr FROM embeddings")
def _(spark, sf_dir):
    return _pcm(spark, sf_dir).select("vec_id", (F.round(signal.snr(F.col("embedding")), 4) + F.lit(0.0)).alias("snr"))


@query("snr_zero_std", "SELECT vec_id, 0e0 AS snr FROM embeddings")
def _(spark, sf_dir):
    return _pcm(spark, sf_dir).select("vec_id", signal.snr(F.transform("embedding", lambda x: F.lit(0.5))).alias("snr"))


@query("dbfs_per_clip", f"SELECT vec_id, round(20 * log10(sqrt(list_sum(list_transform({_LIST}, lambda x: x * x)) / len(embedding))), 4) AS dbfs FROM embeddings")
def _(spark, sf_dir):
    return _pcm(spark, sf_dir).select("vec_id", F.round(signal.dbfs(F.col("embedding")), 4).alias("dbfs"))


@query("deinterleave_channel0", "SELECT vec_id, CAST(unnest(range(0, 32)) AS INT) AS i, unnest(list_filter(embedding, lambda x, i: (i - 1) % 2 = 0)) AS x FROM embeddings")
def _(spark, sf_dir):
    return _pcm(spark, sf_dir).select("vec_id", F.posexplode(signal.channel(F.col("embedding"), 2)).alias("i", "x"))


@query("downmix_mono", "SELECT vec_id, CAST(unnest(range(0, 32)) AS INT) AS i, unnest(list_transform(range(1, 33), lambda j: (CAST(embedding[2 * j - 1] AS DOUBLE) + CAST(embedding[2 * j] AS DOUBLE)) / 2)) AS x FROM embeddings")
def _(spark, sf_dir):
    return _pcm(spark, sf_dir).select("vec_id", F.posexplode(signal.downmix(F.col("embedding"), 2)).alias("i", "x"))


_CHUNKS = "SELECT vec_id, CAST(c AS INT) AS c, CAST(j AS INT) AS j, coalesce(embedding[c * 12 + j + 1], CAST(0 AS FLOAT)) AS x FROM embeddings, range(0, 6) a(c), range(0, 16) b(j)"


def _framed(spark, sf_dir):
    return _pcm(spark, sf_dir).select("vec_id", F.posexplode(signal.chunks(F.col("embedding"), 16, 4)).alias("c", "chunk"))


@query("chunk_frames", _CHUNKS)
def _(spark, sf_dir):
    return _framed(spark, sf_dir).select("vec_id", "c", F.posexplode("chunk").alias("j", "x"))


@query("chunk_zero_pad", f"SELECT vec_id, c, CAST(count(*) FILTER (x = 0) AS INT) AS zeros, CAST(count(*) AS INT) AS n FROM ({_CHUNKS}) GROUP BY vec_id, c")
def _(spark, sf_dir):
    return _framed(spark, sf_dir).select("vec_id", "c", F.size(F.filter("chunk", lambda x: x == 0)).alias("zeros"), F.size("chunk").alias("n"))


@query("peak_normalize_chunks", f"SELECT vec_id, c, j, round(CAST(x AS DOUBLE) / CASE WHEN p = 0 THEN 10e-7 ELSE p END, 6) AS x FROM (SELECT *, max(abs(CAST(x AS DOUBLE))) OVER (PARTITION BY vec_id, c) AS p FROM ({_CHUNKS}))")
def _(spark, sf_dir):
    return _framed(spark, sf_dir).select("vec_id", "c", F.posexplode(F.transform(signal.peak_normalize(F.col("chunk")), lambda x: F.round(x, 6))).alias("j", "x"))


@query("crossfade_overlap_add", "SELECT vec_id, CAST(unnest(range(0, 64)) AS INT) AS pos, round(unnest(list_transform(embedding, lambda x: CAST(x AS DOUBLE))), 6) AS value FROM embeddings")
def _(spark, sf_dir):
    rows = _pcm(spark, sf_dir).select("vec_id", F.size("embedding").alias("n"), F.posexplode(signal.chunks(F.col("embedding"), 16, 4)).alias("i", "chunk"))
    return signal.overlap_add(rows, "vec_id", 16, 4).select("vec_id", "pos", F.round("value", 6).alias("value"))


# Alignments.
@query("intervals_to_json", """SELECT conv_id, turn, CAST(j - 1 AS INT) AS i, x.text AS text, x.min_time AS min_time, x.max_time AS max_time, x.duration AS duration
  FROM (SELECT conv_id, turn, unnest(range(1, len(intervals) + 1)) AS j, unnest(intervals) AS x FROM v_word_intervals)""")
def _(spark, sf_dir):
    read = F.from_json(alignment.to_json(F.col("intervals")), "array<struct<text:string,min_time:double,max_time:double,duration:double>>")
    return fixtures.word_intervals(spark, sf_dir).select("conv_id", "turn", F.posexplode(read).alias("i", "x")).select("conv_id", "turn", "i", "x.*")


_PAUSED = """SELECT conv_id, turn, replace(replace(regexp_replace(regexp_replace(regexp_replace(array_to_string(list_transform(intervals, lambda x, j:
  CASE WHEN x.text <> '' THEN x.text || ' ' WHEN j = 1 THEN '' WHEN x.duration > 3e-1 THEN '. ' WHEN x.duration > 15e-2 THEN ', ' ELSE '' END), ''), '^\\s+|\\s+$', '', 'g') || '.',
  '[,.]{2,}', '.', 'g'), '\\s{2,}', ' ', 'g'), ' .', '.'), ' ,', ',') AS text FROM v_word_intervals"""


@query("pause_punctuation", _PAUSED)
def _(spark, sf_dir):
    return fixtures.word_intervals(spark, sf_dir).select("conv_id", "turn", alignment.punctuate(F.col("intervals")).alias("text"))


@query("pause_counts", "SELECT conv_id, turn, CAST(len(list_filter(intervals, lambda x: x.text = '' AND x.duration > 3e-1)) AS INT) AS periods, CAST(len(list_filter(intervals, lambda x: x.text = '' AND x.duration > 15e-2 AND x.duration <= 3e-1)) AS INT) AS commas FROM v_word_intervals")
def _(spark, sf_dir):
    silent = lambda lo, hi: F.size(F.filter("intervals", lambda x: (x["text"] == "") & (x["duration"] > lo) & (x["duration"] <= hi)))
    return fixtures.word_intervals(spark, sf_dir).select("conv_id", "turn", silent(0.3, float("inf")).alias("periods"), silent(0.15, 0.3).alias("commas"))


# Layouts.
_DEFAULT_LAYOUT = """SELECT doc_id, CASE WHEN n IS NULL THEN 'wavs/' || file ELSE array_to_string(list_concat(list_concat(['speaker_' || CAST(n AS VARCHAR), 'wavs'], dirs[2:]), [file]), '/') END AS path_to_wav,
  CAST(coalesce(n, -1) AS INT) AS speaker_id FROM v_laid_out"""


@query("layout_default", _DEFAULT_LAYOUT)
def _(spark, sf_dir):
    return layout.layout(fixtures.audio_files(spark, sf_dir), "/raw").drop("absolute_path")


@query("layout_single_speaker", "SELECT doc_id, array_to_string(list_concat(list_concat(['speaker_0', 'wavs'], dirs), [file]), '/') AS path_to_wav, CAST(0 AS INT) AS speaker_id FROM v_laid_out")
def _(spark, sf_dir):
    return layout.layout(fixtures.audio_files(spark, sf_dir), "/raw", single_speaker=True).drop("absolute_path")


@query("layout_unknown_speaker", "SELECT doc_id, array_to_string(list_concat(list_concat(['wavs'], dirs), [file]), '/') AS path_to_wav, CAST(-1 AS INT) AS speaker_id FROM v_laid_out")
def _(spark, sf_dir):
    return layout.layout(fixtures.audio_files(spark, sf_dir), "/raw", unknown_speaker=True).drop("absolute_path")


@query("layout_collisions", f"SELECT path_to_wav, count(*) AS n FROM ({_DEFAULT_LAYOUT}) GROUP BY path_to_wav HAVING count(*) > 1")
def _(spark, sf_dir):
    return layout.collisions(layout.layout(fixtures.audio_files(spark, sf_dir), "/raw"))


_EMOTION = """SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN 'bea' WHEN 1 THEN 'jenie' WHEN 2 THEN 'josh' WHEN 3 THEN 'sam' ELSE 'ann' END AS who, 'Anger' AS mood, doc_id % 400 AS n FROM documents"""


@query("emov_path_parse", f"""SELECT doc_id, who AS speaker, CAST(CASE who WHEN 'bea' THEN 1 WHEN 'jenie' THEN 2 WHEN 'josh' THEN 3 WHEN 'sam' THEN 4 END AS INT) AS speaker_id, 'anger' AS emotion, CAST(n AS INT) AS audio_id,
  CASE WHEN who <> 'ann' THEN 'speaker_' || CASE who WHEN 'bea' THEN '1' WHEN 'jenie' THEN '2' WHEN 'josh' THEN '3' WHEN 'sam' THEN '4' END || '/wavs/anger_' || CAST(n AS VARCHAR) || '.wav' END AS path_to_wav FROM ({_EMOTION}) WHERE who <> 'ann'""")
def _(spark, sf_dir):
    d = F.col("doc_id")
    who = F.when(d % 5 == 0, "bea").when(d % 5 == 1, "jenie").when(d % 5 == 2, "josh").when(d % 5 == 3, "sam").otherwise("ann")
    path = F.concat(F.lit("/data/"), who, F.lit("_Anger/anger_1-28_"), F.lpad((d % 400).cast("string"), 4, "0"), F.lit(".wav"))
    rows = fixtures.table(spark, sf_dir, "documents").select("doc_id", path.alias("path"))
    return rows.select("doc_id", *(c.alias(n) for n, c in layout.emotion_path(F.col("path")).items())).where("speaker_id IS NOT NULL")


@query("cmuarctic_parse", """SELECT CAST(a AS INT) AS audio_id, t AS text FROM (SELECT doc_id % 300 AS a, 'text ' || CAST(doc_id AS VARCHAR) AS t, row_number() OVER (PARTITION BY doc_id % 300 ORDER BY doc_id DESC) AS rn FROM documents WHERE doc_id % 4 <> 0) WHERE rn = 1""")
def _(spark, sf_dir):
    d = F.col("doc_id")
    kind = F.when(d % 4 == 0, "b").otherwise("a")
    line = F.concat(F.lit("( arctic_"), kind, F.lpad((d % 300).cast("string"), 4, "0"), F.lit(' "text '), d.cast("string"), F.lit('" )'))
    return texts.parse_prompts(fixtures.table(spark, sf_dir, "documents").select("doc_id", line.alias("value")), order="doc_id")


@query("mls_path_parse", "SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN 'train' WHEN 1 THEN 'dev' ELSE 'test' END AS split, source AS speaker, CAST(doc_id % 9 AS VARCHAR) AS book, source || '_' || CAST(doc_id AS VARCHAR) AS file_name FROM documents")
def _(spark, sf_dir):
    d = F.col("doc_id")
    split = F.when(d % 3 == 0, "train").when(d % 3 == 1, "dev").otherwise("test")
    path = F.concat(F.lit("/mls/"), split, F.lit("/audio/"), F.col("source"), F.lit("/"), (d % 9).cast("string"), F.lit("/"), F.col("source"), F.lit("_"), d.cast("string"), F.lit(".opus"))
    rows = fixtures.table(spark, sf_dir, "documents").select("doc_id", "source", path.alias("path"))
    return rows.select("doc_id", *(c.alias(n) for n, c in layout.audiobook_path(F.col("path")).items()))


@query("transcripts_priority_merge", """SELECT name, text FROM (SELECT 'n' || CAST(doc_id % 200 AS VARCHAR) AS name, 't' || CAST(doc_id AS VARCHAR) AS text,
  row_number() OVER (PARTITION BY doc_id % 200 ORDER BY doc_id % 3 DESC, 't' || CAST(doc_id AS VARCHAR) DESC) AS rn FROM documents) WHERE rn = 1""")
def _(spark, sf_dir):
    d = F.col("doc_id")
    line = F.concat(F.lit("n"), (d % 200).cast("string"), F.lit("\t'\" t"), d.cast("string"), F.lit("\" "))
    return texts.merge_transcripts(fixtures.table(spark, sf_dir, "documents").select(line.alias("value"), (d % 3).alias("priority")))


# Lookups of whole texts, splits and pieces.
@query("text_lookup_left", "SELECT e.event_id, md5(d.text) AS text_md5 FROM events e LEFT JOIN documents d ON d.doc_id = e.event_id")
def _(spark, sf_dir):
    clips, known = fixtures.table(spark, sf_dir, "events").select("event_id"), fixtures.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("event_id"), "text")
    return lookups.lookup(clips, known, "event_id").select("event_id", F.md5("text").alias("text_md5"))


@query("text_lookup_strict", "SELECT d.doc_id, md5(d.text) AS text_md5, e.user_id FROM documents d JOIN events e ON e.event_id = d.doc_id")
def _(spark, sf_dir):
    docs, users = fixtures.table(spark, sf_dir, "documents"), fixtures.table(spark, sf_dir, "events").select(F.col("event_id").alias("doc_id"), "user_id")
    return lookups.lookup_strict(docs.select("doc_id", F.md5("text").alias("text_md5")), users, "doc_id", "user_id")


@query("text_lookup_fill", "SELECT e.event_id, md5(CASE WHEN e.event_id % 3 = 0 THEN e.event_type ELSE d.text END) AS text_md5 FROM events e LEFT JOIN documents d ON d.doc_id = e.event_id")
def _(spark, sf_dir):
    own = F.when(F.col("event_id") % 3 == 0, F.col("event_type"))
    clips, known = fixtures.table(spark, sf_dir, "events").select("event_id", own.alias("text")), fixtures.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("event_id"), "text")
    return lookups.fill(clips, known, "event_id").select("event_id", F.md5("text").alias("text_md5"))


@query("mls_target_path", """SELECT doc_id, concat('speaker_', CAST(doc_id % 7 AS VARCHAR), '/wavs/', CASE doc_id % 3 WHEN 0 THEN 'train' WHEN 1 THEN 'dev' ELSE 'test' END,
  '/', CAST(doc_id % 9 AS VARCHAR), '/', source, '_', CAST(doc_id AS VARCHAR), '.wav') AS path_to_wav FROM documents""")
def _(spark, sf_dir):
    d = F.col("doc_id")
    split = F.when(d % 3 == 0, "train").when(d % 3 == 1, "dev").otherwise("test")
    path = F.concat(F.lit("/mls/"), split, F.lit("/audio/"), F.col("source"), F.lit("/"), (d % 9).cast("string"), F.lit("/"), F.col("source"), F.lit("_"), d.cast("string"), F.lit(".opus"))
    parts = layout.audiobook_path(F.col("path"))
    target = layout.audiobook_target(d % 7, layout.checked_split(parts["split"]), parts["book"], parts["file_name"])
    return fixtures.table(spark, sf_dir, "documents").select("doc_id", path.alias("path")).select("doc_id", target.alias("path_to_wav"))


@query("split_long_audio", f"""SELECT vec_id, i, CAST(len(x) AS INT) AS n, round(list_sum(x), 5) AS total, round(x[1], 6) AS first, round(x[len(x)], 6) AS last FROM (
  SELECT vec_id, i, {_LIST}[i * 24 + 1 : i * 24 + 24] AS x FROM (SELECT vec_id, embedding, CAST(unnest(range(0, CAST(ceil(len(embedding) / 24.0) AS BIGINT))) AS INT) AS i FROM embeddings))""")
def _(spark, sf_dir):
    x = F.transform("piece", lambda v: v.cast("double"))
    cut = _pcm(spark, sf_dir).select("vec_id", F.posexplode(signal.pieces(F.col("embedding"), 24)).alias("i", "piece")).withColumn("x", x)
    total = F.aggregate("x", F.lit(0.0), lambda a, v: a + v)
    return cut.select("vec_id", "i", F.size("x").alias("n"), F.round(total, 5).alias("total"), F.round(F.element_at("x", 1), 6).alias("first"), F.round(F.element_at("x", -1), 6).alias("last"))


# Models and signal processing that SQL can't say.
@query("asr_fake_model_batches")
def _(spark, sf_dir):
    return models.processed(models.run_model(_pcm(spark, sf_dir), "vec_id", "embedding", models.fake_recognizer, "recognized_text", "string"), "recognized_text")


@query("enhance_identity_model", "SELECT vec_id, CAST(unnest(range(0, 64)) AS INT) AS pos, round(unnest(list_transform(embedding, lambda x: CAST(x AS DOUBLE))), 6) AS value FROM embeddings")
def _(spark, sf_dir):
    framed = _pcm(spark, sf_dir).select("vec_id", F.size("embedding").alias("n"), F.posexplode(signal.chunks(F.col("embedding"), 16, 4)).alias("i", "chunk"))
    keyed = framed.withColumn("key", F.concat_ws("/", "vec_id", "n", "i"))
    done = models.run_model(keyed, "key", "chunk", models.identity_enhancer, "enhanced", "array<double>", 32)
    part = F.split("key", "/")
    back = done.select(part[0].cast("int").alias("vec_id"), part[1].cast("int").alias("n"), part[2].cast("int").alias("i"), F.col("enhanced").alias("chunk"))
    return signal.overlap_add(back, "vec_id", 16, 4).select(F.col("vec_id").cast("long").alias("vec_id"), "pos", F.round("value", 6).alias("value"))


@query("resample_linear_phase")
def _(spark, sf_dir):
    return signal.resample(_pcm(spark, sf_dir), "vec_id", "embedding", 16, 44)


@query("mel_offset_alignment")
def _(spark, sf_dir):
    def run(frames):
        import numpy as np
        import pandas as pd

        for frame in frames:
            out = []
            for k, x in zip(frame["vec_id"], frame["embedding"], strict=True):
                wave = np.tile(np.asarray(x, float), 8)
                out.append((k, signal.mel_offset(wave, np.roll(wave, 20), 1000, 12)))
            yield pd.DataFrame(out, columns=["vec_id", "offset"])

    return _pcm(spark, sf_dir).select("vec_id", "embedding").mapInPandas(run, "vec_id long, offset long")


@query("wav_binary_scan")
def _(spark, sf_dir):
    from .sources import audio

    rows = _pcm(spark, sf_dir).select(F.concat(F.lit("clip_"), F.col("vec_id").cast("string"), F.lit(".wav")).alias("path"), "embedding")

    def run(frames):
        import numpy as np
        import pandas as pd

        for frame in frames:
            yield pd.DataFrame({"path": frame["path"], "content": [audio.wav_bytes(np.asarray(x), 16000) for x in frame["embedding"]]})

    files = rows.mapInPandas(run, "path string, content binary")
    return audio.decode(files).join(audio.checksums(files), "path")
