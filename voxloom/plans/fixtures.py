"""The clip catalogue's tables, played by the driver tables: Spark plans and the SQL that DuckDB runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import text_metrics
from ..schemas import UNKNOWN_SPEAKER


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _hash(column: str):
    return F.md5(F.col(column).cast("string").cast("binary"))


def tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Every catalogue table, lazily."""
    events, docs = table(spark, sf_dir, "events"), table(spark, sf_dir, "documents")
    e = F.col("event_id")
    timed = docs.join(events.select(e.alias("doc_id"), "value"), "doc_id")
    heard = F.replace(F.replace("text", F.lit(" the "), F.lit(" ")), F.lit("er"), F.lit("ar"))

    def texts(rows: DataFrame, text) -> DataFrame:
        return rows.select(_hash("doc_id").alias("audio_md5_hash"), text.alias("text"), text_metrics.cps(text, F.col("value")).alias("cps"))

    # Every document was recognised; those with labels have an original text.
    original, recognised = texts(timed.join(table(spark, sf_dir, "labels"), "doc_id", "left_semi"), F.col("text")), texts(timed, heard)
    pairs = original.select("audio_md5_hash", F.col("text").alias("r")).join(recognised.select("audio_md5_hash", F.col("text").alias("h")), "audio_md5_hash")
    return {
        "audio_to_dataset": events.select(
            e.alias("id"), _hash("event_id").alias("audio_md5_hash"), F.when(e % 10 < 7, "ds_main").otherwise("ds_aux").alias("dataset_name"),
            F.concat(F.lit("speaker_"), F.col("user_id").cast("string"), F.lit("/wavs/"), e.cast("string"), F.lit(".wav")).alias("path_to_file"),
            F.when(F.col("user_id") % 25 == 0, UNKNOWN_SPEAKER).otherwise(F.col("user_id")).cast("int").alias("speaker_id"),
        ),
        "audio_metrics": events.where("event_id % 13 <> 0").select(
            _hash("event_id").alias("audio_md5_hash"), F.col("value").alias("duration_seconds"),
            F.when(e % 3 == 0, 44100).when(e % 3 == 1, 22050).otherwise(16000).alias("sample_rate"), F.when(e % 5 == 0, 2).otherwise(1).alias("channels"),
            F.when(e % 11 == 0, "PCM_24").otherwise("PCM_16").alias("pcm_format"), ((e % 200).cast("double") / 10.0 - 5.0).alias("SNR"), (-(e % 600).cast("double") / 10.0).alias("dBFS"),
        ),
        "audio_to_original_text": original,
        "audio_to_asr_text": recognised,
        "text_comparation_metrics": pairs.select("audio_md5_hash", text_metrics.wer(F.col("r"), F.col("h")).alias("WER"), text_metrics.cer(F.col("r"), F.col("h")).alias("CER")).where("WER IS NOT NULL"),
    }


def audio_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.col("doc_id")
    path = F.concat(
        F.lit("/raw/"), F.when(d % 4 == 0, "").otherwise(F.concat("source", F.lit("/"))), F.when(d % 6 == 1, F.concat("lang", F.lit("/"))).otherwise(""),
        F.lit("f"), (d % 37).cast("string"), F.when(d % 3 == 0, ".mp3").when(d % 3 == 1, ".wav").otherwise(".flac"),
    )
    return table(spark, sf_dir, "documents").select("doc_id", path.alias("absolute_path"))


def word_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """conv_id, turn, intervals."""
    turn = F.col("turn")

    def interval(w, i):
        length = ((i * 7 + turn * 3) % 10).cast("double") * 0.04
        return F.struct(F.when((i + turn) % 4 == 3, "").otherwise(F.lower(w)).alias("text"), (i.cast("double") * 0.25).alias("min_time"), (i.cast("double") * 0.25 + length).alias("max_time"), length.alias("duration"))

    words = F.split("text", " ")
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", F.transform(words, interval).alias("intervals"))


#: name -> (SQL, views that it reads)
VIEWS: dict[str, tuple[str, tuple[str, ...]]] = {
    "v_audio_to_dataset": ("""SELECT event_id AS id, md5(CAST(event_id AS VARCHAR)) AS audio_md5_hash, CASE WHEN event_id % 10 < 7 THEN 'ds_main' ELSE 'ds_aux' END AS dataset_name,
        concat('speaker_', CAST(user_id AS VARCHAR), '/wavs/', CAST(event_id AS VARCHAR), '.wav') AS path_to_file,
        CAST(CASE WHEN user_id % 25 = 0 THEN -1 ELSE user_id END AS INT) AS speaker_id FROM events""", ()),
    "v_audio_metrics": ("""SELECT md5(CAST(event_id AS VARCHAR)) AS audio_md5_hash, value AS duration_seconds,
        CAST(CASE event_id % 3 WHEN 0 THEN 44100 WHEN 1 THEN 22050 ELSE 16000 END AS INT) AS sample_rate, CAST(CASE WHEN event_id % 5 = 0 THEN 2 ELSE 1 END AS INT) AS channels,
        CASE WHEN event_id % 11 = 0 THEN 'PCM_24' ELSE 'PCM_16' END AS pcm_format, CAST(event_id % 200 AS DOUBLE) / 1e1 - 5e0 AS SNR,
        -CAST(event_id % 600 AS DOUBLE) / 1e1 AS dBFS FROM events WHERE event_id % 13 <> 0""", ()),
    "v_audio_to_original_text": ("""SELECT md5(CAST(d.doc_id AS VARCHAR)) AS audio_md5_hash, d.text, length(d.text) / e.value AS cps
        FROM documents d JOIN events e ON e.event_id = d.doc_id WHERE d.doc_id IN (SELECT doc_id FROM labels)""", ()),
    "v_audio_to_asr_text": ("""SELECT audio_md5_hash, text, length(text) / value AS cps FROM (SELECT md5(CAST(d.doc_id AS VARCHAR)) AS audio_md5_hash,
        replace(replace(d.text, ' the ', ' '), 'er', 'ar') AS text, e.value FROM documents d JOIN events e ON e.event_id = d.doc_id)""", ()),
    "v_audio_files": ("""SELECT doc_id, concat('/raw/', CASE WHEN doc_id % 4 = 0 THEN '' ELSE concat(source, '/') END, CASE WHEN doc_id % 6 = 1 THEN concat(lang, '/') ELSE '' END,
        'f', CAST(doc_id % 37 AS VARCHAR), CASE doc_id % 3 WHEN 0 THEN '.mp3' WHEN 1 THEN '.wav' ELSE '.flac' END) AS absolute_path FROM documents""", ()),
    "v_word_intervals": ("""SELECT conv_id, turn, list_transform(w, lambda x, j: struct_pack(text := CASE WHEN (j - 1 + turn) % 4 = 3 THEN '' ELSE lower(x) END,
        min_time := CAST(j - 1 AS DOUBLE) * 25e-2, max_time := CAST(j - 1 AS DOUBLE) * 25e-2 + CAST(((j - 1) * 7 + turn * 3) % 10 AS DOUBLE) * 4e-2,
        duration := CAST(((j - 1) * 7 + turn * 3) % 10 AS DOUBLE) * 4e-2)) AS intervals
        FROM (SELECT conv_id, turn, string_split(text, ' ') AS w FROM conversations)""", ()),
    "v_laid_out": ("""SELECT f.doc_id, f.absolute_path, dirs, file, dirs[1] AS speaker, s.n AS n
        FROM (SELECT doc_id, absolute_path, list_filter(string_split(regexp_replace(substr(absolute_path, 6), '[^/]*$', ''), '/'), lambda x: x <> '') AS dirs,
                     regexp_replace(regexp_extract(absolute_path, '[^/]*$'), '\\.[^.]*$', '') || '.wav' AS file FROM v_audio_files) f
        LEFT JOIN (SELECT dir, row_number() OVER (ORDER BY dir) - 1 AS n FROM (SELECT DISTINCT split_part(absolute_path, '/', 3) AS dir FROM v_audio_files WHERE len(string_split(absolute_path, '/')) > 3)) s ON s.dir = dirs[1]""", ("v_audio_files",)),
}


def sql(query: str) -> str:
    """The query behind the definitions of the views that it names, directly or not."""
    need: list[str] = []

    def add(text: str) -> None:
        for v in VIEWS:
            if v in text and v not in need:
                add(VIEWS[v][0])
                if v not in need:
                    need.append(v)

    add(query)
    if not need:
        return query
    head = ",\n".join(f"{v} AS ({VIEWS[v][0]})" for v in need)
    stripped = query.lstrip()
    return f"WITH {head}, {stripped[5:]}" if stripped.upper().startswith("WITH ") else f"WITH {head}\n{query}"
