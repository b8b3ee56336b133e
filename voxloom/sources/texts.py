"""Text sources: prompts, transcripts, aligned intervals, recognised-text side files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Fixed pattern of a prompt line.
PROMPT = r"\( arctic_a([0-9]*?) \"(.*?)\" \)"
#: Later splits win.
SPLITS = ("dev", "test", "train")


def parse_prompts(lines: DataFrame, line: str = "value", order: str | None = None) -> DataFrame:
    """audio_id, text of ``a`` prompts; other lines are dropped, the last of equal ids wins."""
    number = F.regexp_extract(F.col(line), PROMPT, 1)
    rows = lines.select(number.try_cast("int").alias("audio_id"), F.regexp_extract(F.col(line), PROMPT, 2).alias("text"), (F.col(order) if order else F.monotonically_increasing_id()).alias("_n"))
    last = F.row_number().over(W.partitionBy("audio_id").orderBy(F.desc("_n")))
    return rows.where("audio_id IS NOT NULL").withColumn("_rn", last).where("_rn = 1").select("audio_id", "text")


def read_prompts(spark: SparkSession, path: str) -> DataFrame:
    return parse_prompts(spark.read.text(path))


def merge_transcripts(lines: DataFrame, line: str = "value", priority: str = "priority") -> DataFrame:
    """name, text of ``name<tab>text`` lines; the highest priority wins, then the greatest text; a line without exactly one tab raises."""
    parts = F.split(F.col(line), "\t")
    checked = F.when(F.size(parts) == 2, F.col(line)).otherwise(F.raise_error(F.concat(F.lit("not one tab in: "), F.col(line))))
    parts = F.split(checked, "\t")
    rows = lines.select(parts[0].alias("name"), F.btrim(parts[1], F.lit("\n'\" ")).alias("text"), F.col(priority).alias("_p"))
    best = F.row_number().over(W.partitionBy("name").orderBy(F.desc("_p"), F.desc("text")))
    return rows.withColumn("_rn", best).where("_rn = 1").select("name", "text")


def read_transcripts(spark: SparkSession, root: str) -> DataFrame:
    """transcripts.txt of all splits under root."""
    parts = [spark.read.text(f"{root}/{split}/transcripts.txt").withColumn("priority", F.lit(i)) for i, split in enumerate(SPLITS)]
    return merge_transcripts(parts[0].unionByName(parts[1]).unionByName(parts[2]))


def parse_textgrid(content: Column) -> Column:
    """Intervals of the first tier of a long-format TextGrid."""
    first = F.regexp_extract(content, r"(?s)item \[1\]:(.*?)(item \[2\]:|\z)", 1)
    pattern = r'(?s)xmin\s*=\s*([0-9.eE+-]+)\s*xmax\s*=\s*([0-9.eE+-]+)\s*text\s*=\s*"((?:[^"]|"")*)"'
    lows, highs, marks = (F.regexp_extract_all(first, F.lit(pattern), F.lit(i)) for i in (1, 2, 3))
    at = lambda x: F.struct(
        F.replace(x["marks"], F.lit('""'), F.lit('"')).alias("text"), x["lows"].cast("double").alias("min_time"), x["highs"].cast("double").alias("max_time"),
        (x["highs"].cast("double") - x["lows"].cast("double")).alias("duration"),
    )
    return F.when(F.size(lows) > 0, F.transform(F.arrays_zip(lows.alias("lows"), highs.alias("highs"), marks.alias("marks")), at))


def read_side_texts(spark: SparkSession, root: str, folder: str = "asr_recognized_texts") -> DataFrame:
    """path_to_wav, text of recognised-text files kept beside the clips."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.txt").load(root)
    back = F.regexp_replace(F.replace(F.col("path"), F.lit(f"/{folder}/"), F.lit("/wavs/")), r"\.txt$", ".wav")
    return files.where(F.col("path").contains(f"/{folder}/")).select(back.alias("path"), F.decode("content", "UTF-8").alias("text"))
