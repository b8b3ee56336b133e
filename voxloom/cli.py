"""Commands for the jobs: ``python -m voxloom.cli JOB --catalog ROOT --dataset ROOT ...``.

Roots are folders or URIs of any store that Spark reads. The catalogue's root may come from VOXLOOM_CATALOG.
"""

from __future__ import annotations

import argparse
import os

from pyspark.sql import DataFrame, SparkSession

from .operators.incremental import keep_first
from .plans import collect
from .plans.config import read_config
from .plans.filter_dataset import filter_dataset, with_text
from .schemas import TABLES
from .sources import audio, metadata
from .sources.catalog import Catalog
from .sources.naming import dataset_name


def job_filter(catalog: Catalog, options: argparse.Namespace) -> DataFrame:
    """Clips that pass a configuration, written as pipe-separated metadata."""
    tables = {t: catalog.read(t) for t in TABLES}
    config = read_config(options.path_to_config, options.config_name)
    found = with_text(filter_dataset(tables, options.name, config), options.include_text)
    metadata.write_metadata(found, options.save_path, options.single_file)
    return found


def job_metrics(catalog: Catalog, options: argparse.Namespace) -> DataFrame:
    """Metrics of a dataset's clips; its metadata with hashes goes to the save path, if one is given."""
    known = collect.collect_audio_metrics(catalog, options.dataset, options.name, options.overwrite)
    if options.save_path:
        metadata.write_metadata(known, options.save_path, options.single_file)
    return known


def job_texts(catalog: Catalog, options: argparse.Namespace) -> DataFrame:
    """Texts of a dataset's metadata, one for each hash."""
    spark = catalog.spark
    rows = metadata.read_metadata(spark, f"{options.dataset}/metadata.csv", required=("path_to_wav", "speaker_id", "text"))
    hashed = metadata.with_hash(rows, audio.find_audio(spark, options.dataset, ("wav",)), options.dataset)
    known = keep_first(hashed.where("hash IS NOT NULL AND text IS NOT NULL"), "hash", ["path_to_wav"])
    collect.collect_texts(catalog, known.select("hash", "text"), options.overwrite)
    return known


def job_error_rates(catalog: Catalog, options: argparse.Namespace) -> DataFrame:
    """Word and character error rates of all clips with both texts."""
    return collect.collect_error_rates(catalog, options.overwrite)


#: command -> (job, whether it reads a dataset's folder)
JOBS = {"filter": (job_filter, True), "audio-metrics": (job_metrics, True), "texts": (job_texts, True), "error-rates": (job_error_rates, False)}


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="voxloom", description=__doc__)
    commands = out.add_subparsers(dest="job", required=True)
    for name, (job, reads) in JOBS.items():
        p = commands.add_parser(name, help=job.__doc__)
        p.add_argument("--catalog", default=os.environ.get("VOXLOOM_CATALOG"), required="VOXLOOM_CATALOG" not in os.environ)
        if reads:
            p.add_argument("--dataset", required=True, help="folder with metadata.csv and the clips")
            p.add_argument("--name", help="name in the catalogue; that of the folder by default")
            p.add_argument("--save-path", default="filtered_metadata" if name == "filter" else None)
            p.add_argument("--single-file", action="store_true", help="one task writes one file")
        if name == "filter":
            p.add_argument("--path-to-config", required=True)
            p.add_argument("--config-name", default="default")
            p.add_argument("--include-text", action="store_true")
        else:
            p.add_argument("--overwrite", action="store_true")
    return out


def main(arguments: list[str] | None = None, spark: SparkSession | None = None) -> DataFrame:
    options = parser().parse_args(arguments)
    if JOBS[options.job][1] and options.name is None:
        options.name = dataset_name(options.dataset)
    spark = spark or SparkSession.builder.appName("voxloom").getOrCreate()
    return JOBS[options.job][0](Catalog(spark, options.catalog), options)


if __name__ == "__main__":
    main()
