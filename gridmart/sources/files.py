"""Choosing raw inputs by file name."""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def list_inputs(spark: SparkSession, folder: str, name_pattern: str) -> DataFrame:
    """Paths below ``folder`` with a component that matches ``name_pattern``, cut after it.

    An input may be one file or a folder of part files. Only names are read: the content
    column of the listing is pruned away.
    """
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    named = F.regexp_extract("path", f"^(.*/{name_pattern})(/.*)?$", 1)
    return listing.select(named.alias("path")).where("path <> ''").distinct()


def _chosen(spark: SparkSession, folder: str, name_pattern: str, choice: Column) -> str:
    try:
        path = list_inputs(spark, folder, name_pattern).agg(choice).first()[0]
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        path = None
    if path is None:
        raise FileNotFoundError(f"No input under {folder!r} named like {name_pattern!r}")
    return path


def latest_input(spark: SparkSession, folder: str, prefix: str) -> str:
    """The newest version: names carry the date, so the greatest path is the latest."""
    return _chosen(spark, folder, re.escape(prefix) + "[^/]*", F.max("path"))


def named_input(spark: SparkSession, folder: str, name: str) -> str:
    return _chosen(spark, folder, re.escape(name), F.min("path"))
