"""File listings and their check against expected counts."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywise.session import stored

_LISTING = "path string, file_name string, folder string, length bigint, is_folder boolean"
_ENTRIES_PER_BATCH = 50000


def _list_folders(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for folder in batch["folder"]:
            system, place = fs.FileSystem.from_uri(folder)
            entries = system.get_file_info(fs.FileSelector(place))
            for start in range(0, len(entries), _ENTRIES_PER_BATCH):
                part = entries[start:start + _ENTRIES_PER_BATCH]
                yield pd.DataFrame({
                    "path": [f"{folder.rstrip('/')}/{e.base_name}" for e in part],
                    "file_name": [e.base_name for e in part],
                    "folder": folder.rstrip("/"),
                    "length": [e.size or 0 for e in part],
                    "is_folder": [e.type == fs.FileType.Directory for e in part],
                })


def file_manifest(spark: SparkSession, root: str, empty_files: bool = True) -> DataFrame:
    """``path, file_name, folder, length`` of every file under ``root``; no content is read.

    Spark's own listing, used with ``empty_files=False``, silently leaves out
    empty and hidden files. The default lists folder by folder in tasks, one
    Spark job per level of the tree.
    """
    if not empty_files:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
        return files.select(
            "path", F.element_at(F.split("path", "/"), -1).alias("file_name"),
            F.regexp_replace("path", "/[^/]*$", "").alias("folder"), "length",
        )
    level = spark.createDataFrame([(root,)], "folder string")
    found = None
    while found is None or not level.isEmpty():
        listed = stored(level.mapInPandas(_list_folders, _LISTING), "listing")
        files = listed.where(~F.col("is_folder")).drop("is_folder")
        found = files if found is None else found.unionByName(files)
        level = listed.where("is_folder").select(F.col("path").alias("folder")).repartition("folder")
    return found


def manifest_check(manifest: DataFrame, expected: DataFrame) -> DataFrame:
    """Expected against found files per report.

    ``manifest`` holds ``report, folder, length``; ``expected`` holds ``report,
    expected_count``. Empty files are counted but do not fail the check.
    """
    found = manifest.groupBy("report").agg(
        F.count(F.lit(1)).alias("actual_files"),
        F.count_distinct("folder").alias("dirs"),
        F.count_if(F.col("length") == 0).alias("zero_byte_files"),
    )
    zero = F.lit(0).cast("bigint")
    return expected.join(found, "report", "left").select(
        "report",
        F.col("expected_count").cast("bigint").alias("expected"),
        *[F.coalesce(c, zero).alias(c) for c in ("actual_files", "dirs", "zero_byte_files")],
        (F.coalesce("actual_files", zero) == F.col("expected_count")).alias("ok"),
    )
