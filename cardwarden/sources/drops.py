"""Listing of a drop folder and routing of its files to the three feeds."""

from __future__ import annotations

import re
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwarden.functions.parsing import file_day

# A file belongs to the first feed whose name it contains.
FEEDS = ("transactions", "passport_blacklist", "terminals")
# Fixed value: extension of a file that has been loaded and stays in its folder.
ARCHIVED = ".backup"


@dataclass(frozen=True)
class DroppedFile:
    """What tells one dropped file from another: its name, bytes and time of last change.

    A name alone does not: a corrected file may come under the name of one loaded before.
    """

    name: str
    length: int
    modified: int


def feed_of(name: Column) -> Column:
    """Feed of a file name, NULL for a file no feed wants."""
    return F.coalesce(*(F.when(F.contains(name, F.lit(feed)), F.lit(feed)) for feed in FEEDS))


def feed_in(name: str) -> str | None:
    """The same for one name on the driver."""
    return next((feed for feed in FEEDS if feed in name), None)


def day_in(name: str) -> date:
    """Day in the name of a file that has been loaded, and so has one."""
    return datetime.strptime(re.search(r"(\d{8})(?:\.[^.]+)+$", name)[1], "%d%m%Y").date()


def route(files: DataFrame, name: str = "file_name") -> DataFrame:
    return files.withColumn("feed", feed_of(F.col(name))).withColumn(
        "drop_day", file_day(F.col(name))
    )


def drop_files(spark: SparkSession, folder: str) -> DataFrame:
    """Files waiting in a folder: path, file_name, length, modified, feed, drop_day.

    Contents are not selected, so the binary source lists files without reading them.
    Archived files are left out by their extension.
    """
    listing = spark.read.format("binaryFile").load(folder).select(
        "path",
        F.element_at(F.split("path", "/"), -1).alias("file_name"),
        "length",
        F.unix_millis("modificationTime").alias("modified"),
    )
    return route(listing).where(
        F.col("feed").isNotNull() & ~F.endswith(F.col("file_name"), F.lit(ARCHIVED))
    )
