"""Questions to the file system that holds a path, whichever it is."""

from __future__ import annotations

import re

from pyspark.sql import SparkSession


def literal_path(path: str) -> str:
    """A path whose own brackets and stars are not taken for a pattern."""
    return re.sub(r"([\\\[\]{}*?])", r"\\\1", path)


def plain_uri(path: str) -> str:
    """One spelling of a name, whatever the number of slashes; without scheme a local file."""
    return re.sub("^([a-z0-9]+):/+", r"\1:/", path if ":" in path else f"file:{path}")


def path_exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def holds_data(spark: SparkSession, folder: str) -> bool:
    """True if the folder has anything that Spark would read in it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(place):
        return False
    return any(not s.getPath().getName().startswith(("_", ".")) for s in system.listStatus(place))


def numbered_folders(spark: SparkSession, folder: str, name: str) -> list[int]:
    """The numbers n of the folders ``name=n`` within a folder, in order."""
    place = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(place):
        return []
    parts = (s.getPath().getName().split("=") for s in system.listStatus(place))
    return sorted(int(p[1]) for p in parts if len(p) == 2 and p[0] == name)


def sql_text(text: str) -> str:
    """A string literal."""
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"
