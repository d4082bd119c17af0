"""Reading access-log text from files, directories and globs."""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Names that Spark's listing passes over, as globs.
HIDDEN = "{_*,.*,*._COPYING_}"
SHOWN = ("_metadata", "_common_metadata")


@dataclass(frozen=True)
class Inputs:
    """What the arguments stand for: ``patterns`` for Spark's reader, and each root with its argument's position."""

    patterns: list[str]
    roots: list[tuple[str, int]]


def _is_hidden(name: str) -> bool:
    shown = name.startswith(SHOWN) or (name.startswith("_") and "=" in name)
    return not shown and (name.startswith(("_", ".")) or name.endswith("._COPYING_"))


def _literal(path: str) -> str:
    """A path as a glob that matches it alone."""
    return re.sub(r"([\\\[\]{}*?])", r"\\\1", path)


class _Listing:
    """Hadoop's view of the paths, through the session's configuration; it asks for names, never for contents."""

    def __init__(self, spark: SparkSession):
        self.path = spark._jvm.org.apache.hadoop.fs.Path
        self.configuration = spark._jsparkSession.sessionState().newHadoopConf()

    def system(self, path: str):
        return self.path(path).getFileSystem(self.configuration)

    def matches(self, pattern: str) -> list:
        return list(self.system(pattern).globStatus(self.path(pattern)) or [])

    def existing(self, path: str):
        """The status of a path that exists as it is spelled, or None."""
        system, own = self.system(path), self.path(path)
        return system.getFileStatus(own) if system.exists(own) else None

    def has_bytes(self, status) -> bool:
        if status.isDirectory():
            return self.system(status.getPath().toString()).getContentSummary(status.getPath()).getLength() > 0
        return status.getLen() > 0

    def hidden_below(self, folder: str) -> list:
        """Hidden files and folders at any depth of a folder."""
        found, level = [], _literal(folder.rstrip("/"))
        while True:
            found += self.matches(f"{level}/{HIDDEN}")
            level += "/*"
            # Only the number of entries of a level comes back, not the entries.
            entries = self.system(folder).globStatus(self.path(level))
            if not entries or len(entries) == 0:
                return found


def resolve_inputs(spark: SparkSession, inputs: str | Iterable[str]) -> Inputs:
    """Files, folders (with all below them) and globs, in the order of the arguments; those that match nothing are left out.

    A path that exists is meant as it is spelled, even if it looks like a glob. Spark never lists names that begin with
    ``_`` or ``.``, so hidden files with content are an error that names them: no line is passed over in silence. Empty ones, such as
    the markers that jobs leave in their folders, hold no lines.
    """
    listing, patterns, roots, hidden = _Listing(spark), [], [], []
    for position, argument in enumerate([inputs] if isinstance(inputs, str) else inputs):
        status = listing.existing(argument)
        found = [status] if status else listing.matches(argument)
        pattern = _literal(argument) if status else argument
        if not found:
            continue
        if pattern not in patterns:
            patterns.append(pattern)
        for each in found:
            root = each.getPath().toString()
            roots.append((root, position))
            if _is_hidden(each.getPath().getName()) and not (status and each.isDirectory()):
                hidden.append(each)
            elif each.isDirectory():
                hidden += [below for below in listing.hidden_below(root) if _is_hidden(below.getPath().getName())]
    missed = sorted({each.getPath().toString() for each in hidden if listing.has_bytes(each)})
    if missed:
        raise ValueError(f"hidden files are not read, rename them or leave them out: {missed[:20]}")
    return Inputs(patterns, roots)


def _load(spark: SparkSession, inputs: Inputs, source: str, wanted: object) -> DataFrame:
    """Opens all inputs in one listing."""
    if not inputs.patterns:
        raise FileNotFoundError(f"no log file matches {wanted}")
    # With recursive lookup Spark keys its listing by path, so a file reached
    # through several arguments (itself, its directory, a glob) is read once.
    return spark.read.format(source).option("recursiveFileLookup", "true").load(inputs.patterns)


def read_lines(spark: SparkSession, inputs: str | Iterable[str]) -> DataFrame:
    """One row per text line (``value``); blank lines count, bad UTF-8 is replaced."""
    wanted = inputs if isinstance(inputs, str) else list(inputs)
    found = resolve_inputs(spark, wanted)
    lines = _load(spark, found, "text", wanted)
    if _load(spark, found, "binaryFile", wanted).select("length").isEmpty():
        raise FileNotFoundError(f"no log file below {wanted}")
    return lines.select(F.make_valid_utf8("value").alias("value"))


def source_files(spark: SparkSession, inputs: str | Iterable[str]) -> DataFrame:
    """The files behind the inputs (``path``, ``bytes``, ``position``); their content is not read.

    ``position`` is the place, from 0, of the first argument that reaches a file. Files in order of it and their path are in the
    order in which they are named. A file finds its arguments among the folders above it, by a join.
    """
    wanted = inputs if isinstance(inputs, str) else list(inputs)
    found = resolve_inputs(spark, wanted)
    files = _load(spark, found, "binaryFile", wanted).select("path", F.col("length").alias("bytes"))
    roots = spark.createDataFrame(found.roots, "root string, position int").groupBy("root").agg(F.min("position").alias("position"))
    steps = F.split("path", "/")
    above = F.transform(F.sequence(F.lit(1), F.size(steps)), lambda n: F.array_join(F.slice(steps, F.lit(1), n), "/"))
    each = files.select("path", "bytes", F.explode(F.filter(above, lambda a: a != "")).alias("root"))
    # The file system's own root keeps its slash.
    roots = roots.withColumn("root", F.regexp_replace("root", "(?<=.)/$", ""))
    return each.join(roots, "root").groupBy("path", "bytes").agg(F.min("position").alias("position"))
