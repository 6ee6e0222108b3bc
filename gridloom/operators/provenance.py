"""Where an archive's names, units and claims come from: the nomenclature key, an audit's log, files, the code's revision."""

from __future__ import annotations

import subprocess

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..config import ArchiveConfig
from ..functions.naming import unit_note
from ..sources.key import key_table

VARIABLE_COLUMNS = ["original_variable_name", "canonical_name", "canonical_units", "canonical_long_name", "unit_conversion"]
FREQUENCY_COLUMNS = ["original_frequency_name", "canonical_name", "canonical_long_name"]


def nomenclature(spark: SparkSession, config: ArchiveConfig, original_units: str) -> dict[str, str]:
    """Attributes that the key gives a variable and a frequency. What the source calls and measures it in is read off
    the source, so the record of the original cannot be wrong where the key's column is."""
    named = key_table(spark, config.key, VARIABLE_COLUMNS).where(F.col("original_variable_name") == config.variable).first()
    often = key_table(spark, config.key, FREQUENCY_COLUMNS).where(F.col("original_frequency_name") == config.resolution).first()
    if named is None or often is None:
        raise ValueError(f"the key has no {config.variable!r}" if named is None else f"the key has no {config.resolution!r}")
    units = F.lit(original_units)
    note = spark.range(1).select(unit_note(F.lit(named["unit_conversion"]), units, F.lit(named["canonical_units"]))).first()[0]
    return {
        "variable_name": named["canonical_name"], "units": named["canonical_units"], "long_name": named["canonical_long_name"],
        "original_variable_name": config.variable, "original_units": original_units, "unit_conversion": note,
        "temporal_frequency": often["canonical_name"], "temporal_frequency_long_name": often["canonical_long_name"],
        "original_temporal_frequency": config.resolution,
    }


def log_runs(spark: SparkSession, path: str) -> DataFrame:
    """(run, phases, n_checks, n_failures, verified) of an audit's text log. A run begins with the line of its phases."""
    lines = spark.read.text(path, wholetext=True).select(F.posexplode(F.split("value", "\r?\n")).alias("at", "line"))
    phases = F.regexp_extract("line", r"phases: \[(.*)\]", 1)
    run = F.sum((F.col("line").rlike(r"phases: \[")).cast("int")).over(Window.orderBy("at"))  # one log, read line by line
    totals = r"(\d+) checks, (\d+) failures"
    return lines.withColumn("run", run).where("run > 0").groupBy("run").agg(
        F.split(F.regexp_replace(F.max(phases), r"[\s']", ""), ",").alias("phases"),
        F.max(F.when(F.col("line").rlike(totals), F.regexp_extract("line", totals, 1).cast("long"))).alias("n_checks"),
        F.max(F.when(F.col("line").rlike(totals), F.regexp_extract("line", totals, 2).cast("long"))).alias("n_failures"),
        F.bool_or(F.col("line").contains("store verified")).alias("verified"),
    )


def log_evidence(spark: SparkSession, path: str, phases: list[str]):
    """The last run of all ``phases`` without a failure that ends well; refused if there is none."""
    whole = F.size(F.array_except(F.array(*map(F.lit, phases)), F.col("phases"))) == 0
    found = log_runs(spark, path).where(whole & (F.col("n_failures") == 0) & F.col("verified")).orderBy(F.desc("run")).first()
    if found is None:
        raise PermissionError(f"{path} has no complete run without failures")
    return found


def object_counts(spark: SparkSession, path: str) -> DataFrame:
    """(folder, n_files, n_bytes) of what lies under ``path``; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "length")
    folder = F.regexp_extract("path", r"^(.*)/[^/]*$", 1)
    return files.groupBy(folder.alias("folder")).agg(F.count("*").alias("n_files"), F.sum("length").alias("n_bytes"))


def code_revision(root: str) -> str:
    """The short commit of the code, ``-dirty`` with changes, ``unknown`` without a repository."""
    git = lambda *a: subprocess.run(["git", "-C", root, *a], capture_output=True, text=True)
    head = git("rev-parse", "--short", "HEAD")
    if head.returncode:
        return "unknown"
    return head.stdout.strip() + ("-dirty" if git("status", "--porcelain").stdout.strip() else "")
