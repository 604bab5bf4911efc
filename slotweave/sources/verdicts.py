"""Reviewers' verdicts: JSON documents with decisions and series."""

from __future__ import annotations

import json
import subprocess
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DECISION = "action string, factor double, SITE_SK int, DIRECTION_SK int, start string, end string, confidence string, diagnosis string, evidence string, rejected boolean, rejection string"
PART = "COUNTER_SK int, DIRECTION_SK int, start string, end string"
SERIES = f"SITE_SK int, name string, confidence string, evidence string, rejected boolean, parts array<struct<{', '.join(f.replace(' ', ': ', 1) for f in PART.split(', '))}>>"


def _struct(ddl: str) -> str:
    # only the outermost commas separate fields
    out, depth, field = [], 0, ""
    for ch in ddl + ",":
        depth += (ch == "<") - (ch == ">")
        if ch == "," and depth == 0:
            out.append(field.strip().replace(" ", ": ", 1))
            field = ""
        else:
            field += ch
    return "struct<" + ", ".join(out) + ">"


SCHEMA = f"group string, decisions array<{_struct(DECISION)}>, series array<{_struct(SERIES)}>, proposals array<string>, summary string"


def read_verdicts(spark: SparkSession, path: str) -> DataFrame:
    """A row for each document of a path or pattern."""
    return spark.read.schema(SCHEMA).option("multiLine", True).json(path)


def from_dicts(spark: SparkSession, verdicts: list[dict]) -> DataFrame:
    """Verdicts that are at hand, as ``read_verdicts`` gives them."""
    return spark.createDataFrame([(json.dumps(v),) for v in verdicts], "v string").select(F.from_json("v", SCHEMA).alias("v")).select("v.*")


def at_revision(root: str, path: str, revision: str | None = None) -> dict:
    """A verdict as it is in the working tree, or was at a revision of the repository; a revision that ends in .json is the
    place of another file."""
    if revision is None or revision.endswith(".json"):
        return json.loads(Path(root, revision or path).read_text())
    shown = subprocess.run(["git", "-C", root, "show", f"{revision}:{path}"], capture_output=True, text=True, check=True)
    return json.loads(shown.stdout)


def decisions(verdicts: DataFrame, rejected: bool = False) -> DataFrame:
    """A row for each decision; rejected ones only if asked for."""
    d = verdicts.select("group", F.explode("decisions").alias("d")).select("group", "d.*")
    return d if rejected else d.where(~F.coalesce(F.col("rejected"), F.lit(False)))


def series_table(verdicts: DataFrame) -> DataFrame:
    """A row for each part of each series that is not rejected, with dates."""
    s = verdicts.select(F.explode("series").alias("s")).where(~F.coalesce(F.col("s.rejected"), F.lit(False)))
    p = s.select("s.SITE_SK", F.col("s.name").alias("series"), F.explode("s.parts").alias("p"))
    key = lambda c: F.col(c).cast("smallint")
    return p.select(key("SITE_SK").alias("SITE_SK"), "series", key("p.COUNTER_SK").alias("COUNTER_SK"), key("p.DIRECTION_SK").alias("DIRECTION_SK"), F.col("p.start").cast("date").alias("start"), F.col("p.end").cast("date").alias("end"))
