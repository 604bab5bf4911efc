"""The whole cleaning: published records to final direction-slots. Every key is local to a review group, so all groups
run at once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import must
from ..functions.lineage import cut
from ..settings import DEFAULT, FIXES, KEYS, Settings
from ..sources.files import read_slots, write_series, write_slots
from . import decisions as D
from .series import series_parts, weekly_series
from .slots import slot_table, with_hourly, with_workday


def slots_and_loads(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The slot table, written once, and each counter's latest load: what any set of decisions is applied to."""
    table = cut(slot_table(records, latest=True))
    return table.drop("latest"), table.groupBy("COUNTER_SK").agg(F.max("latest").alias("last_load"))


def final_slots(records: DataFrame, decisions: DataFrame, dates: DataFrame, settings: Settings = DEFAULT, prepared: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """Cleaned direction-slots of the days before each counter's latest load (later ones are not final yet).

    ``records`` are in local time and ``decisions`` as ``decision_table`` returns them. Records are read twice: for the
    slot table, which is written and from which all else starts, and for the values of slots with extra records.
    ``prepared`` is what ``slots_and_loads`` gave, where several sets of decisions are applied."""
    table, last = prepared or slots_and_loads(records)
    s = D.apply(table, decisions, records)
    s = s.join(last, "COUNTER_SK").where("date < last_load")
    s = with_hourly(with_workday(s, dates), settings)
    return s.select(*KEYS, "date", "time", "workday", "records", "raw", "count", "fix", "direction_unreliable", "hourly_binned")


def fix_counts(final: DataFrame) -> DataFrame:
    """(fix, slots): how many slots each action changed; null: unchanged."""
    known = F.col("fix").isNull() | F.col("fix").isin(*FIXES)
    return must(final, known, F.lit("unknown fix")).groupBy("fix").agg(F.count("*").alias("slots"))


def run(records: DataFrame, decisions: DataFrame, reviewed: DataFrame, dates: DataFrame, directions: DataFrame, counters: DataFrame, path: str, settings: Settings = DEFAULT) -> DataFrame:
    """Cleans everything and writes the final slots, the series and their weekly totals under ``path``; the numbers of
    slots that each action changed. The slots are written first, and the others start from what was written."""
    write_slots(final_slots(records, decisions, dates, settings), path)
    final = read_slots(records.sparkSession, path)
    parts = cut(series_parts(final, reviewed, directions, counters))
    write_series(parts, weekly_series(final, parts, settings), path)
    return fix_counts(final)
