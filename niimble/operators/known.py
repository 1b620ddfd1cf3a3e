"""Configuration in two times: the day for which a parameter holds, and the day on which that was known.

The activation table is read as a history: from ``activated_at`` on, the version is active or, with a false
flag, no longer active. What was known on a day is what this history said up to that day.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from niimble.operators.configuration import VERSION
from niimble.operators.lookups import as_of_lookup, attach, latest, range_lookup


def known_versions(versions: DataFrame) -> DataFrame:
    """Which version of a key was active, and from which day on that was known. Grain: key x day of a change.

    ``versions``: config_key, config_version, active_flag, activated_at. Columns config_key, known_from,
    config_version: the one activated last of those active, NULL when none is. Versions activated on one
    day follow each other by name, so the highest wins; of several rows of a version on one day the last
    by time counts, and among those of one time a false flag. Rows without key, version or time are left out;
    a NULL flag is false.

    The history of a key is folded from first to last row as one array of a few configuration rows: a
    version that is taken back brings back the one before it, without versions meeting each other.
    """
    told = versions.where(
        F.col("config_key").isNotNull() & F.col("config_version").isNotNull() & F.col("activated_at").isNotNull()
    ).select(
        *VERSION, F.coalesce("active_flag", F.lit(False)).alias("on"), F.col("activated_at").cast("date").alias("day"),
        F.struct(F.col("activated_at").cast("timestamp_ntz"), ~F.coalesce("active_flag", F.lit(False))).alias("_order"),
    )
    daily = latest(told, [*VERSION, "day"], ["_order"]).drop("_order")
    history = daily.groupBy("config_key").agg(
        F.array_sort(F.collect_list(F.struct("day", "config_version", "on"))).alias("_events")
    )
    none = F.array().cast("array<string>")
    state = F.struct(none.alias("active"), F.array().cast("array<struct<day:date,config_version:string>>").alias("said"))

    def told_next(so_far, event):
        others = F.filter(so_far["active"], lambda v: v != event["config_version"])
        active = F.when(event["on"], F.array_append(others, event["config_version"])).otherwise(others)
        said = F.struct(event["day"].alias("day"), F.try_element_at(active, F.lit(-1)).alias("config_version"))
        return F.struct(active.alias("active"), F.array_append(so_far["said"], said).alias("said"))

    folded = history.select("config_key", F.aggregate("_events", state, told_next)["said"].alias("_said"))
    steps = folded.select("config_key", F.posexplode("_said").alias("_place", "_step")).select(
        "config_key", "_place", F.col("_step.day").alias("known_from"), F.col("_step.config_version").alias("config_version")
    )
    # of the steps of one day only the last was left standing
    return latest(steps, ["config_key", "known_from"], ["_place"]).select("config_key", "known_from", "config_version")


def config_as_known(
    facts: DataFrame,
    store: DataFrame,
    versions: DataFrame,
    at: str,
    known: str,
    take: Sequence[str],
    step: str = "year",
    salts: int = 1,
) -> DataFrame:
    """Parameters in force on the row's day ``at``, as far as the row's day ``known`` knew. Grain: facts x rows in force.

    The version is the one known to be active on ``known``; of its rows in ``store`` those count that have
    effective_date <= at < expiry_date. ``take`` may name config_version. NULL where nothing was active or
    in force, or a day is missing. The two lookups run on the distinct days asked for: one by the calendar
    step of the day of knowledge, one by version and the step of the day of effect, so a row meets neither
    all versions nor all rows of its key. Facts are joined once, by equality.
    """
    taken = [c for c in take if c != "config_version"]
    asked = facts.select("config_key", F.col(at).cast("date").alias("_at"), F.col(known).cast("date").alias("_known")).where(
        F.col("config_key").isNotNull() & F.col("_at").isNotNull() & F.col("_known").isNotNull()
    ).distinct()
    versioned = as_of_lookup(
        asked, known_versions(versions), ["config_key"], "_known", "known_from", ["config_version"], step=step
    ).where(F.col("config_version").isNotNull())
    found = range_lookup(
        versioned, store, list(VERSION), "_at", "effective_date", "expiry_date", taken,
        end_included=False, how="inner", step=step,
    )
    answers = found.select("config_key", "_at", "_known", *dict.fromkeys(take))
    dated = facts.withColumns({"_at": F.col(at).cast("date"), "_known": F.col(known).cast("date")})
    return attach(dated, answers, ["config_key", "_at", "_known"], salts=salts).select(*facts.columns, *dict.fromkeys(take))
