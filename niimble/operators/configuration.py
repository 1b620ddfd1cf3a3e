"""Run-scoped and versioned configuration."""

from __future__ import annotations

import secrets
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, fields
from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from niimble.operators.lookups import attach, latest, range_lookup
from niimble.sources.schemas import check_columns

SCOPE = ("business_unit", "product", "currency")
VERSION = ("config_key", "config_version")


@dataclass(frozen=True)
class ConfigSnapshot:
    """The configuration of one run; every table carries the run id."""

    run_id: str
    run_scope: DataFrame
    yield_index_mapping: DataFrame
    launchpoint_windows: DataFrame
    proxy_source_mappings: DataFrame
    inflation_adjustments: DataFrame
    custom_yield_overrides: DataFrame
    forecast_substitution_rules: DataFrame
    launchpoint_period_yield_overrides: DataFrame


def new_run_id(prefix: str = "run") -> str:
    return f"{prefix}_{secrets.token_hex(4)}"


def tag_run(table: DataFrame, run_id: str) -> DataFrame:
    """The table under this run id, as its first column. Grain: unchanged."""
    return table.select(F.lit(run_id).alias("run_id"), *[c for c in table.columns if c != "run_id"])


def take_snapshot(tables: Mapping[str, DataFrame], run_id: str) -> ConfigSnapshot:
    """Bind the eight configuration tables to one run; each must fit its schema."""
    names = [f.name for f in fields(ConfigSnapshot) if f.name != "run_id"]
    missing = [n for n in names if n not in tables]
    if missing:
        raise ValueError(f"configuration tables missing: {missing}")
    return ConfigSnapshot(run_id, **{n: check_columns(tag_run(tables[n], run_id), n) for n in names})


def with_run_metadata(rows: DataFrame, execution_id: str, run_timestamp: datetime) -> DataFrame:
    """Execution id and time on every row. Grain: unchanged."""
    return rows.withColumns({
        "execution_id": F.lit(execution_id),
        "run_timestamp": F.lit(run_timestamp),
    })


@dataclass(frozen=True)
class RunIdentity:
    """What a run was: its execution, and names for the content of its configuration and chosen versions."""

    execution_id: str
    run_timestamp: datetime
    config_snapshot_id: str
    active_config_version: str


def with_run_identity(rows: DataFrame, identity: RunIdentity, output_table: str) -> DataFrame:
    """The five system parameters on every row. Grain: unchanged."""
    return with_run_metadata(rows, identity.execution_id, identity.run_timestamp).withColumns({
        "config_snapshot_id": F.lit(identity.config_snapshot_id),
        "active_config_version": F.lit(identity.active_config_version),
        "output_table": F.lit(output_table),
    })


def content_ids(tables: Mapping[str, DataFrame], leave_out: Sequence[str] = ("run_id",)) -> DataFrame:
    """A name for the content of each table, and its row count. Columns table_name, row_count, content_id.

    Equal for equal rows in any order and under any partitioning; repeated rows count. A row is hashed as the
    text of its cells by column name, NULL apart from any text, and the hashes are added in four parts of 60
    bits. Columns of ``leave_out`` are not looked at. Each table is one partial aggregate, whatever its size.
    """
    def summed(name: str, table: DataFrame) -> DataFrame:
        cells = []
        for c in sorted(c for c in table.columns if c not in leave_out):
            text = F.col(c).cast("string")
            told = F.concat(F.length(text).cast("string"), F.lit(":"), text, F.lit(";"))
            cells += [F.lit(c), F.coalesce(told, F.lit("~;"))]
        row = table.select(F.sha2(F.concat(*cells).cast("binary"), 256).alias("h"))
        parts = [F.conv(F.substring("h", 1 + 15 * i, 15), 16, 10).cast("decimal(19,0)") for i in range(4)]
        sums = [F.coalesce(F.sum(p), F.lit(0)).cast("string") for p in parts]
        return row.agg(F.count(F.lit(1)).alias("row_count"), F.concat_ws(":", *sums).alias("sums")).select(
            F.lit(name).alias("table_name"), "row_count", "sums"
        )

    found = reduce(DataFrame.unionByName, [summed(n, t) for n, t in sorted(tables.items())])
    told = F.concat_ws(":", "table_name", F.col("row_count").cast("string"), "sums")
    return found.select("table_name", "row_count", F.sha2(told.cast("binary"), 256).alias("content_id"))


def snapshot_ids(config: ConfigSnapshot, versions: DataFrame, requested: DataFrame) -> DataFrame:
    """``config_snapshot_id`` and ``active_config_version``, one row.

    The second names the set of chosen versions (``chosen_versions``), the first that set and the eight
    configuration tables. Run ids do not enter: runs of equal configuration have equal names.
    """
    tables = {f.name: getattr(config, f.name) for f in fields(ConfigSnapshot) if f.name != "run_id"}
    chosen = "active_config_versions"
    ids = content_ids({**tables, chosen: chosen_versions(versions, requested)})
    # one row per table
    listed = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("table_name", "content_id"))), lambda t: t["content_id"]), ":")
    return ids.agg(
        F.sha2(listed.cast("binary"), 256).alias("config_snapshot_id"),
        F.max(F.when(F.col("table_name") == chosen, F.col("content_id"))).alias("active_config_version"),
    )


def identify_run(
    config: ConfigSnapshot, versions: DataFrame, requested: DataFrame, execution_id: str, run_timestamp: datetime
) -> RunIdentity:
    """The identity of a run; reads the configuration, and brings two short texts to the driver."""
    ids = snapshot_ids(config, versions, requested).collect()[0]
    return RunIdentity(execution_id, run_timestamp, ids["config_snapshot_id"], ids["active_config_version"])


def config_row(store: DataFrame, key: str, version: str | None) -> DataFrame:
    """The parameter row of one key and version; no row for an unknown or missing version.

    The key is unique by contract; of several rows the one effective last is taken.
    """
    wanted = (F.col("config_key") == F.lit(key)) & (F.col("config_version") == F.lit(version))
    return latest(store.where(wanted), VERSION, ["effective_date"])


def active_versions(versions: DataFrame) -> DataFrame:
    """The active version per key, the one activated last of several. Grain: key."""
    flagged = versions.where(F.col("active_flag")).select(*VERSION, "activated_at")
    return latest(flagged, ["config_key"], ["activated_at"]).select(*VERSION)


def chosen_versions(versions: DataFrame, requested: DataFrame) -> DataFrame:
    """The requested version per key, else the active one. Grain: key.

    ``requested`` has one (config_key, config_version) row per key it names.
    """
    asked = requested.select("config_key", F.col("config_version").alias("_asked"))
    return active_versions(versions).join(asked, ["config_key"], "full").select(
        "config_key", F.coalesce("_asked", "config_version").alias("config_version")
    )


def resolve_versions(store: DataFrame, versions: DataFrame, requested: DataFrame) -> DataFrame:
    """Parameter rows of the versions chosen by ``chosen_versions``. Grain: store row."""
    return store.join(chosen_versions(versions, requested), list(VERSION), "left_semi")


def effective_on(store: DataFrame, day: date) -> DataFrame:
    """Rows with effective_date <= day < expiry_date, open without expiry. Grain: store row."""
    started = F.col("effective_date") <= F.lit(day)
    return store.where(started & (F.col("expiry_date").isNull() | (F.col("expiry_date") > F.lit(day))))


def effective_lookup(
    facts: DataFrame, store: DataFrame, at: str, take: Sequence[str], step: str = "year", salts: int = 1
) -> DataFrame:
    """Parameters in force on each row's own date, per config_key. Grain: facts x rows in force.

    A key has few versions, so they are listed per year.
    """
    return range_lookup(
        facts, store, ["config_key"], at, "effective_date", "expiry_date", take,
        end_included=False, step=step, salts=salts,
    )


def describe_config(store: DataFrame, catalog: DataFrame, salts: int = 1) -> DataFrame:
    """Parameter rows with category and description of their key. Grain: store row."""
    about = catalog.select(
        "config_key", "config_category", F.col("description").alias("config_description"), "example_usage"
    )
    return attach(store, about, ["config_key"], salts=salts)


def scope_filter(
    facts: DataFrame, scope: DataFrame, columns: Sequence[str] = SCOPE, salts: int = 1
) -> DataFrame:
    """Rows that some scope row admits; a NULL scope column admits any value. Grain: facts.

    The patterns of filled columns that occur in the scope are read first, in one small aggregate; there
    is one equality lookup per pattern, on just its columns. Rows of one pattern that agree on its
    columns are equal as a whole, so after ``distinct`` no lookup repeats a fact. A scope row without
    any filled column admits all facts, an empty scope none.
    """
    admitted = scope.select(*columns).distinct()
    filled = F.array_compact(F.array(*[F.when(F.col(c).isNotNull(), F.lit(c)) for c in columns]))
    patterns = sorted((r[0] for r in admitted.select(filled.alias("filled")).distinct().collect()), key=lambda p: (-len(p), p))
    if [] in patterns:
        return facts
    if not patterns:
        return facts.limit(0)
    rows, hits = facts, []
    for pattern in patterns:
        hit = "_admitted_by_" + "_".join(pattern)
        tests = [F.col(c).isNotNull() if c in pattern else F.col(c).isNull() for c in columns]
        found = admitted.where(_all(tests)).select(*pattern, F.lit(True).alias(hit))
        rows = attach(rows, found, pattern, salts=salts)
        hits.append(F.col(hit).isNotNull())
    return rows.where(reduce(lambda a, b: a | b, hits)).select(*facts.columns)


def _all(tests: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a & b, tests)
