"""Sources by kind: each is a function from a session, its specification and a landing folder to a table."""

from __future__ import annotations

import importlib
import pkgutil
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Collector = Callable[[SparkSession, dict, str], DataFrame]
_COLLECTORS: dict[str, Collector] = {}


def collector(kind: str) -> Callable[[Collector], Collector]:
    """Registers a collector for a kind of source; a kind is registered once."""

    def keep(f: Collector) -> Collector:
        if kind in _COLLECTORS:
            raise ValueError(f"kind {kind} is registered already")
        _COLLECTORS[kind] = f
        return f

    return keep


def load_plugins(package: str) -> list[str]:
    """Imports all modules of a package, so that their collectors register; gives their names."""
    at = importlib.import_module(package)
    return [importlib.import_module(m.name).__name__ for m in pkgutil.iter_modules(at.__path__, f"{package}.")]


def collect(spark: SparkSession, spec: dict, folder: str, secrets: frozenset[str] = frozenset()) -> tuple[DataFrame | None, list[str]]:
    """The table of one source, and warnings. An optional source whose secret is not there gives no table and a
    warning; an unknown kind or a missing secret of another source is an error."""
    if spec.get("auth_env") and spec["auth_env"] not in secrets:
        if spec.get("is_optional"):
            return None, [f"{spec['source_key']}: {spec['auth_env']} is not set"]
        raise KeyError(f"{spec['source_key']} needs {spec['auth_env']}")
    if spec["kind"] not in _COLLECTORS:
        raise KeyError(f"no collector for kind {spec['kind']}")
    return _COLLECTORS[spec["kind"]](spark, spec, folder), []


def collect_all(spark: SparkSession, specs: list[dict], folder: str, secrets: frozenset[str] = frozenset()) -> tuple[DataFrame | None, list[dict]]:
    """The tables of all sources as one, with source_key, and a state for each source: ok, skipped (with warnings) or
    failed (with the error). One source's failure leaves the others as they are. Columns that a source lacks are null."""
    union, states = None, []
    for spec in specs:
        state = {"source_key": spec["source_key"], "state": "ok", "messages": []}
        try:
            table, state["messages"] = collect(spark, spec, folder, secrets)
            if table is None:
                state["state"] = "skipped"
            else:
                table = table.withColumn("source_key", F.lit(spec["source_key"]))
                union = table if union is None else union.unionByName(table, allowMissingColumns=True)
        except Exception as e:  # noqa: BLE001 - whatever a collector raises is that source's state
            state |= {"state": "failed", "messages": [str(e).split("\n")[0]]}
        states.append(state)
    return union, states


def source_states(states: list[dict], rows: DataFrame) -> DataFrame:
    """(source_key, state, messages, rows) from the states of a run and the rows that it collected."""
    flat = rows.sparkSession.createDataFrame([(s["source_key"], s["state"], "; ".join(s["messages"])) for s in states], "source_key string, state string, messages string")
    return flat.join(rows.groupBy("source_key").agg(F.count("*").alias("rows")), "source_key", "left").fillna(0, ["rows"])


def enabled_specs(specs: DataFrame, cadence: str | None = None) -> DataFrame:
    """Specifications that are enabled and, if given, of a cadence; both reach the scan as filters."""
    out = specs.where("enabled")
    return out.where(F.col("cadence") == cadence) if cadence else out


def sources_by_country(specs: DataFrame, countries: DataFrame) -> DataFrame:
    """One row for each source and country of it, with the country's columns; unknown countries are dropped."""
    each = specs.withColumn("country_code", F.explode("countries")).drop("countries")
    return each.join(countries, "country_code")
