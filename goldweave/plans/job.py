"""The job that writes everything: one merge, then reports from its table.

Every table is finished before the next one begins and is noted in a manifest.
A run that died is started again with the same sources and configs: it reads
what is finished and goes on with the first table that is not. At the end only
result tables are left.
"""

from __future__ import annotations

import hashlib
import json
import warnings
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import FIXED, Rules
from ..operators.ledger import unmerged
from ..operators.profile import PROFILE_COLUMNS, profiles
from ..operators.reports import REJECTS, Watch
from ..operators.skew import HOT_LIMIT, split_hot
from ..operators.storage import remove, scratch
from ..operators.validate import fault_counts, validate_profiles
from ..sources.sinks import write_documents, write_table
from .consolidate import Sources, gather, shaped

QUARANTINE = (
    "candidate_id string, source string, reason string, n_records bigint, file string, line bigint")


def provenance_table(table: DataFrame) -> DataFrame:
    """Decisions as rows, in order within a candidate."""
    return table.select("candidate_id", F.posexplode("provenance").alias("pos", "p")).select(
        "candidate_id", "pos", "p.*"
    )


def fingerprint(sources: Sources, configs: dict[str, dict], rules: Rules) -> str:
    """Of the source files, their schemas, the configs and the rules. Tables
    that are not read from files are told apart by their schema only."""
    def of(table: DataFrame) -> list:
        return [table.schema.json(), sorted(table.inputFiles())]

    tables = {n: of(t) for n, t in vars(sources).items() if isinstance(t, DataFrame)}
    said = [tables, [of(t) for t in sources.facts], configs, vars(rules)]
    return hashlib.sha256(json.dumps(said, sort_keys=True).encode()).hexdigest()


class Manifest:
    """Finished tables of a run, one JSON line each, added when a table is whole."""

    def __init__(self, spark: SparkSession, folder: str, run: str) -> None:
        self.spark, self.folder, self.run = spark, folder.rstrip("/"), run
        self.done: set[str] = set()
        try:
            notes = [json.loads(r.value) for r in spark.read.text(f"{self.folder}/_manifest").collect()]
        except Exception as problem:
            if "PATH_NOT_FOUND" not in str(problem):
                raise
            notes = []
        if any(n["run"] != run for n in notes):
            raise ValueError(f"{folder} holds tables of other sources, configs or rules")
        self.done = {n["table"] for n in notes}

    def at(self, name: str) -> str:
        return f"{self.folder}/{name}"

    def note(self, name: str) -> None:
        line = json.dumps({"table": name, "run": self.run})
        self.spark.createDataFrame([(line,)], "value string").coalesce(1).write.mode("append").text(
            f"{self.folder}/_manifest")
        self.done.add(name)

    def step(self, name: str, write: Callable[[str], object]) -> str:
        """Write a table unless it is finished; what a broken run left of it is
        overwritten."""
        if name not in self.done:
            write(self.at(name))
            self.note(name)
        return self.at(name)


def run_to_folder(
    sources: Sources, folder: str, configs: dict[str, dict] | None = None, limit: int = HOT_LIMIT, rules: Rules = FIXED
) -> dict[str, str]:
    """Write profiles, documents, provenance, validation, unmerged fields,
    rejected values, quarantine and any number of custom shapes with their
    errors. The sources are scanned once, for the facts; the merge runs once
    and every shape reads its table."""
    configs = configs or {}
    tables = [t for t in (*vars(sources).values(), *sources.facts) if isinstance(t, DataFrame)]
    if not tables:
        raise ValueError("no source table given")
    spark = tables[0].sparkSession
    with scratch(spark):
        return _write_all(spark, sources, folder, configs, limit, rules)


def _write_all(
    spark: SparkSession, sources: Sources, folder: str, configs: dict[str, dict], limit: int, rules: Rules
) -> dict[str, str]:
    manifest = Manifest(spark, folder, fingerprint(sources, configs, rules))
    staging = manifest.at("_staging")
    at: dict[str, str] = {}

    def step(name: str, write: Callable[[str], object]) -> None:
        at[name] = manifest.step(name, write)

    def over(table: DataFrame) -> Callable[[str], object]:
        return lambda place: write_table(table, place, "overwrite")

    if "_facts" not in manifest.done:
        # the counts of rejected values belong to the run that writes the facts,
        # so these three are done anew together
        remove(spark, staging)
        watch = Watch()
        gathered = gather(sources, staging, rules, watch)
        write_table(gathered.facts, manifest.at("_facts"), "overwrite")
        write_table(spark.createDataFrame(watch.report(), REJECTS).coalesce(1), manifest.at("rejects"), "overwrite")
        bad = spark.createDataFrame([], QUARANTINE)
        if gathered.quarantine is not None:
            bad = bad.unionByName(gathered.quarantine, allowMissingColumns=True)
        write_table(bad, manifest.at("quarantine"), "overwrite")
        manifest.note("_facts")
    at |= {n: manifest.at(n) for n in ("rejects", "quarantine")}
    if not {"unmerged", "profiles"} <= manifest.done:
        facts = spark.read.parquet(manifest.at("_facts"))
        # two narrow columns of the facts
        step("unmerged", over(unmerged(facts)))
        step("profiles", over(
            profiles(facts, limit, split_hot(facts, limit), rules).select(*PROFILE_COLUMNS)))
    at |= {n: manifest.at(n) for n in ("unmerged", "profiles")}
    table = spark.read.parquet(at["profiles"])
    checked = validate_profiles(table)
    step("documents", lambda place: write_documents(checked.drop("_faults"), place, "overwrite"))
    step("provenance", over(provenance_table(table)))
    step("validation", over(fault_counts(checked)))
    for name, config in configs.items():
        result = shaped(table, config)
        for warning in result.warnings:
            warnings.warn(f"shape {name}: {warning}", stacklevel=3)
        at[name] = manifest.step(f"shape_{name}", lambda place, r=result: write_documents(r.output, place, "overwrite"))
        at[name + "_errors"] = manifest.step(f"shape_{name}_errors", over(result.errors))
        if result.rejects is not None:
            at[name + "_rejects"] = manifest.step(f"shape_{name}_rejects", over(result.rejects))
    remove(spark, staging)
    remove(spark, manifest.at("_facts"))
    return at
