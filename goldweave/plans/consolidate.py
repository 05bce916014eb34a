"""The batch job: source tables in, profile and report tables out."""

from __future__ import annotations

from dataclasses import dataclass, field, fields, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import ATS, CODE_HOST, EXPERIENCE_TYPE, FACT_COLUMNS, FACT_SCHEMA, RECRUITER, RECRUITER_COLUMNS
from ..operators.profile import PROFILE_COLUMNS, profiles
from ..operators.project import accepted, lint, project, rejected
from ..functions import FIXED, Rules
from ..operators.ledger import ledger
from ..operators.membership import within, without
from ..operators.quarantine import broken_ids, isolate, quarantine
from ..operators.reports import Watch
from ..operators.skew import HOT_LIMIT, Split, split_hot, weigh
from ..operators.storage import new_folder
from ..operators.validate import ERRORS, fault_counts, validate_custom, validate_profiles
from ..sources import ats, code_host, recruiter
from ..sources.files import in_order
from ..sources.sinks import write_table
from ..sources.unpivot import as_facts


@dataclass
class Sources:
    """Source tables, each with candidate_id; any of them may be absent.

    Typed and JSON forms of a source may be given together; ``profile_json``
    and ``repos_json`` hold payloads of their own, as files give them.
    ``facts`` are tables in the fact schema, the entry for further kinds of
    sources. ``candidates`` lists ids that must get a profile even without any
    record. Tables read from files have a ``position``.
    """

    recruiter: DataFrame | None = None
    ats: DataFrame | None = None
    ats_json: DataFrame | None = None
    profiles: DataFrame | None = None
    repos: DataFrame | None = None
    code_host_json: DataFrame | None = None
    profile_json: DataFrame | None = None
    repos_json: DataFrame | None = None
    candidates: DataFrame | None = None
    facts: list[DataFrame] = field(default_factory=list)


TAGS = {"recruiter": RECRUITER, "ats": ATS, "profiles": CODE_HOST, "repos": CODE_HOST}
# place of further sources in the order of arrival
OTHER_SOURCES = 3
# sources that are parsed or read from files: written once, then used
PARSED = ("ats_json", "code_host_json", "profile_json", "repos_json")


@dataclass(frozen=True)
class Gathered:
    facts: DataFrame
    weights: DataFrame
    quarantine: DataFrame | None
    rules: Rules = FIXED

    def split(self, limit: int = HOT_LIMIT) -> Split:
        return split_hot(self.facts, limit, self.weights)

    def profiles(self, limit: int = HOT_LIMIT) -> DataFrame:
        """Merged profiles under the rules of the run."""
        return profiles(self.facts, limit, self.split(limit), self.rules).select(*PROFILE_COLUMNS)

    def ledger(self, limit: int = HOT_LIMIT) -> DataFrame:
        return ledger(self.facts, limit, self.split(limit), self.rules)


def markers(candidates: DataFrame) -> DataFrame:
    """Rows without a fact that keep a candidate on the list."""
    given = candidates.select(F.col("candidate_id").cast("string").alias("candidate_id"))
    types = dict(part.strip().split(" ", 1) for part in FACT_SCHEMA.replace(EXPERIENCE_TYPE, "EXP").split(", "))
    types["exp"] = EXPERIENCE_TYPE
    return given.select(
        "candidate_id", *[F.lit(None).cast(types[c]).alias(c) for c in FACT_COLUMNS[1:]]
    )


def has_id() -> Column:
    """An id that is neither null nor blank."""
    return F.coalesce(F.btrim(F.col("candidate_id").cast("string")) != "", F.lit(False))


def without_id(table: DataFrame, source: str) -> DataFrame:
    """Quarantine rows for the records of a source that have no id: one by one
    with their place in a file, or their number."""
    bad = table.filter(~has_id()).withColumns({
        "candidate_id": F.lit(None).cast("string"), "reason": F.lit("missing id")})
    if "line" in table.columns:
        return quarantine(bad, source)
    return bad.agg(F.count("*").alias("n_records")).filter("n_records > 0").select(
        F.lit(None).cast("string").alias("candidate_id"), F.lit(source).alias("source"),
        F.lit("missing id").alias("reason"), "n_records")


# texts that hold no object hold no id either
NO_OBJECT = ["malformed json", "not an object"]


def named(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Parsed records with an id, and all with their reason to be left out: an
    object without an id lacks that first of all."""
    reason = F.when(has_id() | F.col("reason").isin(NO_OBJECT), F.col("reason")).otherwise(F.lit("missing id"))
    return records.filter(has_id()), records.withColumns(
        {"candidate_id": F.when(has_id(), F.col("candidate_id")), "reason": reason})


def gather(
    sources: Sources, staging: str | None = None, rules: Rules = FIXED, watch: Watch | None = None
) -> Gathered:
    """Facts of all sources in their fixed order of arrival, with markers. The
    rules give priors and the order of sources; a watch counts what
    normalization drops.

    What has to be parsed or read from files is written once to the ``staging``
    folder, by default one in the shared folder, and read back from there: by
    the quarantine, the extraction and the count of a candidate's rows.
    """
    given = {f.name: getattr(sources, f.name) for f in fields(sources)}
    facts = given.pop("facts")
    tables = [t for t in (*given.values(), *facts) if t is not None]
    if not tables:
        raise ValueError("no source table given")
    root = staging

    def stage(table: DataFrame, name: str) -> DataFrame:
        nonlocal root
        root = root or new_folder(tables[0].sparkSession, "staging")
        folder = f"{root.rstrip('/')}/{name}"
        return in_order(table, folder) if "position" in table.columns else write_table(table, folder)

    if sources.recruiter is not None and "position" in sources.recruiter.columns:
        given["recruiter"] = stage(sources.recruiter, "recruiter")
    # rows without an id belong to nobody: they give no fact and no profile
    broken = [without_id(t, TAGS[n]) for n, t in given.items() if t is not None and n in TAGS]
    broken += [without_id(t, "facts") for t in facts]
    sources = Sources(facts=[t.filter(has_id()) for t in facts], **{
        n: t if t is None or n in PARSED else t.filter(has_id()) for n, t in given.items()})
    parts: list[DataFrame] = []
    sizes: list[tuple[DataFrame, int]] = []

    if sources.recruiter is not None:
        parts.append(recruiter.recruiter_facts(sources.recruiter, rules=rules, watch=watch))
        sizes.append((sources.recruiter, len(RECRUITER_COLUMNS) - 1))
    if sources.ats is not None:
        parts.append(ats.ats_facts(ats.pick_columns(sources.ats), rules=rules, watch=watch))
        sizes.append((sources.ats, 3))
    if sources.ats_json is not None:
        picked, judged = named(stage(ats.pick_json(sources.ats_json), "ats"))
        broken.append(quarantine(judged, ATS))
        parts.append(ats.ats_facts(isolate(picked), rules=rules, watch=watch))
        sizes.append((picked, 3))
    if sources.profiles is not None:
        parts.append(code_host.profile_facts(sources.profiles, rules=rules, watch=watch))
        sizes.append((sources.profiles, 3))
        if sources.repos is not None:
            parts.append(code_host.repo_facts(
                sources.repos, lambda rows: code_host.repos_with_profile(rows, sources.profiles),
                rules=rules, watch=watch))
            sizes.append((sources.repos, 1))
    if sources.code_host_json is not None:
        typed, repos = code_host.pick_json(sources.code_host_json)
        typed, judged = named(stage(typed, "code_host"))
        repos = stage(repos, "repositories").filter(has_id())
        broken.append(quarantine(judged, CODE_HOST))
        parts += host_facts(typed, repos, broken_ids(typed), rules, watch)
        sizes += [(typed, 3), (repos, 1)]
    if sources.profile_json is not None:
        typed, judged = named(stage(code_host.pick_profiles(sources.profile_json), "profiles"))
        broken.append(quarantine(judged, CODE_HOST))
        bad, repos = broken_ids(typed), None
        if sources.repos_json is not None:
            lists, judged = named(stage(code_host.pick_repos(sources.repos_json), "lists"))
            # a list is only read where there is a profile
            ruled, open_ = judged.filter(~F.col("gated") | ~has_id()), lists.filter("gated AND reason IS NOT NULL")
            open_ = within(open_, within(code_host.filled_profiles(typed), open_))
            broken += [quarantine(ruled, CODE_HOST), quarantine(open_, CODE_HOST)]
            repos = code_host.listed_repos(lists)
            bad = bad.unionByName(broken_ids(ruled.filter(has_id()))).unionByName(broken_ids(open_))
            sizes.append((repos, 1))
        parts += host_facts(typed, repos, bad, rules, watch)
        sizes.append((typed, 3))
    for table in sources.facts:
        parts.append(as_facts(table, rules, OTHER_SOURCES))
        sizes.append((table, 1))
    if sources.candidates is not None:
        parts.append(markers(sources.candidates))
        sizes.append((sources.candidates, 1))

    union = lambda tables: reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)
    return Gathered(union(parts), weigh(sizes), union(broken) if broken else None, rules)


def host_facts(
    profiles: DataFrame, repos: DataFrame | None, broken: DataFrame, rules: Rules, watch: Watch | None
) -> list[DataFrame]:
    """Facts of parsed profiles and repositories, without those of candidates
    who have a broken record."""
    out = [code_host.profile_facts(isolate(profiles, broken), rules=rules, watch=watch)]
    if repos is not None:
        out.append(code_host.repo_facts(
            repos, lambda rows: code_host.repos_with_profile(without(rows, broken), profiles),
            rules=rules, watch=watch))
    return out


def consolidated(sources: Sources, limit: int = HOT_LIMIT, rules: Rules = FIXED) -> DataFrame:
    """Default shape: thirteen columns, one row per candidate."""
    return gather(sources, rules=rules).profiles(limit)


@dataclass(frozen=True)
class Result:
    """Tables of one run. ``rejects`` holds candidates whose custom shape
    failed, ``errors`` the number of errors per validation rule, ``warnings``
    what a config asks for in vain."""

    output: DataFrame
    rejects: DataFrame | None
    errors: DataFrame
    quarantine: DataFrame | None
    warnings: tuple[str, ...] = ()


def shaped(table: DataFrame, config: dict | None = None, strict: bool = False) -> Result:
    """Profiles in the default shape, or in that of a config, with errors
    attached. An empty config means the default shape."""
    if not config:
        checked = validate_profiles(table)
        return Result(checked.drop("_faults"), None, fault_counts(checked), None)
    projected = project(table, config, strict)
    checked = validate_custom(accepted(projected), config)
    return Result(
        checked.drop("_faults"), rejected(projected), fault_counts(checked), None, tuple(lint(table, config)))


def run(
    sources: Sources, config: dict | None = None, strict: bool = False, limit: int = HOT_LIMIT, rules: Rules = FIXED
) -> Result:
    """The whole job as lazy tables; only parsed sources are written on the way."""
    gathered = gather(sources, rules=rules)
    result = shaped(gathered.profiles(limit), config, strict)
    return replace(result, quarantine=gathered.quarantine)


__all__ = ["ERRORS", "Gathered", "Result", "Sources", "consolidated", "gather", "markers", "run", "shaped"]
