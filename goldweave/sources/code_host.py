"""Code-host profiles and repository lists."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import (
    CODE_HOST,
    CODE_HOST_URL,
    FACT_COLUMNS,
    EXPERIENCE_TYPE,
    INFERRED_SKILL_DISCOUNT,
)
from ..functions import FIXED, Rules, clean_text, present, skill_name
from ..operators.reports import Watch, watched
from . import untyped
from .documents import OWN, RECORD, extras, with_document
from .files import in_order, read_lines
from .unpivot import Reading, facts_of

# repositories of one list that are told apart in arrival order
LONGEST_LIST = 1 << 20
# repositories follow the attributes of their profile in arrival order
FIRST_SKILL_EMIT = 3


def read_profile_lines(spark: SparkSession, paths: str | list[str], multi_line: bool = False) -> DataFrame:
    """Profile files as (payload, position), one object per line or per file."""
    lines = read_lines(spark, paths, multi_line)
    return lines.withColumn("spare_id", F.col("position.file")) if multi_line else lines


def read_repo_lists(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Files of lines {candidate_id, repos: [...]} as (payload, position)."""
    return read_lines(spark, paths)


def pick_profiles(table: DataFrame) -> DataFrame:
    """Attributes of profile payloads with the reason a record is unusable."""
    keys = ["login", "name", "bio"]
    own = F.array(*[F.lit(k) for k in OWN])
    read = with_document(table, keys).select(
        *RECORD, *extras(table), "text", F.col("document._broken").alias("broken"),
        # a profile is what stands beside the id
        (F.size(F.array_except(F.coalesce(F.json_object_keys("text"), F.array(F.lit("?"))), own)) > 0).alias("any_key"),
        *[untyped.usable_value(F.col(f"document.{k}")).alias(k) for k in keys],
        *[untyped.written_text(F.col(f"document.{k}")).alias(f"{k}_text") for k in keys],
    )
    checked = read.withColumns({
        "malformed": untyped.malformed(F.col("text"), F.col("broken")),
        "filled": untyped.usable(F.col("text")) & (~F.col("text").startswith("{") | F.col("any_key")),
    })
    reason = (
        F.when(F.col("malformed"), "malformed json")
        .when(F.col("filled") & ~F.col("text").startswith("{"), "not an object")
        .when(~F.col("name")["text"], "name is not a text")
        .when(~F.col("bio")["text"], "bio is not a text")
    )
    return untyped.computed_once(checked.select(
        *RECORD,
        # any usable login is written into the link, a number too
        F.coalesce("login_text", F.col("login")["chars"]).alias("login"),
        F.col("name_text").alias("name"), F.col("bio_text").alias("bio"),
        "filled", reason.alias("reason"), *extras(table)))


def pick_repos(table: DataFrame) -> DataFrame:
    """Repository lists of payloads {candidate_id, repos}: `items`, name and
    language each null unless a text, the reason a list is unusable, and
    `gated`, whether the reason only counts for candidates with a profile, as
    nobody else's list is read. Types are asked of every element before anything
    is cast."""
    read = with_document(table, ["repos"]).select(
        *RECORD, *extras(table), "text", F.col("document._broken").alias("broken"),
        untyped.usable_value(F.col("document.repos")).isNotNull().alias("given"),
        F.schema_of_variant("document.repos").startswith("ARRAY").alias("a_list"),
        F.try_variant_get(F.col("document.repos"), "$", "array<variant>").alias("items"),
    )
    language = lambda v: untyped.attribute(v, "language")
    checked = read.withColumns({
        "malformed": untyped.malformed(F.col("text"), F.col("broken")),
        # of a null element the kind is null too
        "odd_item": F.exists("items", lambda v: ~F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False))),
        "odd_language": F.exists("items", lambda v: ~F.coalesce(language(v)["text"], F.lit(True))),
    })
    outer = F.when(F.col("malformed"), "malformed json").when(
        untyped.usable(F.col("text")) & ~F.col("text").startswith("{"), "not an object")
    inner = (
        F.when(F.col("given") & ~F.col("a_list"), "repositories are not a list")
        .when(F.col("given") & F.col("odd_item"), "repository is not an object")
        .when(F.col("given") & F.col("odd_language"), "language is not a text")
    )
    def text(value: Column, key: str) -> Column:
        found = untyped.attribute(value, key)
        return F.when(found["text"], found["chars"])

    items = F.transform("items", lambda v: F.struct(text(v, "name").alias("name"), text(v, "language").alias("language")))
    return untyped.computed_once(checked.select(
        *RECORD, F.when(outer.isNull() & inner.isNull(), items).alias("items"),
        F.coalesce(outer, inner).alias("reason"), (outer.isNull() & inner.isNotNull()).alias("gated"), *extras(table)))


def listed_repos(records: DataFrame) -> DataFrame:
    """One row per repository of numbered lists. Lists of one candidate follow
    each other, so a repository's place starts with its list's."""
    place = F.col("record_ord") * LONGEST_LIST + F.col("place")
    return records.select("candidate_id", "record_ord", F.posexplode("items").alias("place", "repo")).select(
        "candidate_id", place.cast("bigint").alias("repo_pos"), "repo.name", "repo.language")


def read_profiles(spark: SparkSession, paths: str | list[str], multi_line: bool = False) -> DataFrame:
    """The sound profiles of files as a typed table. Broken ones are left out
    here; give the payloads to a run to have them in its quarantine."""
    rows = in_order(pick_profiles(read_profile_lines(spark, paths, multi_line)))
    return rows.filter(F.col("reason").isNull()).select(*RECORD, "login", "name", "bio")


def read_repos(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """The sound repository lists of files, one row per repository."""
    return listed_repos(in_order(pick_repos(read_repo_lists(spark, paths))))


def explode_repos(table: DataFrame) -> DataFrame:
    return table.select("candidate_id", F.posexplode("repos").alias("repo_pos", "repo")).select(
        "candidate_id",
        F.col("repo_pos").cast("bigint").alias("repo_pos"),
        F.col("repo.name").alias("name"),
        F.col("repo.language").alias("language"),
    )


def pick_json(table: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(candidate_id, record_ord, profile, repos) with both as JSON text:
    typed profiles with the reason a record is unusable, and repositories."""
    parsed = table.select(
        "candidate_id",
        "record_ord",
        F.col("profile").isNotNull().alias("given"),
        F.col("repos").isNotNull().alias("repos_given"),
        untyped.parse(F.col("profile")).alias("p"),
        untyped.parse(F.col("repos")).alias("r"),
        untyped.whole(F.col("profile")).alias("whole"),
        untyped.whole(F.col("repos")).alias("list"),
    )
    # in steps, so that no expression is repeated in the code of the next
    keys = ("login", "name", "bio")
    read = parsed.select(
        "candidate_id", "record_ord",
        (F.col("given") & F.col("p").isNull()).alias("broken"),
        (F.col("repos_given") & F.col("r").isNull()).alias("repos_broken"),
        "whole", "list",
        F.try_variant_get(F.col("r"), "$", "array<variant>").alias("items"),
        *[untyped.attribute(F.col("p"), k).alias(k) for k in keys],
    )

    def odd_language(item: Column) -> Column:
        return ~F.coalesce(untyped.attribute(item, "language")["text"], F.lit(True))

    checked = read.select(
        "candidate_id", "record_ord", "broken", "repos_broken", "whole", "list",
        untyped.usable(F.col("whole")).alias("filled"),
        untyped.usable(F.col("list")).alias("has_repos"),
        F.exists("items", lambda v: ~F.schema_of_variant(v).startswith("OBJECT")).alias("odd_item"),
        F.exists("items", odd_language).alias("odd_language"),
        *keys,
    )
    filled, listed = F.col("filled"), F.col("filled") & F.col("has_repos")
    reason = (
        F.when(F.col("broken"), "malformed json")
        .when(F.col("repos_broken"), "malformed repositories")
        .when(filled & ~F.col("whole").startswith("{"), "not an object")
        .when(~F.col("name")["text"], "name is not a text")
        .when(~F.col("bio")["text"], "bio is not a text")
        .when(listed & ~F.col("list").startswith("["), "repositories are not a list")
        .when(listed & F.col("odd_item"), "repository is not an object")
        .when(listed & F.col("odd_language"), "language is not a text")
    )
    profiles = checked.select(
        "candidate_id",
        "record_ord",
        # any usable login is written into the link, a number too
        F.col("login")["chars"].alias("login"),
        F.when(F.col("name")["text"], F.col("name")["chars"]).alias("name"),
        F.when(F.col("bio")["text"], F.col("bio")["chars"]).alias("bio"),
        filled.alias("filled"),
        reason.alias("reason"),
    )
    repos = read.select("candidate_id", F.posexplode("items").alias("repo_pos", "repo")).select(
        "candidate_id",
        F.col("repo_pos").cast("bigint").alias("repo_pos"),
        F.try_variant_get("repo", "$.name", "string").alias("name"),
        F.try_variant_get("repo", "$.language", "string").alias("language"),
    )
    return untyped.computed_once(profiles), repos


def profile_facts(
    profiles: DataFrame, source_ord: int = 2, rules: Rules = FIXED, watch: Watch | None = None
) -> DataFrame:
    extra = ["blocked"] if "blocked" in profiles.columns else []
    clean = profiles.select(
        "candidate_id",
        "record_ord",
        F.col("name").alias("raw_name"),
        F.col("bio").alias("raw_bio"),
        clean_text(F.col("name")).alias("name"),
        clean_text(F.col("bio")).alias("bio"),
        F.when(present(F.col("login")), F.concat(F.lit(CODE_HOST_URL), F.col("login"))).alias("link"),
        *extra,
    )
    clean = watched(clean, watch, CODE_HOST, {"full_name": ("raw_name", "name"), "headline": ("raw_bio", "bio")})
    return facts_of(
        clean,
        CODE_HOST,
        source_ord,
        [
            Reading("full_name", "direct", rules.prior("full_name", CODE_HOST), ("name",)),
            Reading("headline", "direct", rules.prior("headline", CODE_HOST), ("bio",)),
            Reading("links", "direct", rules.prior("links", CODE_HOST), ("link",)),
        ],
        "blocked" if extra else None,
    )


def filled_profiles(profiles: DataFrame) -> DataFrame:
    """Profiles with at least one attribute; an empty object is no profile."""
    if "filled" in profiles.columns:
        return profiles.filter("filled")
    return profiles.filter(
        F.coalesce(F.col("login"), F.col("name"), F.col("bio")).isNotNull()
    )


def repos_with_profile(repos: DataFrame, profiles: DataFrame) -> DataFrame:
    """Repositories count only for candidates who have a profile. The size of
    neither side is known, so the join strategy is left to the engine."""
    return repos.join(filled_profiles(profiles).select("candidate_id"), "candidate_id", "left_semi")


def distinct_languages(repos: DataFrame) -> DataFrame:
    """Distinct raw languages of a candidate in order of first appearance;
    combined before the shuffle, so a long repository list is no hot task."""
    return (
        repos.filter(present(F.col("language")))
        .groupBy("candidate_id", "language")
        .agg(F.min("repo_pos").alias("repo_pos"))
    )


def repo_facts(
    repos: DataFrame, keep: Callable[[DataFrame], DataFrame] = lambda rows: rows, source_ord: int = 2,
    rules: Rules = FIXED, watch: Watch | None = None,
) -> DataFrame:
    """One inferred skill per distinct language, below a declared skill. Which
    candidates count is asked after the distinct step: raw rows are not joined."""
    named = keep(distinct_languages(repos)).select(
        "candidate_id", "language", "repo_pos", skill_name(F.col("language")).alias("skill"))
    return watched(named, watch, CODE_HOST, {"skills": ("language", "skill")}).select(
        "candidate_id",
        F.lit("skills").alias("field"),
        F.col("skill").alias("value"),
        F.lit(None).cast(EXPERIENCE_TYPE).alias("exp"),
        F.lit(CODE_HOST).alias("source"),
        F.lit("inferred-from-repos").alias("method"),
        F.lit(rules.prior("skills", CODE_HOST) - INFERRED_SKILL_DISCOUNT).alias("confidence_milli"),
        F.lit(source_ord).alias("source_ord"),
        F.col("repo_pos").alias("record_ord"),
        F.lit(FIRST_SKILL_EMIT).alias("emit_ord"),
    ).select(*FACT_COLUMNS)
