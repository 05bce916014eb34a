"""The provenance ledger: every fact with its rank and what became of it.

A fact gives at most one ledger row, so the ledger is the fact table with more
columns: no section is merged on its own, nothing is unioned or joined back.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..constants import (
    CODE_HOST_DOMAIN,
    NETWORK_DOMAIN,
    SECTION_NO,
    SINGLE_SECTIONS,
)
from ..functions import FIXED, Rules, literal_map
from .skew import (
    HOT_LIMIT, NUMBER, PARTITION_BITS, Split, are_few, cut_points, in_order, n_parts, part_of, small, split_hot,
)
from .storage import settle, written

SINGLE_NOS = [SECTION_NO[s] for s in SINGLE_SECTIONS]
EMAILS, PHONES = SECTION_NO["emails"], SECTION_NO["phones"]
SKILLS, EXPERIENCE, LINKS = SECTION_NO["skills"], SECTION_NO["experience"], SECTION_NO["links"]

GROUP = ["candidate_id", "section_ord"]
LEDGER_COLUMNS = [
    "candidate_id", "field", "section_ord", "seq", "value", "exp", "best_exp", "slot", "is_first",
    "source", "method", "prov_method", "confidence_milli", "item_r",
]


# conditions and keys of the rules, as SQL text
SINGLE = f"section_ord IN ({', '.join(map(str, SINGLE_NOS))})"
CODE_HOST_HIT = f"coalesce(section_ord = {LINKS} AND contains(value, '{CODE_HOST_DOMAIN}'), false)"
NETWORK_HIT = f"coalesce(section_ord = {LINKS} AND contains(value, '{NETWORK_DOMAIN}'), false)"
# most trusted value, then the source first in priority, then arrival
WINNER = f"min(CASE WHEN {SINGLE} THEN struct(-confidence_milli, priority, r) END)"
# rank of the first code-host link, and of the first network link but that one
FIRST_CODE_HOST = f"min(CASE WHEN {CODE_HOST_HIT} THEN r END)"
FIRST_NETWORK = f"min(CASE WHEN {NETWORK_HIT} AND NOT is_code_host THEN r END)"
# entry with the most filled attributes, the earliest of equals
BEST_EXP = "max_by(exp, struct(richness, -r))"
# place of a link; for other sections the merge key
SLOT = f"""CASE WHEN section_ord <> {LINKS} THEN item WHEN is_code_host THEN 'github'
  WHEN r = network_r THEN 'linkedin' WHEN section_ord = {LINKS} THEN 'other:' || item END"""
SEQ = f"CASE WHEN {SINGLE} THEN CASE WHEN r = win_r THEN 1 WHEN r < win_r THEN r + 1 ELSE r END ELSE r END"
PROV_METHOD = f"""CASE WHEN section_ord IS NULL THEN NULL
  WHEN {SINGLE} AND r <> win_r THEN 'discarded:' || method
  WHEN section_ord IN ({EMAILS}, {PHONES}) AND NOT is_first THEN NULL
  WHEN section_ord = {EXPERIENCE} AND NOT is_first THEN 'merged-duplicate:' || method
  ELSE method END"""
# only decisions that won a place count for the confidence
WON = """CASE WHEN NOT startswith(prov_method, 'discarded') AND NOT startswith(prov_method, 'merged-duplicate')
  THEN confidence_milli END"""
# arrival order, with the content last so that equal positions sort alike in
# every run
SORT_KEYS = ["trust", "source_ord", "record_ord", "emit_ord", "source", "method", "item", "value", "exp"]


def in_sections(facts: DataFrame, rules: Rules = FIXED) -> DataFrame:
    """Section number and sort keys of every fact. Facts of a field that has no
    merge rule keep no section, like the markers of candidates without facts."""
    filled = " + ".join(
        f"CASE WHEN exp.{c} <> '' THEN 1 ELSE 0 END" for c in ("company", "title", "start", "`end`", "summary")
    )
    return (
        facts.withColumns({
            "section_ord": F.try_element_at(literal_map(SECTION_NO), F.coalesce("field", F.lit(""))),
            "priority": rules.place_of(F.coalesce("source", F.lit(""))),
            "richness": F.expr(filled),
            "_company": F.expr("lower(coalesce(exp.company, ''))"),
            "_title": F.expr("lower(coalesce(exp.title, ''))"),
        })
        .withColumns({
            # single values: order of arrival; lists: most trusted first
            "trust": F.expr(f"CASE WHEN {SINGLE} THEN 0 ELSE -confidence_milli END"),
            # the length keeps company and title apart in the joint key
            "item": F.expr(
                f"CASE WHEN {SINGLE} THEN '' WHEN section_ord = {EXPERIENCE} "
                "THEN concat(length(_company), ':', _company, _title) ELSE value END"
            ),
        })
        .drop("_company", "_title")
    )


def _finish(df: DataFrame, *also: str) -> DataFrame:
    return df.withColumns({
        "seq": F.expr(f"CAST({SEQ} AS BIGINT)"), "prov_method": F.expr(PROV_METHOD)
    }).select(*also, *LEDGER_COLUMNS)


def _decided(placed: DataFrame, *where: str) -> DataFrame:
    """What becomes of every fact of a group that lies in one task, by windows
    that all reuse the shuffle before them; it went by the columns ``where``."""
    group = Window.partitionBy(*where, *GROUP)
    in_order = group.orderBy(*SORT_KEYS)
    so_far = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    item = Window.partitionBy(*where, *GROUP, "slot")
    return _finish(
        placed.withColumns({
            "r": F.row_number().over(in_order),
            "_nth": F.expr(f"count_if({CODE_HOST_HIT})").over(so_far),
        })
        .withColumn("is_code_host", F.expr(f"{CODE_HOST_HIT} AND _nth = 1"))
        .withColumns({"_win": F.expr(WINNER).over(group), "network_r": F.expr(FIRST_NETWORK).over(group)})
        .withColumns({"win_r": F.col("_win.r"), "slot": F.expr(SLOT)})
        .withColumns({"item_r": F.min("r").over(item), "_best": F.expr(BEST_EXP).over(item)})
        .withColumns({"is_first": F.expr("r = item_r"), "best_exp": F.expr("CASE WHEN r = item_r THEN _best END")}),
        *where,
    )


def ledger_in_place(facts: DataFrame, rules: Rules = FIXED, tasks: int | None = None) -> DataFrame:
    """Ledger of ordinary candidates: one shuffle by candidate, then windows
    that all reuse it. Keys are made after the shuffle, which carries the bare
    facts only."""
    by_candidate = facts.repartition(tasks, "candidate_id") if tasks else facts.repartition("candidate_id")
    return _decided(in_sections(by_candidate, rules))


@dataclass(frozen=True)
class Across:
    """Ledger of hot candidates: of those who lie in one part, with `_part`;
    and of those who lie in several, with the list of their ids."""

    whole: DataFrame
    cut: DataFrame
    ids: DataFrame


def ledger_in_parts(hot: DataFrame, rules: Rules = FIXED) -> Across:
    """The same columns from a distributed ranking. The facts are dealt to parts
    by range of candidate, section and order, of about the same size whatever a
    candidate has. They move once, bare, and what a part holds is decided there;
    where a boundary falls among the facts of a candidate, the decision is made
    across the parts. There are fewer such candidates than parts."""
    rows = hot.count()
    parts = n_parts(hot, rows)
    few = are_few(parts)
    keys = [*GROUP, *SORT_KEYS]
    keyed = in_sections(hot, rules)
    points = cut_points(keyed, keys, parts, rows)
    owners = points["candidate_id"]
    between = small(hot.sparkSession.range(1).select(F.explode(owners).alias("candidate_id")).distinct(), few)
    # who has no cut point among their facts lies in one part, told by the id
    bare = hot.join(between, "candidate_id", "left_anti").withColumn(
        "_part", part_of(F.col("candidate_id"), owners, parts))
    whole = _decided(in_sections(bare.repartitionById(parts, "_part"), rules), "_part")
    cut = keyed.join(between, "candidate_id", "left_semi").withColumn("_part", part_of(F.struct(*keys), points, parts))
    return Across(whole, *ledger_of_cut(cut, parts, few))


def ledger_of_cut(facts: DataFrame, parts: int, few: bool) -> tuple[DataFrame, DataFrame]:
    """Ledger of candidates who lie in several parts, from aggregates that
    combine before their shuffle; and the ids.

    All is decided by the numbers of the rows in the whole order; they become
    ranks by one small table per group and part, which brings along the winner
    and the links that were found. The rows move twice: to that table, and by
    their unique numbers to what is first of its kind, so that no join key is
    hot. The ordered rows, the small table and the ledger are each written:
    nothing is ranked twice."""
    everything, sizes = in_order(facts, GROUP, SORT_KEYS, parts)
    # markers hold no fact, but keep their candidate
    ids = settle(everything.select("candidate_id").distinct())
    rows = everything.filter(F.col("section_ord").isNotNull()).withColumnRenamed("_row", "r")
    sizes = settle(sizes)
    heads = rows.groupBy(*GROUP).agg(F.expr(f"{WINNER}.r").alias("_win"), F.expr(FIRST_CODE_HOST).alias("code_host_r"))
    # the winner's own part gives its rank
    heads = settle(
        heads.withColumn("_part", F.shiftright("_win", PARTITION_BITS)).join(small(sizes, few), [*GROUP, "_part"], "left")
        .select(*GROUP, F.expr(NUMBER.format("_win")).alias("win_r"), "code_host_r"))
    link = f"section_ord = {LINKS}"
    links = rows.filter(link).join(small(heads.filter(link), few), GROUP).withColumn(
        "is_code_host", F.expr("coalesce(r = code_host_r, false)"))
    network = settle(links.groupBy("candidate_id").agg(F.expr(FIRST_NETWORK).alias("network_r")))
    # only links need their group to know their slot
    sloted = links.join(small(network, few), "candidate_id", "left").withColumn("slot", F.expr(SLOT))
    columns = [*GROUP, "slot", "r", "exp", "richness"]
    firsts = (
        rows.filter(f"NOT ({link})").withColumn("slot", F.col("item")).select(*columns).unionByName(sloted.select(*columns))
        .groupBy(*GROUP, "slot")
        .agg(F.min("r").alias("_first"), F.expr(BEST_EXP).alias("best_exp"))
        .select("_first", "best_exp")
    )
    side = sizes.join(small(heads, few), GROUP).join(small(network, few), "candidate_id", "left")
    decided = (
        rows.join(small(side, few), [*GROUP, "_part"])
        .withColumn("is_code_host", F.expr("coalesce(r = code_host_r, false)"))
        .withColumn("slot", F.expr(SLOT))
        .withColumn("rank", F.expr(NUMBER.format("r")))
        .select("candidate_id", "field", "section_ord", "value", "exp", "slot", "source", "method", "confidence_milli",
                "r", "rank", "win_r")
    )
    return written(_finish(
        decided.join(firsts, F.col("r") == F.col("_first"), "left").withColumns({
            "is_first": F.col("_first").isNotNull(), "item_r": F.lit(None).cast("bigint"), "r": F.col("rank")
        })
    ), "ledger"), ids


def ledger_across(hot: DataFrame, rules: Rules = FIXED) -> DataFrame:
    """Ledger of hot candidates."""
    across = ledger_in_parts(hot, rules)
    return across.whole.drop("_part").unionByName(across.cut)


def ledger(
    facts: DataFrame, limit: int = HOT_LIMIT, split: Split | None = None, rules: Rules = FIXED
) -> DataFrame:
    """Ledger of all candidates, one row per fact of a merged field."""
    split = split or split_hot(facts, limit)
    rows = ledger_in_place(split.regular, rules, split.tasks)
    if split.hot is not None:
        rows = rows.unionByName(ledger_across(split.hot, rules))
    return rows.filter(F.col("section_ord").isNotNull())


def provenance(ledger_rows: DataFrame) -> DataFrame:
    """The ledger as a table of decisions, in output order by section and seq."""
    return ledger_rows.filter(F.col("prov_method").isNotNull()).select(
        "candidate_id", "section_ord", "seq", "field", "source",
        F.col("prov_method").alias("method"), "confidence_milli",
    )


def unmerged(facts: DataFrame) -> DataFrame:
    """Facts of fields that have no merge rule, counted for the run report."""
    known = list(SECTION_NO)
    return (
        facts.filter(F.col("field").isNotNull() & ~F.col("field").isin(known))
        .groupBy("field", "source")
        .agg(F.count("*").alias("n_facts"))
    )
