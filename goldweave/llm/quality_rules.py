"""Quality rules, with the frequency of lines across the documents of a host.

Base rules look at one text: too few words, or too many words in repeated
three-word windows. The cross-document rule counts, for every normalised line,
the distinct texts of its host that hold it. Lines above the limits are
boilerplate: they are removed, and a document that loses most of its words by
that is rejected. Copies of one text count once, so a clean document is not
rejected for having copies.

Built-in functions only. The counts are made in two steps (distinct, then
count) that both combine before their shuffle, so a line in a third of all
documents makes no large group. At most 100 / share lines per line position of
a mean document can be frequent in a host; they go to every task as one array
per host while they are few (checked), else by a join that the engine can
split. Texts themselves are never shuffled in the first case.

Defined results: a null or empty text has no words and fails the base rules; a
null source is a host of its own; repeated rows each get their own (equal)
result; an empty table gives an empty result; very long texts are read
whole; further columns stay, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.storage import settle
from .text import SPACES, let, packed, plain_lines, unpacked, whole, words

SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Rules:
    min_words: int = 50
    max_repeat_percent: int = 50
    # a line is frequent from so many documents and so many per mille of its host
    min_documents: int = 10
    min_permille: int = 10
    # a document is depleted when fewer percent of its words are left
    min_left_percent: int = 30
    host: str = "source"


# Frequent lines (8 bytes each) that are sent to every task.
BROADCAST_LINES = 1_000_000


def repeat_words(tokens: Column) -> Column:
    """Words in three-word windows that the text holds at least twice."""

    def count(w: Column) -> Column:
        three = F.transform(
            F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))
        # most texts repeat no window: plain numbers tell that, without places
        return let(three, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(placed(h)))

    def placed(hashes: Column) -> Column:
        windows = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
        places = let(
            F.sort_array(windows),
            lambda s: F.sort_array(F.transform(
                F.filter(s, lambda x, k: (x["h"] == F.get(s, k - 1)["h"]) | (x["h"] == F.get(s, k + 1)["h"])),
                lambda x: x["i"],
            )),
        )
        start = F.struct(F.lit(-3).alias("at"), F.lit(0).alias("n"))
        return F.aggregate(
            places, start,
            lambda a, i: F.struct(i.alias("at"), (a["n"] + F.least(F.lit(3), i - a["at"])).alias("n")),
            lambda a: a["n"],
        )

    return let(tokens, lambda w: F.when(F.size(w) < 4, F.lit(0)).otherwise(count(w))).cast("long")


def base_columns(text: Column) -> dict[str, Column]:
    body = whole(text)
    no_spaces = F.length(F.translate(body, SPACES, ""))
    with_word = F.filter(F.split(body, "\n"), lambda line: F.btrim(line, F.lit(SPACES)) != "")
    return {
        "n_words": F.size(words(text)).cast("long"),
        "word_chars": no_spaces.cast("long"),
        "n_symbols": (F.length(body) - F.length(F.translate(body, SYMBOLS, ""))).cast("long"),
        "n_dup_lines": let(with_word, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
        "n_repeat_words": repeat_words(words(text)),
    }


def frequent_lines(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """(host, line, n_docs) of the lines above the limits; line is the hash of
    the normalised line, n_docs counts distinct texts."""
    seen = docs.select(
        F.col(rules.host).alias("host"), F.xxhash64(whole(F.col("text"))).alias("doc"),
        F.explode(F.array_distinct(F.filter(plain_lines(F.col("text")), lambda x: x != ""))).alias("line"),
    ).select("host", "doc", F.xxhash64("line").alias("line"))
    lines = seen.distinct().groupBy("host", "line").agg(F.count("*").alias("n_docs"))
    sizes = (
        docs.select(F.col(rules.host).alias("of"), F.xxhash64(whole(F.col("text"))).alias("doc"))
        .distinct().groupBy("of").agg(F.count("*").alias("size"))
    )
    return (
        lines.filter(F.col("n_docs") >= rules.min_documents)
        .join(sizes, F.col("host").eqNullSafe(F.col("of")))
        .filter(F.col("n_docs") * 1000 >= F.col("size") * rules.min_permille)
        .select("host", "line", "n_docs")
    )


def judge(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """row (the other columns of the document), doc_id, all rule columns, the
    text without boilerplate as `clean_text`, and the verdict `kept`."""
    frequent = settle(
        frequent_lines(docs, rules).groupBy(F.col("host").alias("_host"))
        .agg(F.sort_array(F.collect_list("line")).alias("_frequent"))
    )
    total = frequent.agg(F.sum(F.size("_frequent"))).first()[0] or 0
    side = F.broadcast(frequent) if total <= BROADCAST_LINES else frequent
    text = F.col("text")
    slim = docs.select(packed(docs), "doc_id", "text", F.col(rules.host).alias("host"))
    joined = slim.join(side, F.col("host").eqNullSafe(F.col("_host")), "left")
    known = F.coalesce(F.col("_frequent"), F.array().cast("array<bigint>"))
    marked = joined.withColumn("_lines", F.when(
        F.size(known) == 0, F.lit(None)
    ).otherwise(F.arrays_zip(
        F.split(whole(text), "\n").alias("raw"),
        F.transform(plain_lines(text), lambda x: (x != "") & F.array_contains(known, F.xxhash64(x))).alias("out"),
    )))
    gone = F.filter("_lines", lambda x: x["out"])
    left = F.filter("_lines", lambda x: ~x["out"])
    out = marked.withColumns(base_columns(text)).withColumns({
        "n_frequent_lines": F.coalesce(F.size(gone), F.lit(0)).cast("long"),
        "n_frequent_words": F.coalesce(
            F.aggregate(gone, F.lit(0), lambda n, x: n + F.size(words(x["raw"]))), F.lit(0)).cast("long"),
        "clean_text": F.when(F.size(gone) > 0, F.array_join(F.transform(left, lambda x: x["raw"]), "\n"))
        .otherwise(text),
    })
    failed = (F.col("n_words") < rules.min_words) | (
        F.col("n_repeat_words") * 100 > F.col("n_words") * rules.max_repeat_percent
    )
    depleted = (F.col("n_words") - F.col("n_frequent_words")) * 100 < F.col("n_words") * rules.min_left_percent
    return (
        out.withColumn("base_failed", failed)
        .withColumn("depleted", depleted)
        .withColumn("kept", ~F.col("base_failed") & ~F.col("depleted"))
        .drop("_host", "_frequent", "_lines", "host", "text")
    )


def keep_good(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """The documents that pass, without their boilerplate lines, in the columns
    they came with."""
    return judge(docs, rules).filter("kept").select(*unpacked(docs, text=F.col("clean_text")))
