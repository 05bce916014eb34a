r"""Chat formatting with a grammar round trip.

A conversation becomes one text, turn after turn:

    ### Role: \n text \n </turn> \n            (raw turn)
    ### Role\: \n escaped text \n </turn> \n   (escaped turn)

The parser is deterministic: a turn begins with its header line, its body ends
at the first closing line. Turns are first rendered as they are and read back;
a turn that does not come back as exactly itself is escaped (backslashes are
doubled, then `### ` and `</turn>` are broken by one backslash, so neither can
occur in an escaped text and odd runs of backslashes mark the breaks) and read
back again. The whole conversation is then parsed and compared with its source;
if it still differed, the job would fail, never write a text it cannot read.

Roles are part of the grammar too: a role that does not read back is escaped
with its turn. Only assistant bodies are under the loss mask; `loss_spans`
gives their code point ranges in the formatted text.

Built-in functions only, one shuffle by conversation. A conversation is one
row of output, so it must fit in one; its turns are gathered, nothing else.

Defined results: null roles and texts are empty; turns go by number, nulls
first, ties by role and text; repeated rows are repeated turns; an empty table
gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .text import whole

OPEN, CLOSE = "### ", "</turn>"
ENDING = f"\n{CLOSE}\n"
RAW, ESCAPED = ":\n", "\\:\n"
# one turn: header with role and kind, body up to the first closing line
TURN = r"(?s)\G### ([^\n]*?)(\\?):\n(.*?)\n</turn>\n"


def escape(text: Column) -> Column:
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.replace(F.replace(doubled, F.lit(OPEN), F.lit("##\\# ")), F.lit(CLOSE), F.lit("<\\/turn>"))


def unescape(text: Column) -> Column:
    joined = F.replace(F.replace(text, F.lit("##\\# "), F.lit(OPEN)), F.lit("<\\/turn>"), F.lit(CLOSE))
    return F.replace(joined, F.lit("\\\\"), F.lit("\\"))


def escape_role(role: Column) -> Column:
    """Roles stand in the header line: line ends are spelled out as well."""
    return F.replace(escape(role), F.lit("\n"), F.lit("\\n"))


def unescape_role(role: Column) -> Column:
    # doubled backslashes are set aside, so that only single ones can break a line
    parts = F.split(role, r"\\\\")
    return F.array_join(F.transform(parts, lambda p: F.replace(
        F.replace(F.replace(p, F.lit("##\\# "), F.lit(OPEN)), F.lit("<\\/turn>"), F.lit(CLOSE)),
        F.lit("\\n"), F.lit("\n"))), "\\")


def render(role: Column, text: Column, escaped: Column) -> Column:
    return F.concat(
        F.lit(OPEN), F.when(escaped, escape_role(role)).otherwise(role), F.when(escaped, F.lit(ESCAPED)).otherwise(F.lit(RAW)),
        F.when(escaped, escape(text)).otherwise(text), F.lit(ENDING),
    )


def pieces(formatted: Column) -> Column:
    """Turns (role, kind, text) of a formatted text as they stand in it."""
    return F.arrays_zip(
        F.regexp_extract_all(formatted, F.lit(TURN), F.lit(1)).alias("role"),
        F.regexp_extract_all(formatted, F.lit(TURN), F.lit(2)).alias("kind"),
        F.regexp_extract_all(formatted, F.lit(TURN), F.lit(3)).alias("text"),
    )


def parse(formatted: Column) -> Column:
    """Turns (role, text) of a formatted text, in order."""
    return plain(pieces(formatted))


def plain(found: Column) -> Column:
    return F.transform(found, lambda t: F.struct(
        F.when(t["kind"] == "", t["role"]).otherwise(unescape_role(t["role"])).alias("role"),
        F.when(t["kind"] == "", t["text"]).otherwise(unescape(t["text"])).alias("text"),
    ))


def mask_fits(found: Column, spans: Column) -> Column:
    """Do the spans cover the bodies of the assistant turns, and nothing else?

    Both sides are summed up as digests of (start, length), so a conversation
    of many turns is walked once and not cut up span by span."""
    def digest(start: Column, length: Column) -> Column:
        return F.pmod(F.xxhash64(start.cast("long"), length.cast("long")), F.lit(1_000_000_007))

    def walk(a: Column, t: Column) -> Column:
        body = a["at"] + len(OPEN) + F.length(t["role"]) + F.length(t["kind"]) + len(RAW)
        said = (t["role"] == "assistant") | ((t["kind"] != "") & (unescape_role(t["role"]) == "assistant"))
        return F.struct(
            (body + F.length(t["text"]) + len(ENDING)).alias("at"),
            (a["sum"] + F.when(said, digest(body, F.length(t["text"]))).otherwise(0)).alias("sum"))

    nothing = F.lit(0).cast("long")
    read = F.aggregate(found, F.struct(nothing.alias("at"), nothing.alias("sum")), walk, lambda a: a["sum"])
    return read == F.aggregate(spans, nothing, lambda n, s: n + digest(s["start"], s["length"]))


def reads_back(role: Column, text: Column) -> Column:
    """Does the raw turn come back as exactly itself, without a control string
    that a laxer reader could take for the grammar?"""
    marks = F.lit(False)
    for mark in (OPEN, CLOSE):
        marks = marks | role.contains(mark) | text.contains(mark)
    itself = F.array(F.struct(role.alias("role"), text.alias("text")))
    return ~marks & (parse(render(role, text, F.lit(False))) == itself)


def format_conversations(turns: DataFrame) -> DataFrame:
    """conv_id, formatted, loss_spans (start, length), n_escaped, and `source`,
    the turns as they were given."""
    rows = turns.select(
        "conv_id", "turn", whole(F.col("role")).alias("role"), whole(F.col("text")).alias("text"),
    ).withColumn("escaped", ~reads_back(F.col("role"), F.col("text")))
    rows = rows.withColumn("piece", render(F.col("role"), F.col("text"), F.col("escaped")))
    in_order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    before = F.coalesce(
        F.sum(F.length("piece")).over(in_order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    body = F.length("piece") - F.when(F.col("escaped"), F.length(escape(F.col("text")))).otherwise(F.length("text")) \
        - len(ENDING)
    rows = rows.withColumns({"n": F.row_number().over(in_order), "start": before + body})
    grouped = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct(
        "n", "role", "text", "piece", "start", "escaped"))).alias("t"))
    out = grouped.select(
        "conv_id",
        F.array_join(F.transform("t", lambda t: t["piece"]), "").alias("formatted"),
        F.transform("t", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("source"),
        F.transform(F.filter("t", lambda t: t["role"] == "assistant"), lambda t: F.struct(
            t["start"].alias("start"),
            F.length(F.when(t["escaped"], escape(t["text"])).otherwise(t["text"])).alias("length"),
        )).alias("loss_spans"),
        F.size(F.filter("t", lambda t: t["escaped"])).alias("n_escaped"),
    )
    return out.withColumn("parsed", parse(F.col("formatted"))).withColumn(
        "formatted",
        F.when(F.col("parsed") == F.col("source"), F.col("formatted")).otherwise(F.raise_error(F.concat(
            F.lit("conversation does not read back: "), F.coalesce(F.col("conv_id").cast("string"), F.lit("null"))))),
    )


def digests(formatted: DataFrame) -> DataFrame:
    """What a reader of the formatted texts finds in them. The loss text is what
    the mask covers; a mask that covers anything but whole assistant bodies
    fails the job."""
    read = formatted.withColumn("found", pieces(F.col("formatted"))).withColumn("turns", plain(F.col("found")))
    said = lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))
    covered = F.array_join(F.transform(F.filter("turns", lambda t: t["role"] == "assistant"), lambda t: t["text"]), "")
    loss = F.when(mask_fits(F.col("found"), F.col("loss_spans")), covered).otherwise(F.raise_error(F.concat(
        F.lit("loss mask does not fit conversation "), F.coalesce(F.col("conv_id").cast("string"), F.lit("null")))))
    return read.withColumn("loss", loss).select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", said), ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        F.col("n_escaped").cast("long").alias("n_escaped"),
    )
