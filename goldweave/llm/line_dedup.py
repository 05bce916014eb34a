"""Substring dedup by hashing lines and the pieces of lines.

A text is cut into lines, and a line into units at places that its own words
decide: of every `window` neighbouring three-word hashes the smallest marks the
start of a unit. So a passage that stands inside another line is cut at the same
places there, but for its ends; a line below `window` + 2 words is one unit, and
equal lines are cut alike throughout. Units are normalised (A-Z in lower case,
runs of blanks as one) and hashed to 64 bits.

Of all units with one digest the earliest stays: smallest doc_id (null first),
then first in its text. Later ones are marked; marked units that follow each
other and hold `min_words` words or more together are removed, the spans kept
as code point ranges of the original text. A shorter run stays, as it may be
alike by chance (and so does one that a single colliding digest makes).

What that finds: a later passage of `min_words` + 2 * `window` + 1 words (51) or
more, with its line breaks in the same places, always loses `min_words` words or
more; at its two ends up to `window` + 1 words can stay, where a unit reaches
over the passage's end.

A task settles the units of a few megabytes of text before it sends anything:
the later ones are known to go, only the first of each digest is sent on to be
compared. So a line in a third of all documents makes a small group.

Defined results: null texts stay null, empty ones empty; words without end are
units like others; rows with the same doc_id are ranked by a hash of their text,
and rows that repeat in full keep the same units; an empty table gives an empty
result; very long texts are cut like others, and no list is longer than one
text's own units; further columns stay, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..operators.storage import written
from .text import packed, unpacked, whole

PIECE = 2 << 20  # bytes of text whose units are settled together
SHINGLE = 3


@dataclass(frozen=True)
class Units:
    min_words: int = 30
    window: int = 10


_ODD = 0x9E3779B97F4A7C15  # multiplier of the rolling sums, with its inverse modulo 2**64
_BACK = pow(_ODD, -1, 1 << 64)
_LOWER = np.arange(256, dtype=np.uint64) + np.uint64(1)
_LOWER[65:91] += np.uint64(32)
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n + 1, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _sums(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, powers: np.ndarray, back: np.ndarray) -> np.ndarray:
    """A hash of values[start:end] for each range, from one running sum."""
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * powers[:len(values)], dtype=np.uint64)])
    return _mixed((total[ends] - total[starts]) * back[starts] + (ends - starts).astype(np.uint64))


@dataclass(frozen=True)
class Cut:
    """Units of a buffer: where each starts, its words, its digest."""

    start: np.ndarray
    words: np.ndarray
    digest: np.ndarray


def cut(data: np.ndarray, units: Units) -> Cut:
    """The units of a buffer of bytes, lines ending at byte 10."""
    word = np.zeros(len(data) + 2, bool)
    word[1:-1] = ~_SPACE[data]
    edge = np.diff(word.astype(np.int8))
    first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    n = len(first)
    if not n:
        return Cut(first, first, first.astype(np.uint64))
    powers, back = _powers(_ODD, len(data)), _powers(_BACK, len(data))
    hashes = _sums(_LOWER[data], first, last, powers, back)
    line = np.searchsorted(np.flatnonzero(data == 10), first)
    begins = np.ones(n, bool)
    begins[1:] = line[1:] != line[:-1]
    span = units.window + SHINGLE - 1
    if n >= span:
        three = _mixed(hashes[:-2] + hashes[1:-1] * np.uint64(_ODD) + hashes[2:] * np.uint64(_BACK))
        inside = np.flatnonzero(line[:n - span + 1] == line[span - 1:])
        begins[sliding_window_view(three, units.window)[inside].argmin(axis=1) + inside] = True
    at = np.flatnonzero(begins)
    end = np.append(at[1:], n)
    return Cut(first[at], end - at, _sums(hashes, at, end, powers, back))


_UNITS = pa.schema([("digest", pa.int64()), ("id", pa.int64()), ("tag", pa.int64()), ("start", pa.int64()),
                    ("extent", pa.int64())])
# a unit's length in code points and its words as one number; at most
# window + 1 words and those of a short line
WORDS = 1 << 10


def _piece(ids: np.ndarray, known: np.ndarray, tags: np.ndarray, texts: list[bytes], units: Units) -> pa.RecordBatch:
    """The units of some texts; those that are not the first of their digest
    here, as known to go, without a digest."""
    data = np.frombuffer(b"\n".join(texts), np.uint8)
    begin = np.cumsum([0] + [len(t) + 1 for t in texts])
    found = cut(data, units)
    doc = np.searchsorted(begin, found.start, "right") - 1
    # a unit reaches to the next one, the last to the end of its text
    stop = np.append(found.start[1:], 0)
    final = np.append(doc[1:] != doc[:-1], True) if len(doc) else np.zeros(0, bool)
    stop[final] = begin[doc[final] + 1] - 1
    points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    start = points[found.start] - points[begin[doc]]
    extent = (points[stop] - points[found.start]) * WORDS + found.words
    order = np.lexsort((start, tags[doc], ids[doc], known[doc], found.digest))
    same = np.zeros(len(order), bool)
    # a row that stands twice does not come after itself
    a, b = order[1:], order[:-1]
    same[1:] = found.digest[a] == found.digest[b]
    head = np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))
    head = order[head] if len(order) else order
    twin = (start[order] == start[head]) & (tags[doc[order]] == tags[doc[head]]) & (
        ids[doc[order]] == ids[doc[head]]) & (known[doc[order]] == known[doc[head]])
    goes = np.zeros(len(order), bool)
    goes[order] = ~twin
    twice = np.zeros(len(order), bool)
    twice[order] = same & twin
    use = ~twice
    doc, digest = doc[use], found.digest[use].view(np.int64)
    return pa.RecordBatch.from_arrays([
        pa.array(digest, mask=goes[use]), pa.array(ids[doc], mask=~known[doc]), pa.array(tags[doc]),
        pa.array(start[use]), pa.array(extent[use])], schema=_UNITS)


def unit_rows(docs: DataFrame, units: Units) -> DataFrame:
    """(digest, id, tag, start, extent): units that are the first of their
    digest in their piece, and, without digest, those that are not."""
    if units.window + 2 * SHINGLE >= WORDS:
        raise ValueError("window too large")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known = batch.column(0).is_valid().to_numpy(zero_copy_only=False)
            ids = batch.column(0).fill_null(0).to_numpy(zero_copy_only=False)
            tags = batch.column(1).to_numpy(zero_copy_only=False)
            texts = batch.column(2).cast(pa.large_binary()).to_pylist()
            at = 0
            while at < len(texts):
                size, end = 0, at
                while end < len(texts) and (size < PIECE or end == at):
                    size += len(texts[end])
                    end += 1
                yield _piece(ids[at:end], known[at:end], tags[at:end], texts[at:end], units)
                at = end

    return docs.select(
        F.col("doc_id").cast("long"), F.xxhash64(whole(F.col("text"))).alias("tag"), whole(F.col("text")).alias("text")
    ).mapInArrow(run, "digest bigint, id bigint, tag bigint, start bigint, extent bigint")


def runs(starts: np.ndarray, extents: np.ndarray, min_words: int) -> tuple[list[int], int]:
    """From a text's marked units the runs of enough words, as start, end,
    start, end, ..., and how many units they have."""
    starts, first = np.unique(starts, return_index=True)  # a repeated row marks its units twice
    extents = extents[first]
    ends, words = starts + extents // WORDS, extents % WORDS
    group = np.cumsum(np.append(True, starts[1:] != ends[:-1])) - 1
    enough = np.bincount(group, words) >= min_words
    heads = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
    tails = np.append(heads[1:], len(group)) - 1
    places = np.stack([starts[heads][enough], ends[tails][enough]], axis=1)
    return places.reshape(-1).tolist(), int((tails - heads + 1)[enough].sum())


def removed_runs(docs: DataFrame, units: Units = Units()) -> DataFrame:
    """(id, tag, removed, n_units): per document that loses text, the spans
    (start, end, start, end, ...) and their number of units."""
    # a unit known to go has no digest; it is spread by its document
    rows = unit_rows(docs, units).withColumn("key", F.coalesce("digest", F.xxhash64("id", "tag", "start")))
    ranked = Window.partitionBy("key").orderBy(F.col("digest").isNull(), F.col("id").asc_nulls_first(), "tag", "start")
    place = F.struct("id", "tag", "start")
    later = F.col("digest").isNull() | ~place.eqNullSafe(F.col("head"))
    marked = rows.withColumn("head", F.first(place).over(ranked)).filter(later)
    per_text = marked.groupBy("id", "tag").agg(
        F.collect_list("start").alias("starts"), F.collect_list("extent").alias("extents"),
        F.sum(F.col("extent") % WORDS).alias("words")).filter(F.col("words") >= units.min_words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [runs(np.array(s, np.int64), np.array(e, np.int64), units.min_words)
                   for s, e in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
            found = pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([p for p, _ in out], pa.list_(pa.int64())),
                 pa.array([n for _, n in out], pa.int64())], names=["id", "tag", "removed", "n_units"])
            yield found.filter(pa.array([bool(p) for p, _ in out]))

    return written(per_text.select("id", "tag", "starts", "extents").mapInArrow(
        run, "id bigint, tag bigint, removed array<bigint>, n_units bigint"), "removed-units")


@F.pandas_udf(StringType())
def _without(text: pd.Series, removed: pd.Series) -> pd.Series:
    def one(text: str | None, places: np.ndarray | None) -> str | None:
        if text is None or places is None:
            return None
        edges = [0, *places, len(text)]
        return "".join(text[a:b] for a, b in zip(edges[::2], edges[1::2]))

    return pd.Series([one(t, p) for t, p in zip(text, removed)], dtype=object)


def without_repeats(docs: DataFrame, units: Units = Units()) -> DataFrame:
    """row (the other columns of the document), its text cut, `removed`, the
    spans taken out of the original, and n_units."""
    text = F.col("text")
    gone = removed_runs(docs, units).withColumnRenamed("removed", "_removed")
    joined = docs.select(packed(docs), text, F.col("doc_id").cast("long").alias("_id"),
                         F.xxhash64(whole(text)).alias("_tag")).join(
        gone, F.col("_id").eqNullSafe(F.col("id")) & (F.col("_tag") == F.col("tag")), "left")
    spans = F.transform(
        F.filter(F.coalesce("_removed", F.array().cast("array<bigint>")), lambda _, k: k % 2 == 0),
        lambda start, k: F.struct(start.alias("start"), F.get("_removed", 2 * k + 1).alias("end")))
    # texts that lose nothing do not pass through Python
    cut_here = F.col("_removed").isNotNull()
    left = _without(F.when(cut_here, text), F.col("_removed"))
    return joined.select(
        "row", F.when(cut_here, left).otherwise(text).alias("text"), spans.alias("removed"),
        F.coalesce("n_units", F.lit(0)).cast("long").alias("n_units"))


def cut_text(docs: DataFrame, units: Units = Units()) -> DataFrame:
    """The documents in the columns they came with, repeated passages cut."""
    return without_repeats(docs, units).select(*unpacked(docs, text=F.col("text")))


def digests(docs: DataFrame, units: Units = Units()) -> DataFrame:
    slim = docs.select("doc_id", "text", F.octet_length(whole(F.col("text"))).cast("long").alias("n_bytes"))
    text = whole(F.col("text"))
    out = without_repeats(slim, units).select("row.*", "text", "removed", "n_units")
    return out.select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length(text)).cast("long").alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"), "n_units", F.sha2(text, 256).alias("kept_sha256"))
