"""Exact removal of repeated byte strings by blockwise suffix sorting.

Every byte covered by a string of `length` bytes that also starts earlier
(smaller doc_id, or same document and earlier start) is removed. Strings are
judged on the input, never cross documents, and overlaps count.

Sorting all suffixes of a corpus would move every byte many times. Instead a
cover of the suffixes is sampled; suffixes that can be repeated are sorted one
block of buckets at a time, long ties by the ranks of the sample:

1. Cover sample. A start is in the cover if its 24-byte prefix has the least
   hash in some window of `length` bytes that holds it. Like an arithmetic
   difference cover this promises that two equal windows have a cover start at
   the same offset, with 2 of 78 starts instead of 9 of 73; see the README for
   why residues were not used.
2. Prefilter. Each cover start gets the hash of its prefix (its bucket) and of
   all bytes within reach of a window through it, from 76 before to 100 after
   (its class). Starts of one class tie in every window through them. Only the
   first start of a class needs sorting; all others are covered whole. A task
   settles its own classes before anything is shuffled, so a passage in a third
   of all documents sends one row per task.
3. Buckets. Where a bucket holds several classes, their first starts are joined
   with their texts. A window through a start holds the 58 bytes from it on or
   the 58 bytes up to the end of its prefix; by these further bytes a bucket is
   split in finer ones. A task sorts the suffixes of one block of buckets at a
   time: the cover starts are ranked by the bytes behind them, and the suffixes
   that begin o bytes before a cover start are ordered by these o bytes, ties of
   any length by the ranks (`suffix_orders`). Neighbours that agree in `length`
   bytes are one group, in which the earliest stays. A bucket of more than
   20,000 classes is sorted in parts, and the first of each window of the parts
   are sorted once more, each window by itself.
4. The removed spans of each document are united and cut out.

Defined results: null and empty texts have 0 bytes, no spans and the digest of
no bytes; documents shorter than `length` keep all; a null doc_id is before all
others; rows with the same doc_id are one document for the order (a string at
the same start of such a row is not earlier), each with its own spans; an empty
table gives an empty result; further columns stay in `without_repeats`.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.storage import written
from .text import packed, whole

LENGTH = 100
GRAM = 24
# Classes of a bucket that one task sorts together.
BUCKET = 20_000
# Bytes of text that one numpy pass works on.
CHUNK = 1 << 21
_U = np.uint64
_ODD = _U(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
    return x ^ (x >> _U(32))


def _words_at_every_byte(data: np.ndarray) -> np.ndarray:
    """The eight bytes from every start as one number (data has 8 spare bytes)."""
    return np.ndarray((len(data) - 7,), "<u8", data.data, strides=(1,))


def _slide(x: np.ndarray, width: int, pick: np.ufunc) -> np.ndarray:
    """pick over x[i:i + width] for every i that has a full window."""
    have, out = 1, x
    while have * 2 <= width:
        out = pick(out[:-have], out[have:])
        have *= 2
    if have < width:
        rest = width - have
        out = pick(out[:-rest], out[rest:])
    return out


def cover_starts(data: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts in the cover of one text piece, and the hashes of their prefixes.

    data has the piece and 24 spare bytes at its end.
    """
    n = len(data) - 24
    if n < length:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    eight = _words_at_every_byte(data)
    grams = n - GRAM + 1
    h = _mix(eight[:grams] * _ODD ^ _mix(eight[8:8 + grams] * _ODD ^ _mix(eight[16:16 + grams]))) | _U(1)
    width = length - GRAM + 1
    least = _slide(h, width, np.minimum)
    # a start is taken if it is the least of a window that it lies in
    padded = np.zeros(len(least) + 2 * (width - 1), np.uint64)
    padded[width - 1:width - 1 + len(least)] = least
    taken = np.flatnonzero(_slide(padded, width, np.maximum) == h)
    return taken, h[taken]


def _around(data: np.ndarray, at: np.ndarray, first: int, count: int) -> np.ndarray:
    """Rows of `count` eight-byte words from at + first on."""
    eight = _words_at_every_byte(data)
    return eight[(at + first)[:, None] + 8 * np.arange(count)[None, :]]


def _class_hash(data: np.ndarray, at: np.ndarray, start: int, end: int, length: int) -> np.ndarray:
    """Hash of all bytes of the text within reach of a window through a start.

    data is padded by 200 zero bytes at both sides; start and end bound the text.
    """
    before, after = np.minimum(at - start, length - GRAM), np.minimum(end - at, length)
    reach = 8 * -(-(length - GRAM) // 8)
    count = (reach + 8 * -(-length // 8)) // 8
    rows = _around(data, at, -reach, count)
    # blank what is out of reach: whole bytes by position
    place = 8 * np.arange(count)[None, :] - reach
    low = np.clip(-before[:, None] - place, 0, 8).astype(np.uint64) * _U(8)
    high = np.clip(place + 8 - after[:, None], 0, 8).astype(np.uint64) * _U(8)
    ones = _U(0xFFFFFFFFFFFFFFFF)
    mask = np.where(low >= 64, _U(0), ones << np.minimum(low, _U(63)))
    mask &= np.where(high >= 64, _U(0), ones >> np.minimum(high, _U(63)))
    rows = rows & mask
    out = (before * 1024 + after).astype(np.uint64) * _ODD
    for k in range(count):
        out = _mix((out ^ rows[:, k]) * _ODD)
    return out


def _pieces(text: bytes, length: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(offset of the piece, its cover starts in the text, prefix hashes).

    Long texts are cut into overlapping pieces; the cover of a window depends
    on that window only, so the cut leaves no trace.
    """
    n = len(text)
    for at in range(0, max(n - length + 1, 0), CHUNK):
        stop = min(n, at + CHUNK + length - 1)
        data = np.zeros(stop - at + 24, np.uint8)
        data[:stop - at] = np.frombuffer(text, np.uint8, stop - at, at)
        taken, h = cover_starts(data, length)
        yield at, taken + at, h


def _spans_of(intervals: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(intervals):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


_COVER = pa.schema([("bucket", pa.int64()), ("cls", pa.int64()), ("id", pa.int64()), ("tag", pa.int64()),
                    ("at", pa.int64()), ("spans", pa.list_(pa.int64()))])


def cover_rows(docs: DataFrame, length: int) -> DataFrame:
    """Per task: the first start of every class (bucket, cls, id, tag, at), and
    what the task has settled itself (bucket null, spans = starts and ends)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0

        def close() -> Iterator[pa.RecordBatch]:
            bucket, cls, doc, at, before, after = (np.concatenate([h[k] for h in held]) for k in range(1, 7))
            ids = np.array([h[0][0] for h in held], np.int64)
            tags = np.array([h[0][1] for h in held], np.int64)
            known = np.array([h[0][2] for h in held], bool)
            index = np.repeat(np.arange(len(held)), [len(h[1]) for h in held])
            i, has = ids[index], known[index]
            order = np.lexsort((at, i, has, cls, bucket))
            b, c = bucket[order], cls[order]
            new = np.ones(len(order), bool)
            new[1:] = (b[1:] != b[:-1]) | (c[1:] != c[:-1])
            group = np.cumsum(new) - 1
            heads = order[np.flatnonzero(new)][group]
            # a start equal to the first in id and place is not later than it
            same = (i[order] == i[heads]) & (has[order] == has[heads]) & (at[order] == at[heads])
            first = order[new | same]
            later = order[~(new | same)]
            yield pa.RecordBatch.from_arrays([
                pa.array(bucket[first].view(np.int64)), pa.array(cls[first].view(np.int64)),
                pa.array(i[first], mask=~has[first]), pa.array(tags[index[first]]), pa.array(at[first]),
                pa.nulls(len(first), pa.list_(pa.int64()))], schema=_COVER)
            if len(later):
                later = later[np.lexsort((at[later], index[later]))]
                owner, starts = index[later], at[later]
                cuts = np.flatnonzero(np.diff(owner)) + 1
                out = []
                for part in np.split(np.arange(len(later)), cuts):
                    spans = _spans_of(list(zip(
                        (starts[part] - before[later[part]]).tolist(), (starts[part] + after[later[part]]).tolist())))
                    o = owner[part[0]]
                    out.append((int(ids[o]) if known[o] else None, int(tags[o]), [x for s in spans for x in s]))
                yield pa.RecordBatch.from_pydict({
                    "bucket": [None] * len(out), "cls": [None] * len(out), "id": [o[0] for o in out],
                    "tag": [o[1] for o in out], "at": [None] * len(out), "spans": [o[2] for o in out]}, schema=_COVER)
            held.clear()

        for batch in batches:
            for doc_id, tag, text in zip(*(c.to_pylist() for c in batch.columns)):
                n = len(text)
                if n < length:
                    continue
                data = np.zeros(n + 400, np.uint8)
                data[200:200 + n] = np.frombuffer(text, np.uint8)
                for _, at, h in _pieces(text, length):
                    cls = _class_hash(data, at + 200, 200, 200 + n, length)
                    held.append(((doc_id or 0, tag, doc_id is not None), h, cls, at, at,
                                 np.minimum(at, length - GRAM), np.minimum(n - at, length)))
                    size += len(at)
                if size > 1_500_000:
                    yield from close()
                    size = 0
        if held:
            yield from close()

    text = whole(F.col("text"))
    return docs.select(
        F.col("doc_id").cast("long"), (F.xxhash64(text) % (1 << 40)).alias("tag"), text.cast("binary").alias("text"),
    ).mapInArrow(run, "bucket bigint, cls bigint, id bigint, tag bigint, at bigint, spans array<bigint>")


def ranked_starts(docs: DataFrame, length: int) -> DataFrame:
    """What is repeated: `spans` that are settled already, starts that are not
    the first of their class (kind 1), and first starts of buckets with several
    classes (kind 2, with the number of classes)."""
    rows = cover_rows(docs, length).withColumn("bucket_", F.coalesce("bucket", F.xxhash64("id", "tag")))
    rows = rows.repartition("bucket_")
    in_class = Window.partitionBy("bucket_", "bucket", "cls").orderBy(F.col("id").asc_nulls_first(), "at")
    in_bucket = Window.partitionBy("bucket_", "bucket")
    head = F.first(F.struct("id", "at")).over(in_class)
    later = ~(F.col("id").eqNullSafe(F.col("head.id")) & (F.col("at") == F.col("head.at")))
    rows = rows.withColumn("head", head).withColumn("kind", F.when(F.col("bucket").isNull(), 0).when(later, 1).otherwise(2))
    rows = rows.withColumn("n", F.sum((F.col("kind") == 2).cast("int")).over(in_bucket))
    several = (F.col("kind") < 2) | (F.min("cls").over(in_bucket) != F.max("cls").over(in_bucket))
    rows = rows.withColumn("several", several).filter("several")
    return written(rows.select("kind", "bucket", "id", "tag", "at", "spans", "n"), "suffix-ranks")


_ROWS = pa.schema([("key", pa.int64()), ("part", pa.int32()), ("parts", pa.int32()), ("side", pa.int32()),
                   ("id", pa.int64()), ("tag", pa.int64()), ("at", pa.int64()), ("before", pa.int32()),
                   ("after", pa.int32()), ("context", pa.binary())])
_FOUND = pa.schema([("w1", pa.int64()), ("w2", pa.int64()), ("id", pa.int64()), ("tag", pa.int64()),
                    ("at", pa.int64()), ("spans", pa.list_(pa.int64()))])


def _middle(length: int) -> int:
    return (length - GRAM) // 2 + GRAM


def bucket_rows(docs: DataFrame, starts: DataFrame, length: int) -> DataFrame:
    """Two rows per start, with the text around it: for windows that begin close
    before it (side 0) and for the others (side 1)."""
    wanted = starts.groupBy("id", "tag").agg(F.collect_list(F.struct("bucket", "at", "n")).alias("starts"))
    text = whole(F.col("text"))
    keyed = docs.select(
        F.col("doc_id").cast("long").alias("_id"), (F.xxhash64(text) % (1 << 40)).alias("_tag"),
        text.cast("binary").alias("text"))
    joined = keyed.join(wanted, F.col("_id").eqNullSafe(F.col("id")) & (F.col("_tag") == F.col("tag")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        half = _middle(length)
        near = half - GRAM
        for batch in batches:
            for doc_id, tag, text, of in zip(*(c.to_pylist() for c in batch.columns)):
                padded = bytes(length) + text + bytes(length)
                for lo in range(0, len(of), 2000):
                    out = {name: [] for name in _ROWS.names}
                    for s in of[lo:lo + 2000]:
                        at, parts = s["at"], 1 + s["n"] // BUCKET
                        before, after = min(at, length - GRAM), min(len(text) - at, length)
                        p = at + length
                        right, left = padded[p:p + half], padded[p + GRAM - half:p + GRAM]
                        part = hash((doc_id, at)) % parts
                        for side, key, a, b in ((0, right, p - near, p + length),
                                                (1, left, p + GRAM - length, p + half - 1)):
                            out["key"].append(int.from_bytes(
                                sha256(key + side.to_bytes(1, "little")).digest()[:8], "little", signed=True))
                            out["part"].append(part)
                            out["parts"].append(parts)
                            out["side"].append(side)
                            out["id"].append(doc_id)
                            out["tag"].append(tag)
                            out["at"].append(at)
                            out["before"].append(before)
                            out["after"].append(after)
                            out["context"].append(padded[a:b])
                    yield pa.RecordBatch.from_pydict(out, schema=_ROWS)

    return joined.select("id", "tag", "text", "starts").mapInArrow(
        run, "key bigint, part int, parts int, side int, id bigint, tag bigint, at bigint, before int, after int, "
             "context binary")


def suffix_orders(context: np.ndarray, base: int, offsets: range) -> Iterator[tuple[int, np.ndarray]]:
    """For each offset the rows in the order of their suffixes from so many
    bytes before the cover start on.

    The cover starts (column `base`) are ranked once, by all bytes behind them.
    The suffix one byte further to the left is that byte, and a suffix whose
    order is known: so a stable sort by one byte makes the next order out of the
    last, and ties of any length are settled by the ranks.
    """
    right = np.ascontiguousarray(context[:, base:])
    order = np.argsort(right.view(f"S{right.shape[1]}").reshape(-1), kind="stable")
    for o in range(offsets.stop):
        if o:
            order = order[np.argsort(context[order, base - o], kind="stable")]
        if o >= offsets.start:
            yield o, order


def _window_hashes(context: np.ndarray, rows: np.ndarray, w: int, length: int) -> list[np.ndarray]:
    """Two hashes of context[row, w:w + length], that meet over parts."""
    codes = np.random.default_rng(7).integers(0, 1 << 63, (2, 256), np.uint64)
    power = np.cumprod(np.full(length, _U(0x2545F4914F6CDD1D), np.uint64))
    part = context[rows, w:w + length]
    return [(code[part] * power[None, :]).sum(axis=1, dtype=np.uint64).view(np.int64) for code in codes]


def _sort_windows(rows: pa.Table, length: int) -> Iterator[pa.RecordBatch]:
    """Sort the suffixes of whole buckets; yields the spans found, and the first
    of each window for buckets that came in parts."""
    near = _middle(length) - GRAM
    for side in (0, 1):
        t = rows.filter(pc.equal(rows["side"], side))
        _, bucket, count = np.unique(t["key"].to_numpy(), return_inverse=True, return_counts=True)
        # who is alone in a whole bucket has no equal window
        t = t.filter(pa.array((count[bucket] > 1) | (t["parts"].to_numpy() > 1))).combine_chunks()
        n = t.num_rows
        if not n:
            continue
        has = ~np.asarray(t["id"].is_null())
        ids = t["id"].fill_null(0).to_numpy()
        at, before, after, parts, tags = (t[name].to_numpy() for name in ("at", "before", "after", "parts", "tag"))
        context = np.frombuffer(b"".join(t["context"].to_pylist()), np.uint8).reshape(n, -1)
        eight = np.ndarray((n, context.shape[1] - 7), "<u8", context.data, strides=(context.shape[1], 1))
        offsets = range(0, near + 1) if side == 0 else range(near + 1, length - GRAM + 1)
        base = near if side == 0 else length - GRAM  # place of the start in its context
        # earlier documents first; rows of the same id and start are equals
        by_place = np.lexsort((at, ids, has))
        step = (np.diff(has[by_place].astype(np.int8)) != 0) | (np.diff(ids[by_place]) != 0) | (np.diff(at[by_place]) != 0)
        place = np.empty(n, np.int64)
        place[by_place] = np.concatenate([[0], np.cumsum(step)])
        low, high = np.full(n, -1, np.int64), np.full(n, -1, np.int64)
        firsts = []
        for o, order in suffix_orders(context, base, offsets):
            w = base - o
            r = order[((o <= before) & (length - o <= after))[order]]
            if not len(r):
                continue
            # equal windows follow each other
            same = (eight[r[1:], w] == eight[r[:-1], w]) & (eight[r[1:], w + length - 8] == eight[r[:-1], w + length - 8])
            same[same] = (context[r[1:][same], w:w + length] == context[r[:-1][same], w:w + length]).all(axis=1)
            heads = np.flatnonzero(np.concatenate([[True], ~same]))
            group = np.zeros(len(r), np.int64)
            group[heads[1:]] = 1
            earliest = np.minimum.reduceat(place[r], heads)[np.cumsum(group)]
            later = place[r] > earliest
            hit, begin = r[later], at[r[later]] - o
            # the removed windows of a start: runs of offsets, kept as one span
            # while they touch
            fresh = low[hit] < 0
            touch = ~fresh & (begin + length >= low[hit])
            for k in np.flatnonzero(~fresh & ~touch):
                firsts.append((None, None, hit[k], None, [int(low[hit[k]]), int(high[hit[k]])]))
            high[hit] = np.where(touch, high[hit], begin + length)
            low[hit] = begin
            many = r[~later][parts[r[~later]] > 1]
            if len(many):
                one, two = _window_hashes(context, many, w, length)
                firsts += [(int(a), int(b), k, int(at[k] - o), None) for a, b, k in zip(one, two, many)]
        firsts += [(None, None, k, None, [int(low[k]), int(high[k])]) for k in np.flatnonzero(low >= 0)]
        if firsts:
            yield pa.RecordBatch.from_pydict({
                "w1": [f[0] for f in firsts], "w2": [f[1] for f in firsts],
                "id": [int(ids[f[2]]) if has[f[2]] else None for f in firsts],
                "tag": [int(tags[f[2]]) for f in firsts], "at": [f[3] for f in firsts],
                "spans": [f[4] for f in firsts]}, schema=_FOUND)


def sorted_buckets(rows: DataFrame, length: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            start = 0
            if size + batch.num_rows > BUCKET:
                # close at the last change of bucket in this batch
                k = np.stack([batch.column(0).to_numpy(), batch.column(1).to_numpy()])
                change = np.flatnonzero((k[:, 1:] != k[:, :-1]).any(axis=0)) + 1
                if len(change):
                    start = int(change[-1])
                    yield from _sort_windows(pa.Table.from_batches([*held, batch.slice(0, start)]), length)
                    held, size = [], 0
            held.append(batch.slice(start))
            size += batch.num_rows - start
        if held:
            yield from _sort_windows(pa.Table.from_batches(held), length)

    return rows.repartition("key", "part").sortWithinPartitions("key", "part").mapInArrow(
        run, "w1 bigint, w2 bigint, id bigint, tag bigint, at bigint, spans array<bigint>")


def repeated_spans(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(id, tag, spans): starts and ends of removed bytes, not yet united; one
    row per document that has any."""
    starts = ranked_starts(docs, length)
    found = written(sorted_buckets(bucket_rows(docs, starts.filter("kind = 2"), length), length), "suffix-sorted")
    by_window = Window.partitionBy("w1", "w2").orderBy(F.col("id").asc_nulls_first(), "at")
    head = F.first(F.struct("id", "at")).over(by_window)
    across = found.filter("w1 is not null").withColumn("head", head).filter(
        ~(F.col("id").eqNullSafe(F.col("head.id")) & (F.col("at") == F.col("head.at"))))
    span = lambda a, b: F.array(a.cast("long"), b.cast("long"))
    parts = [
        starts.filter("kind = 0").select("id", "tag", "spans"),
        starts.filter("kind = 1").select("id", "tag", span(
            F.greatest(F.col("at") - (length - GRAM), F.lit(0)), F.col("at") + length).alias("spans")),
        found.filter("w1 is null").select("id", "tag", "spans"),
        across.select("id", "tag", span(F.col("at"), F.col("at") + length).alias("spans")),
    ]
    every = parts[0]
    for part in parts[1:]:
        every = every.unionAll(part)
    return every.groupBy("id", "tag").agg(F.flatten(F.collect_list("spans")).alias("spans"))


def without_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """row (the other columns of the document), `kept_bytes` (what is left),
    `removed` (spans as starts and ends in bytes of the original), `n_bytes`."""
    text = whole(F.col("text"))
    tagged = docs.select(packed(docs), F.col("doc_id").cast("long").alias("_id"),
                         (F.xxhash64(text) % (1 << 40)).alias("_tag"), text.alias("text"))
    joined = tagged.join(
        repeated_spans(docs, length), F.col("_id").eqNullSafe(F.col("id")) & (F.col("_tag") == F.col("tag")), "left",
    ).select("row", "text", "spans")
    names = ["row"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, removed, sizes = [], [], []
            texts = batch.column(batch.schema.get_field_index("text")).cast(pa.binary()).to_pylist()
            for text, flat in zip(texts, batch.column(batch.schema.get_field_index("spans")).to_pylist()):
                n, cuts = len(text), []
                if flat:
                    cuts = [(a, min(b, n)) for a, b in _spans_of(list(zip(flat[::2], flat[1::2])))]
                    edges = [0, *(x for c in cuts for x in c), n]
                    text = b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2]))
                kept.append(text)
                removed.append([x for c in cuts for x in c])
                sizes.append(n)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(batch.schema.get_field_index(c)) for c in names), pa.array(sizes, pa.int64()),
                 pa.array(kept, pa.binary()), pa.array(removed, pa.list_(pa.int64()))],
                names=[*names, "n_bytes", "kept_bytes", "removed"])

    kind = joined.schema["row"].dataType.simpleString()
    return joined.mapInArrow(run, f"row {kind}, n_bytes bigint, kept_bytes binary, removed array<bigint>")


def digests(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    out = without_repeats(docs.select("doc_id", "text"), length)
    return out.select(
        "row.doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept_bytes")).cast("long").alias("n_removed"),
        (F.size("removed") / 2).cast("long").alias("n_spans"), F.sha2("kept_bytes", 256).alias("kept_sha256"))
