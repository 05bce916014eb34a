"""Exact dedup by content-defined chunk recipes.

Texts are equal when their UTF-8 bytes are. A text is cut where its own bytes
say so (a rolling hash of 32 bytes meets a mask, between `least` and `most`
bytes apart), so equal texts are cut alike. Its recipe is the ordered list of
its chunks' digests.

1. One pass writes a slim row per document: id, size, recipe, digest of the
   text. From here on no text is needed but those of step 2.
2. Digests become identifiers by proof: of the documents whose recipe another
   one shares, every distinct chunk moves once (each task and the aggregate
   before the shuffle drop repeats), and the bytes behind each digest are
   compared in full. If a digest stands for two contents, all is done again
   with digests of eight more bytes. A bitmap of fixed size tells the pass which
   documents share a recipe; a false hit moves a chunk in vain, nothing else.
3. Recipes of verified identifiers are compared as lists, combined before the
   shuffle; the largest doc_id of a group stays.
4. Groups go back to their documents by a join on the recipe. Recipes that hold
   a thousandth of all rows or more, at most a thousand, are joined in 64 parts.

Defined results: a null text counts as empty, all empty texts are one group; a
null doc_id stays only if its group has no other (it is the smallest); of rows
that repeat the largest doc_id one stays; an empty table gives an empty result;
very long texts are cut and moved like others, never whole; further columns
pass through `keep_one`, whatever their names.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.storage import written
from .text import packed, unpacked, whole

WINDOW = 32
BUCKET_BITS = 32_768  # positions in one bitmap of bitmap_construct_agg
PIECE = 4 << 20  # bytes hashed at once
SALTS = 64


@dataclass(frozen=True)
class Chunking:
    least: int = 512
    mean_bits: int = 11
    most: int = 16_384
    digest_bytes: int = 16
    # bitmaps of 4 KB each that tell which recipes are shared: 8 MB in all
    buckets: int = 2_048
    # bytes of sent chunks that a task remembers
    held: int = 32 << 20
    seed: int = 1


def rolling(data: np.ndarray, seed: int) -> np.ndarray:
    """At each byte a hash of the 32 bytes that end there, made of hashes of
    1, 2, 4, ... bytes."""
    table = np.random.default_rng(seed).integers(0, 1 << 32, 256, np.uint32)
    out, width = table[data], 1
    while width < WINDOW:
        longer = out.copy()
        longer[width:] += out[:-width] << np.uint32(width)
        out, width = longer, 2 * width
    return out


def marks(data: np.ndarray, chunking: Chunking) -> list[int]:
    """The places after which a text may be cut, found a piece at a time."""
    found = []
    for at in range(0, len(data), PIECE):
        start = max(0, at - WINDOW)
        value = rolling(data[start:at + PIECE], chunking.seed) >> np.uint32(32 - chunking.mean_bits)
        found.append(np.flatnonzero(value[at - start:] == 0) + at + 1)
    return np.concatenate(found).tolist() if found else []


def chunks(texts: pa.Array, chunking: Chunking) -> Iterator[list[memoryview]]:
    """The chunks of each text of a column. A window never reaches back over a
    text's start, as only a text's last chunk is shorter than `least`."""
    texts = texts.cast(pa.large_binary())
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, int)
    first = int(ends[0])
    view = memoryview(data)[first:int(ends[-1])] if data is not None else memoryview(b"")
    places = marks(np.frombuffer(view, np.uint8), chunking)
    for at, end in zip((ends[:-1] - first).tolist(), (ends[1:] - first).tolist()):
        out = []
        while at < end:
            k = bisect_left(places, at + chunking.least)
            cut = min(places[k] if k < len(places) else end, at + chunking.most, end)
            out.append(view[at:cut])
            at = cut
        yield out


def _digest(data: bytes | memoryview, size: int) -> bytes:
    return hashlib.blake2b(data, digest_size=size).digest()


def _place(recipe: list[bytes], chunking: Chunking) -> int:
    """Where the bitmap has the recipe's bit."""
    return int.from_bytes(_digest(b"".join(recipe), 8), "little") % (chunking.buckets * BUCKET_BITS)


def recipes(docs: DataFrame, chunking: Chunking) -> DataFrame:
    """doc_id, n_bytes, recipe, place, text_sha256, row: one row per document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made, places, shas, sizes = [], [], [], []
            for parts in chunks(batch.column(1), chunking):
                sha = hashlib.sha256()
                for c in parts:
                    sha.update(c)
                made.append([_digest(c, chunking.digest_bytes) for c in parts])
                places.append(_place(made[-1], chunking))
                shas.append(sha.hexdigest())
                sizes.append(sum(map(len, parts)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(made, pa.list_(pa.binary())),
                 pa.array(places, pa.int64()), pa.array(shas, pa.string())],
                names=["doc_id", "n_bytes", "recipe", "place", "text_sha256"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", whole(F.col("text")).alias("text")).mapInArrow(
        run, f"doc_id {kind}, n_bytes bigint, recipe array<binary>, place bigint, text_sha256 string")
    return written(rows.withColumn("row", F.monotonically_increasing_id()), "recipes")


def shared_places(groups: DataFrame, chunking: Chunking) -> np.ndarray:
    """The bitmap of the recipes that two documents or more have: a fixed
    number of rows of 4 KB."""
    bit = F.col("place") + 1
    maps = groups.groupBy(F.bitmap_bucket_number(bit).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("bits"))
    out = np.zeros((chunking.buckets, BUCKET_BITS // 8), np.uint8)
    for r in maps.collect():
        out[r.bucket - 1] = np.frombuffer(r.bits, np.uint8)
    return out


def shared_chunks(docs: DataFrame, groups: DataFrame, chunking: Chunking) -> DataFrame:
    """(digest, chunk): the distinct chunks of the documents whose recipe
    another one shares."""
    spread = docs.sparkSession.sparkContext.broadcast(shared_places(groups, chunking))
    schema = pa.schema([("digest", pa.binary()), ("chunk", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, sent, held, out = spread.value, {}, 0, []
        for batch in batches:
            for parts in chunks(batch.column(0), chunking):
                digests = [_digest(c, chunking.digest_bytes) for c in parts]
                bucket, at = divmod(_place(digests, chunking), BUCKET_BITS)
                if not bits[bucket, at >> 3] >> (at & 7) & 1:
                    continue
                for digest, chunk in zip(digests, parts):
                    if sent.get(digest) != chunk:
                        sent[digest] = bytes(chunk)
                        out.append((digest, sent[digest]))
                        held += len(chunk)
                if held > chunking.held:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in zip(*out)], schema=schema)
                    sent, held, out = {}, 0, []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in zip(*out)], schema=schema)

    return docs.select(whole(F.col("text")).alias("text")).mapInArrow(run, "digest binary, chunk binary").distinct()


def recipe_groups(docs: DataFrame, chunking: Chunking) -> tuple[DataFrame, DataFrame]:
    """The documents' rows, and the groups of more than one: n_bytes, recipe,
    place, stays, size. Equal identifiers are equal contents."""
    while True:
        rows = recipes(docs, chunking)
        groups = written(
            rows.groupBy("n_bytes", "recipe", "place").agg(
                F.max(F.struct("doc_id", "row")).alias("stays"), F.count("*").alias("size")).filter("size > 1"),
            "recipe-groups")
        contents = shared_chunks(docs, groups, chunking).groupBy("digest").count()
        if contents.filter("count > 1").isEmpty():
            return rows, groups
        chunking = replace(chunking, digest_bytes=chunking.digest_bytes + 8)


def exact_duplicates(docs: DataFrame, chunking: Chunking = Chunking()) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256, n_bytes, n_chunks: one
    row per document."""
    rows, groups = recipe_groups(docs, chunking)
    hot = groups.filter(F.col("size") >= max(rows.count() // 1000, 1000)).select(
        "place", F.lit(True).alias("hot")).distinct()
    part = F.when(F.col("hot"), (F.col("row") % SALTS).cast("int")).otherwise(F.lit(0))
    parts = F.when(F.col("hot"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    sizes = groups.join(F.broadcast(hot), "place", "left").select(
        "n_bytes", "recipe", "stays", "size", F.explode(parts).alias("part"))
    out = rows.join(F.broadcast(hot), "place", "left").withColumn("part", part).join(
        sizes, ["n_bytes", "recipe", "part"], "left")
    alone = F.col("size").isNull()
    return out.select(
        "doc_id", F.when(alone, F.col("doc_id")).otherwise(F.col("stays.doc_id")).alias("keep_id"),
        F.coalesce("size", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("row") == F.col("stays.row"))).alias("kept"), "text_sha256", "n_bytes",
        F.size("recipe").cast("long").alias("n_chunks"))


def keep_one(docs: DataFrame, chunking: Chunking = Chunking()) -> DataFrame:
    """The documents in the columns they came with, one of each group."""
    gone = exact_duplicates(docs, chunking).filter(~F.col("kept")).select(
        F.col("doc_id").alias("_id"), F.col("keep_id").alias("_stays"), F.col("text_sha256").alias("_sha"))
    rows = docs.select(packed(docs, without=()), "doc_id", F.sha2(whole(F.col("text")), 256).alias("sha"))
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("sha") == F.col("_sha"))
    left = rows.join(gone.filter(~F.col("_id").eqNullSafe(F.col("_stays"))).distinct(), same, "left_anti")
    # rows that repeat the id which stays
    again = gone.filter(F.col("_id").eqNullSafe(F.col("_stays"))).distinct()
    if not again.isEmpty():
        once = left.join(again, same, "left_semi").dropDuplicates(["doc_id", "sha"])
        left = left.join(again, same, "left_anti").unionByName(once)
    return left.select(*[c.alias(n) for c, n in zip(unpacked(docs, text=F.col("row.text")), docs.columns)])
