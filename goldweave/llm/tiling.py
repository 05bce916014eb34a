"""Benchmark decontamination by greedy string tiling.

Token runs that a document shares with a benchmark item are found from seeds of
`min_match` tokens; then, as long as there is one, the longest match of tokens
that are still free in both is marked as a tile (running Karp-Rabin: the search
length falls, windows of the free tokens of the item are hashed, those of the
document looked up and compared). Tiles do not care for order, so a passage
whose parts were moved is covered all the same. A document is contaminated when
tiles cover at least `min_percent` of an item.

Tokens are the runs of letters and digits, lower-cased. The benchmark is cut
into blocks of at most `block_chars` characters (an item is never cut); each
block goes to every task and all documents are held against it, so documents
are never shuffled and a passage in a third of them makes no group.

Defined results: null and empty texts match nothing; items with fewer tokens
than `min_match` are matched as a whole, items without tokens never; repeated
items and documents each give their rows; an empty table gives an empty result;
further columns stay in `without_leaks`.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .text import whole

TOKEN = re.compile(r"[^\W_]+")


@dataclass(frozen=True)
class Tiling:
    min_match: int = 5
    min_percent: int = 50
    block_chars: int = 16_000_000


class Block:
    """Items of one block: their tokens as numbers, and their seeds."""

    def __init__(self, items: list[tuple], min_match: int) -> None:
        self.words: dict[str, int] = {}
        self.items: list[tuple[object, list[int]]] = []
        self.short: dict[int, list[int]] = defaultdict(list)
        self.min_match = min_match
        grams: dict[int, set[int]] = defaultdict(set)
        for item_id, text in items:
            tokens = [self.words.setdefault(w, len(self.words)) for w in TOKEN.findall((text or "").lower())]
            if not tokens:
                continue
            self.items.append((item_id, tokens))
            here = len(self.items) - 1
            if len(tokens) < min_match:
                self.short[len(tokens)].append(here)
            elif len(tokens):
                for g in self.hashes(np.array(tokens, np.int64), min_match)[0].tolist():
                    grams[g].add(here)
        self.seeds = np.array(sorted(grams), np.uint64)
        self.owners = {g: sorted(v) for g, v in grams.items()}

    @staticmethod
    def hashes(tokens: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the windows whose tokens are all known, and their starts."""
        n = len(tokens) - width + 1
        if n <= 0:
            return np.empty(0, np.uint64), np.empty(0, np.int64)
        missing = np.concatenate([[0], np.cumsum(tokens < 0)])
        at = np.flatnonzero(missing[width:] == missing[:n])
        h = np.zeros(len(at), np.uint64)
        for k in range(width):
            h = (h ^ tokens[at + k].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
        return h, at

    def candidates(self, tokens: np.ndarray) -> dict[int, np.ndarray]:
        """Item number -> starts of the seeds that the document shares with it."""
        found: dict[int, list[int]] = defaultdict(list)
        h, at = self.hashes(tokens, self.min_match)
        if len(h) and len(self.seeds):
            place = np.minimum(np.searchsorted(self.seeds, h), len(self.seeds) - 1)
            for k in np.flatnonzero(self.seeds[place] == h):
                for item in self.owners[int(h[k])]:
                    found[item].append(int(at[k]))
        return {item: np.array(starts) for item, starts in found.items()}


def tile(text: list[int], item: list[int], least: int) -> list[tuple[int, int, int]]:
    """Greedy tiles (start in text, start in item, length), longest first; of
    equal lengths the earliest. Negative numbers in text match nothing."""
    free_text, free_item = [t >= 0 for t in text], [True] * len(item)
    tiles: list[tuple[int, int, int]] = []

    def runs(free: list[bool], size: int) -> Iterator[int]:
        """Starts of free windows of the size."""
        length = 0
        for i, ok in enumerate(free):
            length = length + 1 if ok else 0
            if length >= size:
                yield i - size + 1

    def rolling(tokens: list[int], free: list[bool], size: int) -> Iterator[tuple[int, int]]:
        base, mod = 1_000_003, (1 << 61) - 1
        top = pow(base, size - 1, mod)
        last, h = None, 0
        for s in runs(free, size):
            if last == s - 1:
                h = ((h - tokens[last] * top) * base + tokens[s + size - 1]) % mod
            else:
                h = 0
                for t in tokens[s:s + size]:
                    h = (h * base + t) % mod
            last = s
            yield h, s

    def longest(size: int) -> list[tuple[int, int]]:
        table: dict[int, list[int]] = defaultdict(list)
        for h, s in rolling(item, free_item, size):
            table[h].append(s)
        return [(a, b) for h, a in rolling(text, free_text, size) for b in table.get(h, ())
                if text[a:a + size] == item[b:b + size]]

    high = min(len(text), len(item))
    while high >= least:
        # the longest size that still has a match: matches of a size contain
        # matches of every smaller one
        low, best, at = least, 0, []
        while low <= high:
            middle = (low + high) // 2
            pairs = longest(middle)
            if pairs:
                best, at, low = middle, pairs, middle + 1
            else:
                high = middle - 1
        if not best:
            break
        for a, b in at:
            if all(free_text[a:a + best]) and all(free_item[b:b + best]):
                free_text[a:a + best] = [False] * best
                free_item[b:b + best] = [False] * best
                tiles.append((a, b, best))
        high = best
    return tiles


def matches(block: Block, text: str, tiling: Tiling) -> list[tuple]:
    """(item_id, item tokens, covered tokens, tiles, longest tile) per item that
    the text covers enough of."""
    words = TOKEN.findall(text.lower())
    tokens = np.fromiter(map(block.words.get, words, repeat(-1)), np.int64, len(words))
    found = block.candidates(tokens)
    out = []
    for item, starts in found.items():
        item_id, wanted = block.items[item]
        # only what lies in a seed can be in a tile
        cover = np.zeros(len(tokens) + 1, np.int64)
        np.add.at(cover, starts, 1)
        np.add.at(cover, starts + tiling.min_match, -1)
        inside = np.flatnonzero(np.cumsum(cover[:-1]) > 0)
        gaps = np.flatnonzero(np.diff(inside) > 1) + 1
        near: list[int] = []
        for part in np.split(inside, gaps):
            near += [*tokens[part].tolist(), -1]
        tiles = tile(near, wanted, tiling.min_match)
        covered = sum(t[2] for t in tiles)
        if covered * 100 >= tiling.min_percent * len(wanted):
            out.append((item_id, len(wanted), covered, len(tiles), max(t[2] for t in tiles)))
    for size, items in block.short.items():
        h, _ = block.hashes(tokens, size)
        have = set(h.tolist())
        for item in items:
            item_id, wanted = block.items[item]
            if int(block.hashes(np.array(wanted, np.int64), size)[0][0]) in have:
                out.append((item_id, size, size, 1, size))
    return out


def benchmark_blocks(benchmark: DataFrame, tiling: Tiling) -> Iterator[list[tuple]]:
    """The items, block by block; each has at most block_chars characters (or
    one item)."""
    size = F.length(whole(F.col("text"))) + 1
    before = F.sum(size).over(Window.partitionBy("_slice").orderBy("item_id", "text").rowsBetween(
        Window.unboundedPreceding, -1))
    total = benchmark.agg(F.sum(size)).first()[0] or 0
    slices = max(1, -(-2 * total // tiling.block_chars))
    cut = benchmark.select("item_id", "text", F.pmod(F.xxhash64("item_id", "text"), F.lit(slices)).alias("_slice"))
    cut = cut.withColumn("_block", (F.coalesce(before, F.lit(0)) / tiling.block_chars).cast("long"))
    keys = cut.select("_slice", "_block").distinct().orderBy("_slice", "_block").toLocalIterator()
    for s, b in keys:
        yield [tuple(r) for r in cut.filter((F.col("_slice") == s) & (F.col("_block") == b)).select(
            "item_id", "text").orderBy("item_id", "text").collect()]


def leaks(docs: DataFrame, benchmark: DataFrame, tiling: Tiling = Tiling()) -> DataFrame:
    """One row per document and item that it covers enough of."""
    spark = docs.sparkSession
    doc_kind, item_kind = docs.schema["doc_id"].dataType, benchmark.schema["item_id"].dataType
    schema = (f"doc_id {doc_kind.simpleString()}, item_id {item_kind.simpleString()}, n_tokens int, "
              "n_covered int, n_tiles int, longest int")
    slim = docs.select("doc_id", whole(F.col("text")).alias("text"))
    out = spark.createDataFrame([], schema)
    for items in benchmark_blocks(benchmark, tiling):
        sent = spark.sparkContext.broadcast(items)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            block = Block(sent.value, tiling.min_match)
            for batch in batches:
                ids = batch.column(0).to_pylist()
                rows = [(ids[i], *m) for i, text in enumerate(batch.column(1).to_pylist())
                        for m in matches(block, text, tiling)]
                if rows:
                    of = [pa.array([r[k] for r in rows]) for k in range(6)]
                    yield pa.RecordBatch.from_arrays(
                        [of[0].cast(batch.schema.field(0).type), of[1], *(c.cast(pa.int32()) for c in of[2:])],
                        names=["doc_id", "item_id", "n_tokens", "n_covered", "n_tiles", "longest"])

        out = out.unionAll(slim.mapInArrow(run, schema))
    return out


def without_leaks(docs: DataFrame, benchmark: DataFrame, tiling: Tiling = Tiling()) -> DataFrame:
    """The documents that cover no item, with all their columns."""
    spark = docs.sparkSession
    names = docs.columns
    place = names.index("text")
    for items in benchmark_blocks(benchmark, tiling):
        sent = spark.sparkContext.broadcast(items)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            block = Block(sent.value, tiling.min_match)
            for batch in batches:
                clean = [not matches(block, text or "", tiling) for text in batch.column(place).to_pylist()]
                yield batch.filter(pa.array(clean, pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
