"""Toxicity: noisy-channel deobfuscation, then a score of the restored text.

Writers hide words: digits and signs for letters (1d10t), signs or spaces
between letters (s.t.u.p.i.d, i d i o t), repeated letters (looooser). Spans
that look like this are decoded; all other text is left as it is.

Channel: every character of a span opens a few edges of a lattice, each with a
cost: itself, a letter that the sign stands for, nothing (a separator between
letters, a further copy of a letter), the border of two words (at a separator,
cheaply where it is wide). Source: a character trigram model of the words of
all documents. A Viterbi pass over (place, last two letters) finds the cheapest
letters; it keeps back pointers, so spans of any length are decoded as a whole.
Spans are decoded once per task and remembered. A token is sent to the lattice
if a sign stands beside a letter in it, if its letters are kept apart, if a
letter stands three times, or if one stands twice in a token with a rare
trigram. What is restored counts beside the token as it is written.

The language model is counted over the whole corpus: every task counts its
words, word counts are added up across tasks (combined before the shuffle), and
trigrams are counted from the distinct words, so what is gathered grows with
the input. Only the trigram table, of fixed size, comes to the driver.

Score: features of a restored text are its words and their stems (first four
to six letters). From one half of at most `fit_rows` labelled documents, none
of them held out, the log odds of each feature are taken; the other half fits a
logistic curve over a document's best and summed evidence, and then the halves
change roles. A score is the mean of both.

Defined results: null and empty texts have no features and get the base score;
null labels do not count, several for one id are averaged; without labels of
both kinds every score is the share of label 1 (0 without any); an empty table
gives an empty result; repeated rows get equal scores; very long texts and spans
are read whole; further columns are ignored, whatever their names.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from math import log
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .quality_model import fitting_sample
from .text import whole

# signs that stand for letters
LEET = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "¡": "i", "µ": "u",
}
BETWEEN = " .-_*~'`,:/"
LETTER = r"[^\W\d_]"
SIGN = r"[0-9@$!|+(€£¡µ]"
WORD = re.compile(rf"{LETTER}+")
# inside one token: a sign beside a letter, letters kept apart, a letter three times
NOISY = re.compile(rf"{SIGN}{LETTER}|{LETTER}{SIGN}+$|^{LETTER}(?:[.\-_*~'`,:/]{LETTER}){{2,}}$|({LETTER})\1\1")
TWICE = re.compile(rf"({LETTER})\1")
# single characters with spaces between them; wider ones may part words
SPACED = re.compile(r"(?<!\S)\S(?: {1,3}\S){2,}(?!\S)")
GAP = re.compile(" +")
WIDE = "\u2003"
# not part of a word at its ends
HEAD, TAIL = "\"'([{*#%&-–«„“", ".,;:!?\"')]}*#%&$…-–»“”"
# the same without a sign that stands for a letter and ends no sentence
LAST_SIGN = "$"
TAIL_BUT_SIGN = TAIL.replace(LAST_SIGN, "")
# weight of a trigram that few words have, or one
RARE = 2


@dataclass(frozen=True)
class Setup:
    trigram_slots: int = 1 << 18
    fit_rows: int = 20_000
    # documents of label 1 that a feature must be in, and features kept
    min_documents: int = 3
    lexicon: int = 50_000


def _slot(gram: str, slots: int) -> int:
    return crc32(gram.encode("utf-8", "surrogatepass")) % slots


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n) over all texts, lower case."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()

        def out() -> pa.RecordBatch:
            tokens = list(counts.items())
            counts.clear()
            for token, n in tokens:
                for word in WORD.findall(token):
                    counts[word] += n
            return pa.RecordBatch.from_pydict(
                {"word": list(counts), "n": list(counts.values())},
                schema=pa.schema([("word", pa.string()), ("n", pa.int64())]))

        for batch in batches:
            for text in batch.column(0).to_pylist():
                counts.update(text.lower().split())
                if len(counts) > 300_000:
                    yield out()
                    counts.clear()
        if counts:
            yield out()

    parts = docs.select(whole(F.col("text")).alias("text")).mapInArrow(run, "word string, n bigint")
    return parts.groupBy("word").agg(F.sum("n").alias("n"))


def trigram_counts(docs: DataFrame, setup: Setup) -> np.ndarray:
    """Counts of trigrams and of their first two letters, by slot; words weigh
    by the logarithm of their count."""
    slots = setup.trigram_slots

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, pairs = Counter(), Counter()
        for batch in batches:
            for word, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                marked, weight = f"^^{word}$", 1 + int(4 * log(n))
                for k in range(len(marked) - 2):
                    grams[marked[k:k + 3]] += weight
        by_slot: Counter[int] = Counter()
        for gram, n in grams.items():
            by_slot[_slot(gram, slots)] += n
            pairs[_slot(gram[:2] + "?", slots)] += n
        if by_slot:
            yield pa.RecordBatch.from_pydict({
                "kind": [0] * len(by_slot) + [1] * len(pairs), "slot": [*by_slot, *pairs],
                "n": [*by_slot.values(), *pairs.values()]},
                schema=pa.schema([("kind", pa.int32()), ("slot", pa.int64()), ("n", pa.int64())]))

    counted = word_counts(docs).mapInArrow(run, "kind int, slot bigint, n bigint").groupBy("kind", "slot").agg(
        F.sum("n").alias("n"))
    counts = np.zeros((2, slots), np.float64)
    for kind, slot, n in counted.toLocalIterator():
        counts[kind, slot] += n
    return counts.astype(np.float32)


class Decoder:
    """Viterbi decoding of noisy spans under the trigram model."""

    def __init__(self, counts: np.ndarray) -> None:
        self.counts, self.slots = counts, counts.shape[1]
        self.scarce = (counts[0] <= RARE).tobytes()
        self.costs: dict[str, float] = {}
        self.spans: dict[str, str] = {}

    def cost(self, a: str, b: str, c: str) -> float:
        gram = a + b + c
        found = self.costs.get(gram)
        if found is None:
            n = float(self.counts[0, _slot(gram, self.slots)])
            of = float(self.counts[1, _slot(a + b + "?", self.slots)])
            # trigrams back off to an even spread over some thirty letters
            found = self.costs[gram] = -log((n + 0.5) / (of + 15.0))
            if len(self.costs) > 1_000_000:
                self.costs.clear()
        return found

    def edges(self, span: str, k: int) -> list[tuple[str, float]]:
        """(letters, channel cost) for the character at k."""
        c, before = span[k], span[k - 1] if k else ""
        out: list[tuple[str, float]] = []
        if c.isalpha():
            # a further copy of a letter: dear to keep, the more copies there are
            again = c == before
            run = again and k > 1 and span[k - 2] == c
            out.append((c, 4.0 if run else 0.7 if again else 0.0))
            if again:
                out.append(("", 0.3 if run else 2.5))
        else:
            for letter in LEET.get(c, ""):
                out.append((letter, 1.0))
            out.append(("", 1.5 if c == WIDE else 0.5 if c in BETWEEN else 6.0))
            if c == WIDE or c in BETWEEN:
                out.append((" ", 0.3 if c == WIDE else 3.0))
        return out

    def step(self, last: str, letter: str) -> tuple[float, str] | None:
        """Source cost of a letter behind the last two, and the two that are
        last then. A border ends a word and begins one; words are not empty."""
        if not letter:
            return 0.0, last
        if letter == " ":
            return (self.cost(last[0], last[1], "$"), "^^") if last != "^^" else None
        return self.cost(last[0], last[1], letter), last[1] + letter

    def end(self, last: str) -> float:
        return 0.0 if last == "^^" else self.cost(last[0], last[1], "$")

    def decode(self, span: str) -> tuple[float, str]:
        """The least cost of a path through the lattice, and its letters."""
        states: dict[str, tuple[float, tuple | None]] = {"^^": (0.0, None)}
        for k in range(len(span)):
            after: dict[str, tuple[float, tuple | None]] = {}
            for letter, paid in self.edges(span, k):
                for last, (total, path) in states.items():
                    taken = self.step(last, letter)
                    if taken is None:
                        continue
                    value, to = total + paid + taken[0], taken[1]
                    held = after.get(to)
                    if held is None or value < held[0]:
                        after[to] = (value, (path, letter) if letter else path)
            states = after
        cost, path = min(((total + self.end(s), path) for s, (total, path) in states.items()), key=lambda x: x[0])
        letters = []
        while path is not None:
            path, letter = path
            letters.append(letter)
        return cost, "".join(reversed(letters))

    def restore(self, span: str) -> str:
        said = self.spans.get(span)
        if said is None:
            if len(self.spans) > 200_000:
                self.spans.clear()
            said = self.decode(span)[1]
            self.spans[span] = said
        return said

    def words(self, token: str) -> tuple[str, ...]:
        """The words of a lower-case token, restored where it looks noisy."""
        core = token.rstrip(TAIL).lstrip(HEAD)
        if core.isalpha():
            noisy = TWICE.search(core) and (NOISY.search(core) or self.rare(core))
            plain: tuple[str, ...] = (core,)
        else:
            noisy = NOISY.search(core) or TWICE.search(core) and self.rare(core)
            plain = tuple(WORD.findall(core))
        if noisy:
            plain = (*WORD.findall(self.restore(core)), *plain)
        if token[-1:] == LAST_SIGN:
            # it may be a letter too
            longer = token.rstrip(TAIL_BUT_SIGN).lstrip(HEAD)
            if NOISY.search(longer):
                plain = (*WORD.findall(self.restore(longer)), *plain)
        return plain

    def rare(self, core: str) -> bool:
        """Whether a letter stands twice in a trigram of few words."""
        marked = f"^^{core}$"
        for found in TWICE.finditer(core):
            at = found.start() + 1
            if any(self.scarce[_slot(marked[k:k + 3], self.slots)] for k in (at, at + 1)):
                return True
        return False

    def spaced(self, text: str) -> Iterator[str]:
        """Words out of single characters with spaces between them."""
        for found in SPACED.finditer(text):
            span = GAP.sub(lambda gap: "." if len(gap.group()) == 1 else WIDE, found.group())
            # where all gaps are wide they part letters, not words
            yield from WORD.findall(self.restore(span if "." in span else span.replace(WIDE, ".")))


def features_of(word: str) -> list[str]:
    """The word itself, and its stems."""
    return [word, *(f"{word[:k]}~" for k in (4, 5, 6) if len(word) >= k)]


class Reader(dict):
    """What to keep of a token, remembered: its features, or, with a lexicon,
    those of them that the lexicon has, with their odds."""

    def __init__(self, counts: np.ndarray, lexicons: list[dict[str, float]] | None = None) -> None:
        super().__init__()
        self.decoder, self.lexicons = Decoder(counts), lexicons
        # a feature of a word begins with the word's first letters
        self.heads = {f.rstrip("~")[:4] for lex in lexicons or [] for f in lex}

    def __missing__(self, token: str) -> tuple:
        if len(self) > 500_000:
            self.clear()
        kept = self[token] = self.of(self.decoder.words(token))
        return kept

    def of(self, words: tuple[str, ...]) -> tuple:
        if self.lexicons is None:
            return tuple(f for w in words for f in features_of(w))
        found = [f for w in words if w[:4] in self.heads for f in features_of(w)]
        return tuple((k, f, lex[f]) for k, lex in enumerate(self.lexicons) for f in found if f in lex)

    def read(self, text: str) -> set:
        lower = text.lower()
        out: set = set()
        for token in set(lower.split()):
            kept = self[token]
            if kept:
                out.update(kept)
        for word in self.decoder.spaced(lower):
            out.update(self.of((word,)))
        return out


def feature_odds(sample: DataFrame, counts, setup: Setup) -> tuple[list[dict[str, float]], list[tuple[int, int]]]:
    """Log odds of the features by half of the sample. The lexicons have a fixed
    largest size."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(counts.value)
        for batch in batches:
            # tasks add up their own batch first
            added: Counter[tuple[str, int, int]] = Counter()
            for text, y, order in zip(*(c.to_pylist() for c in batch.columns)):
                half = crc32(order.encode()) % 2
                added.update((f, half, y) for f in reader.read(text))
            yield pa.RecordBatch.from_pydict({
                "feature": [a[0] for a in added], "half": [a[1] for a in added], "y": [a[2] for a in added],
                "n": list(added.values())},
                schema=pa.schema([("feature", pa.string()), ("half", pa.int32()), ("y", pa.int32()), ("n", pa.int64())]))

    seen = sample.select("text", "y", "order").mapInArrow(run, "feature string, half int, y int, n bigint")
    half = F.crc32(F.col("order").cast("binary")) % 2
    sizes = {(r["half"], r["y"]): r["count"] for r in sample.groupBy(half.cast("int").alias("half"), "y").count().collect()}
    of = lambda y: F.sum(F.when(F.col("y") == y, F.col("n")).otherwise(0))
    table = seen.groupBy("half", "feature").agg(of(1).alias("pos"), of(0).alias("neg")).filter(
        F.col("pos") >= setup.min_documents)
    lexicons, totals = [], []
    for h in (0, 1):
        pos, neg = sizes.get((h, 1), 0), sizes.get((h, 0), 0)
        odds = F.log((F.col("pos") + 0.5) / (pos + 1.0)) - F.log((F.col("neg") + 0.5) / (neg + 1.0))
        best = table.filter(F.col("half") == h).withColumn("odds", odds).filter("odds > 1").orderBy(
            F.col("odds").desc(), "feature").limit(setup.lexicon)
        lexicons.append({r["feature"]: r["odds"] for r in best.select("feature", "odds").collect()})
        totals.append((pos, neg))
    return lexicons, totals


def evidence(hits: set[tuple[int, str, float]], lexicon: int) -> tuple[float, float]:
    odds = [h[2] for h in hits if h[0] == lexicon]
    return (max(odds), log(1 + sum(odds))) if odds else (0.0, 0.0)


def fit_curve(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic regression by Newton steps, lightly held back."""
    z = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(z.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        grad = z.T @ (p - y) + 0.1 * w
        hess = (z * (p * (1 - p))[:, None]).T @ z + 0.1 * np.eye(len(w))
        w -= np.linalg.solve(hess, grad)
    return w


def toxicity_scores(docs: DataFrame, labels: DataFrame, held_out: Column, label: str = "toxic",
                    setup: Setup = Setup()) -> DataFrame:
    """doc_id, held_out, score, predicted for all documents."""
    spark = docs.sparkSession
    counts = spark.sparkContext.broadcast(trigram_counts(docs, setup))
    sample = fitting_sample(docs, labels, label, held_out, setup.fit_rows)
    lexicons, totals = feature_odds(sample, counts, setup)
    sent = spark.sparkContext.broadcast(lexicons)

    def seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(counts.value, sent.value)
        for batch in batches:
            rows = []
            for text, y, order in zip(*(c.to_pylist() for c in batch.columns)):
                half = crc32(order.encode()) % 2
                # evidence from the lexicon of the other half
                rows.append((half, y, *evidence(reader.read(text), 1 - half)))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows]) for k in range(4)], schema=pa.schema(
                [("half", pa.int64()), ("y", pa.int64()), ("best", pa.float64()), ("total", pa.float64())]))

    rows = sample.select("text", "y", "order").mapInArrow(
        seen, "half bigint, y bigint, best double, total double").orderBy("half", "y", "best", "total").limit(
        2 * setup.fit_rows).collect()
    curves = []
    for half in (0, 1):
        own = [r for r in rows if r["half"] == half]
        y = np.array([r["y"] for r in own], np.float64)
        curves.append(fit_curve(np.array([[r["best"], r["total"]] for r in own]), y).tolist()
                      if len(np.unique(y)) == 2 else None)
    pos, all_rows = sum(t[0] for t in totals), sum(sum(t) for t in totals)
    share = pos / all_rows if all_rows else 0.0

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(counts.value, sent.value)
        for batch in batches:
            values = []
            for text in batch.column(2).to_pylist():
                hits, parts = reader.read(text), []
                for half, curve in enumerate(curves):
                    if curve is not None:
                        best, total = evidence(hits, 1 - half)
                        z = curve[0] * best + curve[1] * total + curve[2]
                        parts.append(1 / (1 + np.exp(-max(-30.0, min(30.0, z)))))
                values.append(float(np.mean(parts)) if parts else share)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(values, pa.float64())], names=["doc_id", "held_out", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    scored = docs.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), whole(F.col("text")).alias("text")).mapInArrow(
        score, f"doc_id {kind}, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
