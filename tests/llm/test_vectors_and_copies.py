"""Hard negatives, vector codes and exact dedup against plain versions."""

import hashlib
import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from goldweave.llm import exact_dedup, hard_negatives, vector_codes

VECTORS = "vec_id bigint, embedding array<float>, label int, _tag string, share int, parts string, kind string"


def made_vectors(n=260, width=16, seed=4):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        v = [float(x) for x in np.float32(rng.normal(0, 0.3, width))]
        if i % 9 == 0:
            v = rows[3][1] if i > 9 else v  # a hot vector
        rows.append((i, v, int(rng.integers(0, 4)) if i % 3 else 1, "x", 1, "y", "z"))
    rows += [(500, None, 1, "x", 1, "y", "z"), (501, [1.0] * 15 + [None], 1, None, 1, "y", "z"),
             (502, [math.nan] * width, 1, "x", 1, "y", "z"), (503, [math.inf] * width, 2, "x", 1, "y", "z"),
             (600, [0.0] * width, None, "x", None, "y", "z"), (601, [0.25] * width, 2, "x", 1, "y", "z")]
    return rows


def usable(row):
    return row[1] is not None and all(x is not None and math.isfinite(x) for x in row[1])


def plain_negatives(rows, anchors, scale=256, keep=5, per=10):
    whole = [(r[0], [math.floor(scale * x) for x in r[1]], r[2]) for r in rows if usable(r) and r[2] is not None]
    out = set()
    for a, va, la in whole:
        if not anchors(a):
            continue
        ranked = sorted(((-sum(x * y for x, y in zip(va, v)), i, la == lb) for i, v, lb in whole if i != a))
        for p_score, p, _ in [r for r in ranked if r[2]][:keep]:
            fits = [(s, i) for s, i, same in ranked if not same and 30 * -p_score <= 100 * -s <= 90 * -p_score][:per]
            out |= {(a, p, k + 1, i, -p_score, -s) for k, (s, i) in enumerate(fits)}
    return out


def negatives(df, mining=hard_negatives.Mining(), every=20):
    got = hard_negatives.hard_negatives(df, F.col("vec_id") % every == 0, mining).collect()
    rows = [(r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score) for r in got]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.mark.parametrize("mining", [hard_negatives.Mining(), hard_negatives.Mining(anchors=3, rows=40)])
def test_negatives_against_all_pairs(spark, mining, monkeypatch):
    rows = made_vectors()
    df = spark.createDataFrame(rows, VECTORS).repartition(5)
    want = plain_negatives(rows, lambda i: i % 20 == 0)
    assert len(want) > 100 and negatives(df, mining) == want


def test_negatives_of_odd_tables(spark):
    rows = made_vectors(60)
    df = spark.createDataFrame(rows, VECTORS)
    assert negatives(df.limit(0)) == set()
    nulls = spark.createDataFrame([(None, [1.0] * 16, 1, "x", 1, "y", "z")] * 3, VECTORS)
    assert negatives(df.unionByName(nulls)) == plain_negatives(rows, lambda i: i % 20 == 0)
    short = [(1000 + i, r[1][:7], *r[2:]) for i, r in enumerate(rows) if usable(r)]
    filled = [(r[0], r[1] + [0.0] * 9, *r[2:]) for r in short]
    both = df.unionByName(spark.createDataFrame(short, VECTORS))
    assert negatives(both) == plain_negatives(rows + filled, lambda i: i % 20 == 0)
    # a repeated row takes part twice: as two of the five positives
    twice = [(0, [1.0, 0.0], 1), (1, [0.9, 0.0], 1), (1, [0.9, 0.0], 1), (2, [0.5, 0.0], 2)]
    got = hard_negatives.hard_negatives(
        spark.createDataFrame(twice, "vec_id bigint, embedding array<float>, label int"), F.col("vec_id") == 0).collect()
    assert sorted((r.positive_id, r.negative_id, r.positive_rank) for r in got) == [(1, 2, 1), (1, 2, 2)]


def test_residue_products_are_exact():
    rng = np.random.default_rng(1)
    for size, width in ((100, 64), (2**14, 64), (2**20, 300), (2**10, 9000), (5, 1)):
        a, b = (rng.integers(-size, size + 1, (7, width)) for _ in range(2))
        bound = max(int(np.max((m.astype(object) ** 2).sum(axis=1))) for m in (a, b))
        primes = hard_negatives.primes_for(bound, width)
        assert len(primes) >= 2 and min(width, 4096) * (max(primes) // 2) ** 2 < 2**24
        got = hard_negatives.scores(hard_negatives.residues(a, primes), hard_negatives.residues(b, primes), primes)
        assert (got == a.astype(object) @ b.T.astype(object)).all()
    with pytest.raises(ValueError):
        hard_negatives.primes_for(2**61, 64)


# --- vector codes ------------------------------------------------------------------------

def plain_codes(rows, scale=4096, parts=8, entries=16, rounds=6):
    kept = [(r[0], [math.floor(scale * x) for x in r[1]], r[2]) for r in rows if usable(r)]
    width = -(-max(len(v) for _, v, _ in kept) // parts)
    kept = [(i, v + [0] * (width * parts - len(v)), label) for i, v, label in kept]
    cut = lambda v, p: v[p * width:(p + 1) * width]
    seeds = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    books = [[cut(v, p) for _, v, _ in seeds] for p in range(parts)]
    far = lambda x, y: sum((a - b) ** 2 for a, b in zip(x, y))
    near = lambda x, p: min(range(len(books[p])), key=lambda e: (far(x, books[p][e]), e))
    for _ in range(rounds):
        of = [[near(cut(v, p), p) for _, v, _ in kept] for p in range(parts)]
        for p in range(parts):
            for e in range(len(books[p])):
                mine = [cut(v, p) for (_, v, _), k in zip(kept, of[p]) if k == e]
                if mine:
                    books[p][e] = [sum(c) // len(mine) for c in zip(*mine)]
    out = []
    for i, v, label in kept:
        code = [near(cut(v, p), p) for p in range(parts)]
        out.append((i, "".join(f"{c:02x}" for c in code), sum(far(cut(v, p), books[p][code[p]]) for p in range(parts)), label))
    sums = {}
    for _, _, e, label in out:
        sums[label] = sums.get(label, 0) + e
    text = ",".join(str(x) for b in books for e in b for x in e)
    sha = hashlib.sha256(text.encode()).hexdigest()
    return sorted(((i, c, e, sums[label], sha) for i, c, e, label in out), key=repr)


def codes(df, quantiser=vector_codes.Quantiser()):
    got = vector_codes.vector_codes(df, quantiser).collect()
    return sorted(((r.vec_id, r.code, r.error, r.label_error, r.codebooks_sha256) for r in got), key=repr)


@pytest.mark.parametrize("owner", [200_000, 7])
def test_codes_against_plain_rounds(spark, owner):
    rows = made_vectors()
    df = spark.createDataFrame(rows, VECTORS).repartition(5)
    assert codes(df, vector_codes.Quantiser(owner=owner)) == plain_codes(rows)


def test_codes_of_odd_tables(spark):
    rows = made_vectors(9)
    df = spark.createDataFrame(rows, VECTORS)
    assert codes(df) == plain_codes(rows)  # fewer rows than entries
    assert codes(df.limit(0)) == []
    odd = rows + [(None, [0.5] * 16, None, "x", 1, "y", "z"), (3, rows[3][1], 2, "x", 1, "y", "z"),
                  (3, rows[3][1], 2, "x", 1, "y", "z"), (77, [0.1] * 19, 1, "x", 1, "y", "z"), (78, [], 1, "x", 1, "y", "z")]
    assert codes(spark.createDataFrame(odd, VECTORS)) == plain_codes(odd)


def test_large_components_stay_exact_or_stop(spark):
    rows = [(i, [float(x) for x in np.random.default_rng(i).integers(-2000, 2000, 16)], 1, "", 1, "", "") for i in range(40)]
    assert codes(spark.createDataFrame(rows, VECTORS)) == plain_codes(rows)
    with pytest.raises(Exception, match="scaling"):
        codes(spark.createDataFrame([(1, [1e30] * 16, 1, "", 1, "", "")], VECTORS))


def test_only_members_that_change_entry_move(spark):
    rows = made_vectors()
    vectors, width = vector_codes.scaled(spark.createDataFrame(rows, VECTORS), vector_codes.Quantiser())
    quantiser = vector_codes.Quantiser()
    books = vector_codes.first_codebooks(vectors, width, quantiser)
    members = vector_codes.deal(vectors, vectors.count(), quantiser, width)
    everyone = members.count()
    residents, arrivals = vector_codes.migrate(members, books)
    assert residents.count() == 0 and arrivals.count() == everyone
    members = residents.unionByName(arrivals)
    residents, arrivals = vector_codes.migrate(members, vector_codes.updated(members, books))
    assert 0 < arrivals.count() < everyone / 2 and residents.count() + arrivals.count() == everyone
    same, none = vector_codes.migrate(residents.unionByName(arrivals), vector_codes.updated(members, books))
    assert none.isEmpty() and same.count() == everyone


# --- exact dedup --------------------------------------------------------------------------

def plain_copies(rows):
    groups = {}
    for d, t in rows:
        groups.setdefault(t or "", []).append(d)
    top = {t: max(ds, key=lambda d: (d is not None, d or 0)) for t, ds in groups.items()}
    return sorted(((d, top[t or ""], len(groups[t or ""]), d == top[t or ""],
                    hashlib.sha256((t or "").encode()).hexdigest()) for d, t in rows), key=repr)


def copies(df, chunking=exact_dedup.Chunking()):
    got = exact_dedup.exact_duplicates(df, chunking).collect()
    return sorted(((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in got), key=repr)


@pytest.fixture(scope="module")
def many(spark, rows):
    rng = random.Random(8)
    long = "".join(rng.choice("abcdefgh \nü") for _ in range(90_000))
    extra = [(1000 + k, t) for k, t in enumerate(
        [long, long, long[:-1], "x" + long, long + "x", long[:40_000] + "y" + long[40_001:], "z" * 70_000, "z" * 70_000,
         "z" * 69_999, long[:30_000] * 2, long[:30_000] * 2] + [long[:5_000]] * 200 + [None, ""])]
    return rows + extra


@pytest.mark.parametrize("chunking", [
    exact_dedup.Chunking(), exact_dedup.Chunking(digest_bytes=1), exact_dedup.Chunking(least=64, mean_bits=5, most=300),
    exact_dedup.Chunking(buckets=1, held=1000)])
def test_copies_against_plain_groups(spark, many, chunking):
    df = spark.createDataFrame(many, "doc_id bigint, text string").repartition(4)
    assert copies(df, chunking) == plain_copies(many)


def test_hot_groups_are_joined_in_parts(spark):
    rows = [(k, "one text" if k % 3 else f"text {k // 6}") for k in range(3600)]
    assert copies(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)) == plain_copies(rows)


def test_chunks_make_the_text_again_and_follow_content():
    rng = random.Random(2)
    texts = ["", "a", "".join(rng.choice("abcdef ") for _ in range(50_000)), "b" * 9_000]
    chunking = exact_dedup.Chunking()
    got = [[bytes(c) for c in parts] for parts in exact_dedup.chunks(pa.array(texts), chunking)]
    assert [b"".join(p).decode() for p in got] == texts
    # the same text behind others, and cut in pieces of another size, is cut alike
    assert [bytes(c) for c in list(exact_dedup.chunks(pa.array(texts[2:]), chunking))[0]] == got[2]
    shifted = list(exact_dedup.chunks(pa.array(["zz" + texts[2]]), chunking))[0]
    assert len(set(map(bytes, shifted)) & set(got[2])) > 0.8 * len(got[2])


def test_pieces_do_not_change_the_marks(monkeypatch):
    data = np.random.default_rng(3).integers(0, 256, 50_000, np.uint8)
    want = exact_dedup.marks(data, exact_dedup.Chunking())
    monkeypatch.setattr(exact_dedup, "PIECE", 777)
    assert exact_dedup.marks(data, exact_dedup.Chunking()) == want


def test_copies_of_odd_tables(docs, empty, repeated):
    assert copies(empty) == []
    got = sorted(((r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact_dedup.exact_duplicates(repeated).collect()), key=repr)
    assert got == sorted([(None, 3, 3, False), (None, None, 1, True), (3, 3, 3, True), (3, 3, 3, False), (3, 3, 1, True),
                          (4, 4, 1, True)], key=repr)
    kept = exact_dedup.keep_one(repeated)
    assert kept.columns == repeated.columns and kept.count() == 4
    assert exact_dedup.keep_one(docs).count() == len({t or "" for t in (r.text for r in docs.collect())})
