import hashlib
import random

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from goldweave.llm import (
    chat, components, line_dedup, minhash, mixing, quality_model, quality_rules, suffix_dedup, tiling, toxicity, warc,
)


def by_id(df, *columns):
    got = {r["doc_id"]: tuple(r[c] for c in columns) for r in df.collect()}
    return got


# --- near duplicates ------------------------------------------------------------------

def test_near_duplicates_against_all_pairs(docs, rows):
    got = by_id(minhash.near_duplicates(docs), "n_shingles", "component_id", "kept")
    want = brute.near_components(rows)
    assert got == {d: (*v, v[1] == d) for d, v in want.items()}


def test_small_blocks_find_the_same_links(docs, rows):
    got = by_id(minhash.near_duplicates(docs, minhash.Banding(block=3)), "component_id")
    assert got == {d: (v[1],) for d, v in brute.near_components(rows).items()}


def test_near_duplicates_of_odd_tables(empty, repeated):
    assert minhash.near_duplicates(empty).collect() == []
    kept = minhash.keep_one(repeated)
    assert kept.columns == repeated.columns
    assert sorted((r.doc_id or -1, r.text or "") [0] for r in kept.collect()) == [-1, 3, 3]


def test_components_of_a_long_chain_and_a_star(spark):
    links = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 160)] + [(7, 7)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(links, "u bigint, v bigint")).collect()}
    assert got == {k: 0 for k in range(41)} | {k: 100 for k in range(100, 160)}


def test_large_stars_are_joined_in_parts(spark, monkeypatch):
    rng = random.Random(4)
    links = [(5, k) for k in range(6, 700)] + [(k, 5000 + k) for k in range(6, 700, 9)] + [(9000, 9001), (9001, 20)]
    links += [(rng.randint(10_000, 10_400), rng.randint(10_000, 10_400)) for _ in range(150)]
    table = spark.createDataFrame(links, "u bigint, v bigint").repartition(5)
    want = {r.node: r.root for r in components.components(table).collect()}
    monkeypatch.setattr(components, "HOT", 3)
    assert {r.node: r.root for r in components.components(table).collect()} == want
    assert want[699] == want[9000] == want[5006] == 5
    of = {}
    for u, v in links:
        a, b = of.setdefault(u, {u}), of.setdefault(v, {v})
        if a is not b and u != v:
            a |= b
            for x in b:
                of[x] = a
    assert want == {n: min(g) for n, g in of.items() if len(g) > 1}


# --- repeated strings and lines --------------------------------------------------------

SPANS = ("n_bytes", "n_removed", "n_spans", "kept_sha256")


def test_repeated_strings_against_every_window(docs, rows):
    assert by_id(suffix_dedup.digests(docs), *SPANS) == brute.repeated_bytes(rows)


def test_large_buckets_are_sorted_in_parts(docs, rows, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "BUCKET", 2)
    monkeypatch.setattr(suffix_dedup, "CHUNK", 300)
    assert by_id(suffix_dedup.digests(docs), *SPANS) == brute.repeated_bytes(rows)


def test_suffixes_are_in_lexicographic_order():
    rng = np.random.default_rng(5)
    for letters, n, width, base in ((2, 300, 130, 30), (256, 200, 160, 76), (1, 20, 110, 10), (3, 1, 120, 20)):
        context = rng.integers(0, letters, (n, width), np.uint8)
        context[n // 2:] = context[:n - n // 2]
        context[n // 2:, rng.integers(0, width)] ^= 1
        seen = 0
        for o, order in suffix_dedup.suffix_orders(context, base, range(3, base + 1)):
            suffixes = [bytes(row[base - o:]) for row in context]
            assert [suffixes[k] for k in order] == sorted(suffixes) and sorted(order) == list(range(n))
            seen += 1
        assert seen == base - 2


def test_repeated_strings_of_odd_tables(empty, repeated):
    assert suffix_dedup.digests(empty).collect() == []
    got = [(r.doc_id, r.n_bytes - r.n_removed) for r in suffix_dedup.digests(repeated).collect()]
    # the null id is first; the whole text stands there
    assert sorted(got, key=repr) == sorted([(None, 489), (None, 0), (3, 0), (3, 0), (3, 10), (4, 5)], key=repr)
    assert "lang" in suffix_dedup.without_repeats(repeated).select("row.*").columns


def test_repeated_runs(docs, rows, empty, repeated, monkeypatch):
    want = brute.repeated_runs(rows)
    assert sum(bool(v[1]) for v in want.values()) > 10

    def check():
        out = line_dedup.digests(docs)
        got = by_id(out, "n_bytes", "n_removed", "n_spans", "n_units", "kept_sha256")
        for d, text in rows:
            left, spans, n_units = want[d]
            size = len((text or "").encode())
            assert got[d] == (size, size - len(left.encode()), len(spans), n_units,
                              hashlib.sha256(left.encode()).hexdigest())

    check()
    monkeypatch.setattr(line_dedup, "PIECE", 300)
    check()
    cut = line_dedup.cut_text(docs)
    assert cut.columns == docs.columns
    assert line_dedup.digests(empty).collect() == []


def test_repeated_runs_of_repeated_rows(spark, repeated):
    assert line_dedup.cut_text(repeated).columns == repeated.columns
    got = sorted(((r.doc_id, r.n_bytes - r.n_removed, r.n_spans) for r in line_dedup.digests(repeated).collect()), key=repr)
    # the null id is first; its text goes from 3 twice and, but for its last unit, from 4
    four = [g for g in got if g[0] == 4]
    assert sorted(set(got) - set(four), key=repr) == sorted([(None, 489, 0), (None, 0, 0), (3, 0, 1), (3, 10, 0)], key=repr)
    assert len(got) == 6 and got.count((3, 0, 1)) == 2 and four[0][2] == 1 and 5 <= four[0][1] < 70
    line = " ".join(f"v{k}" for k in range(60))
    once = [(1, line), (2, "start here " + line + "\nmore " + line)]
    twice = line_dedup.digests(spark.createDataFrame(once + once[1:], "doc_id bigint, text string"))
    single = line_dedup.digests(spark.createDataFrame(once, "doc_id bigint, text string"))
    first, = {tuple(r) for r in single.filter("doc_id = 2").collect()}
    assert {tuple(r) for r in twice.filter("doc_id = 2").collect()} == {first} and first[3] >= 2 and first[4] > 4


def test_long_passages_do_not_stand_twice(spark):
    """Passages in the middle of lines, held against all runs of words."""
    rng = random.Random(11)
    words = [f"{rng.choice('bcdfgh')}{rng.choice('aeiou')}{k}" for k in range(5000)]
    say = lambda n: [rng.choice(words) for _ in range(n)]
    shared = [say(rng.randint(51, 90)) for _ in range(12)]
    rows = [(d, " ".join(say(rng.randint(5, 80)) + rng.choice(shared) + say(rng.randint(0, 80)))) for d in range(120)]
    rows += [(d, " ".join(say(150))) for d in range(120, 160)]
    want = brute.later_runs(rows, 51)
    got = {r.row.doc_id: r for r in line_dedup.without_repeats(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert {d for d, r in got.items() if r.removed} == set(want) and len(want) == 108
    texts = dict(rows)
    for d, found in want.items():
        assert not any(run in got[d].text for run in found)
        assert all(len(texts[d][g.start:g.end].split()) >= 30 for g in got[d].removed)
    lost = sum(len(texts[d].split()) - len(got[d].text.split()) for d in want)
    # a run of n words has n - 50 windows of 51
    assert lost > 0.8 * sum(len(f) + 50 for f in want.values())


def test_removed_spans_point_into_the_original(docs, rows):
    texts = dict(rows)
    out = line_dedup.without_repeats(docs).filter(F.size("removed") > 0).collect()
    assert out
    for r in out:
        for g in r.removed:
            assert len(texts[r.row.doc_id][g.start:g.end].split()) >= 30


# --- benchmark -------------------------------------------------------------------------

def test_tiles_cover_as_a_plain_search_does():
    rng = random.Random(3)
    for _ in range(60):
        words = [f"w{k}" for k in range(12)]
        item = [rng.choice(words) for _ in range(rng.randint(5, 30))]
        text = [rng.choice(words) for _ in range(30)] + item[10:] + ["z"] + item[:10] + [rng.choice(words)] * 4
        block = tiling.Block([(1, " ".join(item))], 5)
        found = tiling.matches(block, " ".join(text), tiling.Tiling(min_percent=0))
        covered, n = brute.greedy_cover(" ".join(text), " ".join(item))
        assert found and found[0][1] == n
        # ties between longest matches may be taken in another order
        assert abs(found[0][2] - covered) <= 5


def test_leaks_reordered_and_clean(spark, docs, empty, repeated):
    item = " ".join(f"q{k}" for k in range(40))
    moved = " ".join([f"q{k}" for k in range(20, 40)] + ["x"] + [f"Q{k}," for k in range(20)])
    bench = spark.createDataFrame([(7, item), (8, None), (9, "two tokens"), (10, item)], "item_id bigint, text string")
    table = docs.select("doc_id", "text").unionByName(spark.createDataFrame(
        [(900, "before " + item + " after"), (901, moved), (902, " ".join(f"q{k}" for k in range(15))),
         (903, "here are TWO tokens.")], "doc_id bigint, text string"))
    got = {(r.doc_id, r.item_id, r.n_tiles) for r in tiling.leaks(table, bench).collect()}
    assert got == {(900, 7, 1), (900, 10, 1), (901, 7, 2), (901, 10, 2), (903, 9, 1)}
    small = tiling.Tiling(block_chars=200)
    assert {(r.doc_id, r.item_id, r.n_tiles) for r in tiling.leaks(table, bench, small).collect()} == got
    clean = tiling.without_leaks(table, bench, small)
    assert clean.count() == table.count() - 3
    assert tiling.leaks(empty, bench).collect() == [] == tiling.leaks(docs, bench.limit(0)).collect()
    assert tiling.without_leaks(repeated, bench).count() == 6


# --- mixing, rules, chat ---------------------------------------------------------------

def test_mix_meets_its_targets(docs, rows):
    out = mixing.plan_mix(docs).collect()
    source = {r.doc_id: r.source for r in out}
    sizes, taken = {}, {}
    for r in out:
        assert r["size"] == len(brute.WORD.findall(dict(rows)[r.doc_id] or "")) and r.taken <= 2 * r["size"]
        sizes[r.source] = sizes.get(r.source, 0) + r["size"]
        taken[r.source] = taken.get(r.source, 0) + r.taken
    want = brute.targets(sizes)
    for r in out:
        assert r.target == pytest.approx(want[r.source])
    assert all(abs(taken[s] - want[s]) <= 1 for s in sizes)
    again = {r.doc_id: r.taken for r in mixing.plan_mix(docs.repartition(3)).collect()}
    assert again == {r.doc_id: r.taken for r in out} and len(source) == len(rows)


def test_many_sources_in_closed_form(spark, monkeypatch):
    rng = random.Random(3)
    sizes = {f"s{k:05d}": rng.choice([0, 1, 5, 40, 1000, 10**6, 10**9]) * rng.randint(1, 9) for k in range(20_000)}
    sizes[None] = 77
    # the plain way fills up a round at a time
    want = brute.targets(sizes)
    table = spark.createDataFrame(list(sizes.items()), "source string, size bigint").repartition(7)
    for few in (100_000, 10):
        monkeypatch.setattr(mixing, "FEW_SOURCES", few)
        got = {r.source: r.target for r in mixing.source_targets(table).collect()}
        assert got.keys() == want.keys()
        assert all(got[s] == pytest.approx(want[s], rel=1e-9) for s in want)
    assert sum(got.values()) == pytest.approx(1.5 * sum(sizes.values()))
    one = mixing.source_targets(spark.createDataFrame([("a", 1000), ("b", 10)], "source string, size bigint"))
    assert {r.source: r.target for r in one.collect()} == {"a": 1495.0, "b": 20.0}


def test_rows_that_share_an_id_meet_their_own_plan(spark):
    rows = [(1, f"w{k} " * 3, "s", k) for k in range(40)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string, tag int")
    out = mixing.training_order(df).collect()
    again = mixing.training_order(df.repartition(5)).collect()
    key = lambda r: (r.text, r.taken, r.position, r.tag)
    assert sorted(map(key, out)) == sorted(map(key, again)) and out[0].asDict().keys() >= {"tag", "taken"}


def test_positions_follow_the_schedule(spark):
    """Half of the integral of the weights is used where the curve says so."""
    shares = spark.createDataFrame([(k / 20,) for k in range(21)], "u double")
    for knots in ((1.5, 1.0, 0.5), (1.0, 1.0, 1.0), (0.0, 1.0, 4.0)):
        due = mixing.due_time(F.col("u"), F.array(*[F.lit(k) for k in knots]))
        for r in shares.select("u", due.alias("t")).collect():
            pieces = len(knots) - 1
            area = lambda t: sum(
                (min(max(t * pieces - k, 0), 1) * knots[k]
                 + (knots[k + 1] - knots[k]) * min(max(t * pieces - k, 0), 1) ** 2 / 2) for k in range(pieces))
            assert area(r.t) / area(1) == pytest.approx(r.u, abs=1e-9)


def test_training_order_holds_every_copy(docs, empty, repeated):
    out = mixing.training_order(docs).collect()
    places = [r.position for r in out]
    assert places == sorted(places) and all(0 <= p <= 1 for p in places)
    plan = {r.doc_id: r.taken for r in mixing.plan_mix(docs).collect()}
    got = {}
    for r in out:
        got[r.doc_id] = got.get(r.doc_id, 0) + r.taken
    assert got == {d: n for d, n in plan.items() if n}
    assert mixing.training_order(empty).collect() == []
    want = sum(r.taken for r in mixing.plan_mix(repeated).collect())
    assert sum(r.taken for r in mixing.training_order(repeated).collect()) == want > 0


def test_digests_are_read_off_the_training_order(docs, empty, repeated, monkeypatch):
    for table in (docs, repeated, empty):
        plan = mixing.plan_mix(table).collect()
        row = lambda r, p: (r.doc_id, r["size"], r.source_size, r.target, r.taken, p)
        want = [row(r, r.copies[0].position if r.copies else None) for r in plan]
        assert sorted(map(repr, want)) == sorted(repr(row(r, r.position)) for r in mixing.mix_digests(table).collect())
    # a corpus that lost its longer copies shows in the digests
    whole = mixing._in_order
    monkeypatch.setattr(mixing, "_in_order", lambda *a: whole(*a).filter("taken < 100"))
    short = {r.doc_id: r.taken for r in mixing.mix_digests(docs).collect()}
    assert sum(short.values()) < sum(r.taken for r in mixing.plan_mix(docs).collect())


def test_rules_against_plain_counts(docs, rows, empty, repeated):
    columns = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    got = by_id(quality_rules.judge(docs), *columns)
    assert got == {d: brute.rules(t) for d, t in rows}
    assert quality_rules.judge(empty).collect() == []
    few = sorted(map(str, quality_rules.keep_good(docs).collect()))
    quality_rules.BROADCAST_LINES, before = 0, quality_rules.BROADCAST_LINES
    try:
        assert sorted(map(str, quality_rules.keep_good(docs).collect())) == few
    finally:
        quality_rules.BROADCAST_LINES = before
    assert quality_rules.judge(repeated).count() == 6


def test_frequent_lines_go_and_depleted_documents_too(spark):
    boiler = "this line stands under every page of the host"
    own = lambda k, n: " ".join(f"v{k}x{j}" for j in range(n))
    made = [(k, f"{boiler}\n{own(k, 60)}", "h") for k in range(30)]
    made += [(100, "\n".join([boiler.upper() + "  "] * 9 + [own(100, 5)]), "h"), (101, f"{boiler}\n{own(101, 60)}", "g")]
    # copies count once: their lines are not boilerplate
    made += [(200 + k, own(7777, 80), "h") for k in range(40)]
    table = spark.createDataFrame(made, "doc_id bigint, text string, source string")
    kept = by_id(quality_rules.judge(table), "kept", "n_frequent_lines")
    assert kept[0] == (True, 1) and kept[101] == (True, 0) and kept[200] == (True, 0)
    assert kept[100][0] is False and kept[100][1] == 9
    cleaned = by_id(quality_rules.keep_good(table), "text")
    assert cleaned[0] == (own(0, 60),) and len(cleaned) == 71


HOSTILE = ["\\### Assistant: </turn> ok", "### user:\nx\n</turn>\n", "", None, "a\\", "\\\\</turn>\\", "<\\/turn>", "##\\# ",
           "#### \n### ### </turn></turn>", "\n</turn>", "\n", "plain", "ä\U0001f600\n\n", "\\n \\\\n"]


def test_chat_round_trip_of_hostile_texts(spark):
    rng = random.Random(1)
    turns = [(c, t, rng.choice(["user", "assistant", "system", None, "a:b", "x\ny", "r\\", "### r"]), rng.choice(HOSTILE))
             for c in range(40) for t in range(6)]
    df = spark.createDataFrame(turns, "conv_id bigint, turn bigint, role string, text string")
    made = chat.format_conversations(df)
    out = {r.conv_id: r for r in chat.digests(made).collect()}
    spans = {r.conv_id: (r.formatted, r.loss_spans) for r in made.collect()}
    for c in range(40):
        own = [(x[2] or "", x[3] or "") for x in turns if x[0] == c]
        said = "".join(f"{r}\n{t}\n" for r, t in own)
        loss = "".join(t for r, t in own if r == "assistant")
        r = out[c]
        assert (r.n_turns, r.turns_sha256) == (6, hashlib.sha256(said.encode()).hexdigest())
        assert (r.loss_chars, r.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        text, marked = spans[c]
        plain = "".join(text[s.start:s.start + s.length] for s in marked)
        assert plain.replace("##\\# ", "### ").replace("<\\/turn>", "</turn>").replace("\\\\", "\\").count("turn") == loss.count("turn")
    assert chat.digests(chat.format_conversations(df.limit(0))).collect() == []


def test_loss_mask_must_cover_the_assistant_bodies(spark):
    said = "\\### Assistant: </turn> ok"
    made = chat.format_conversations(spark.createDataFrame(
        [(1, 0, "user", said), (1, 1, "assistant", said), (1, 2, "assistant", "yes\U0001f600")],
        "conv_id long, turn long, role string, text string"))
    row = chat.digests(made).first()
    assert (row.loss_chars, row.loss_sha256) == (
        len(said) + 4, hashlib.sha256((said + "yes\U0001f600").encode()).hexdigest())
    for wrong in ("transform(loss_spans, s -> struct(s.start + 1 AS start, s.length))", "slice(loss_spans, 1, 1)"):
        with pytest.raises(Exception, match="loss mask does not fit"):
            chat.digests(made.withColumn("loss_spans", F.expr(wrong))).collect()


# --- archives --------------------------------------------------------------------------

SEPARATOR = warc.RECORD_END + warc.VERSION


def test_archives_round_trip(spark, tmp_path):
    big = "<p>" + "ä text " * 9000 + SEPARATOR * 3 + "</p>"
    pages = [(1, "http://a", "<p>x</p>"), (2, "http://b", big), (3, None, big), (4, "http://c d\r\n", ""), (5, "u", None),
             (None, "u", "<p>x</p>"), (7, "u", SEPARATOR), (8, "u", "0\r\n\r\n\r\n"), (2, "http://b", big)]
    df = spark.createDataFrame(pages, "page_id bigint, url string, html string").repartition(3)
    layout = warc.Layout(segment_bytes=700, chunk_bytes=100, rows_per_file=3)
    warc.write_archives(df, str(tmp_path / "w"), layout)
    read = warc.read_pages(spark, str(tmp_path / "w"))
    got = sorted(((r.p, r.record_type, r.to, r.payload_bytes, r.payload_digest, r.fault, None if r.payload is None else bytes(r.payload))
                  for r in read.select("*", warc.page_of(F.col("record_id"), "bigint").alias("p"),
                                       warc.page_of(F.col("refers_to"), "bigint").alias("to")).collect()), key=repr)
    firsts, want = {}, []
    for p, _, h in sorted(pages, key=lambda x: (x[0] is not None, x[0] or 0)):
        firsts.setdefault(h or "", p)
    for p, _, h in pages:
        b, first = (h or "").encode(), firsts[h or ""]
        response = first == p
        want.append((p, "response" if response else "revisit", None if response else first, len(b), warc.digest_of(b),
                     None, b if response else None))
    assert got == sorted(want, key=repr)
    import gzip
    files = list((tmp_path / "w").glob("*.gz"))
    assert len(files) > 1
    for f in files:
        data = gzip.decompress(f.read_bytes())
        assert data.startswith(b"WARC/1.1\r\nWARC-Type: ") and data.endswith(b"\r\n\r\n")
    kinds = {r.kind for r in warc.read_records(spark, str(tmp_path / "w")).collect()}
    assert kinds == {"response", "revisit", "continuation"}
    warc.write_archives(df.limit(0), str(tmp_path / "none"))
    assert warc.read_pages(spark, str(tmp_path / "none")).collect() == []


def test_broken_archives_are_reported(spark, tmp_path):
    layout = warc.Layout(segment_bytes=50, chunk_bytes=20)
    whole = [r.decode() for r in warc.records("1:0-1", "u", b"y" * 300, None, False, layout)]
    cut = [whole[0], *whole[2:]]
    bad = warc.records("2:0-1", "u", b"z" * 30, None, False, warc.Layout())[0].decode().replace("zz", "zy", 1)
    spark.createDataFrame([(x,) for x in [*cut, bad]], "value string").coalesce(1).write.option(
        "lineSep", warc.RECORD_END).text(str(tmp_path / "w"))
    faults = {r.record_id: r.fault for r in warc.read_pages(spark, str(tmp_path / "w")).collect()}
    assert faults == {"<urn:x-page:1:0-1>": "segments missing or of wrong length", "<urn:x-page:2:0-1>": "wrong digest"}


def by_hand(version, kind, name, block, *more, end=b"\r\n\r\n"):
    head = [f"WARC/{version}", f"WARC-Type: {kind}", f"warc-record-id: <{name}>", *more, f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + end


def test_archives_of_other_writers(spark, tmp_path):
    import gzip

    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\n"
    tricky = b"a\r\n\r\nWARC/1.0\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nxyz\r\n"
    one = by_hand("1.0", "warcinfo", "i", b"software: x\r\n") + by_hand("1.0", "response", "a", http + tricky) + by_hand(
        "1.0", "request", "q", b"GET / HTTP/1.0\r\n\r\n") + by_hand("1.0", "response", "b", http + b"\r", "WARC-Payload-Digest: md5:1") + by_hand(
        "1.0", "resource", "c", b"")
    two = (by_hand("1.1", "response", "d", http + b"no line ends behind it", end=b"")
           + by_hand("1.1", "response", "e", http + b"z", "WARC-Payload-Digest: sha1:AAAA", "X-Folded: one", " two"))
    junk = by_hand("1.1", "response", "f", http + b"f") + b"junk\r\nmore junk\r\n" + by_hand("1.1", "response", "g", http + b"g")
    cut = by_hand("1.1", "response", "h", http + b"h") + by_hand("1.1", "response", "k", http + b"long " * 40)[:-60]
    bare = b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <l>\r\n\r\n" + by_hand("1.1", "response", "m", http + b"m")
    folder = tmp_path / "w"
    folder.mkdir()
    (folder / "one.warc").write_bytes(one)
    (folder / "two.warc.gz").write_bytes(b"".join(gzip.compress(x) for x in (two[:50], two[50:])))
    for name, data in (("junk", junk), ("cut", cut), ("bare", bare)):
        (folder / f"{name}.warc.gz").write_bytes(gzip.compress(data))
    (folder / "torn.warc.gz").write_bytes(gzip.compress(
        by_hand("1.1", "response", "n", http + random.Random(1).randbytes(90_000)) * 3, 1)[:-20_000])
    got = sorted(((r.record_id, r.fault, r.payload and bytes(r.payload) or r.payload) for r in warc.read_pages(spark, str(folder)).collect()
                  if r.record_id != "<n>" and r.record_id != "<k>"), key=repr)
    assert got == sorted([
        ("<a>", None, tricky), ("<b>", None, b"\r"), ("<c>", None, b""), ("<d>", None, b"no line ends behind it"),
        ("<e>", "wrong digest", b"z"), ("<f>", None, b"f"), ("<g>", None, b"g"), ("<h>", None, b"h"), ("<m>", None, b"m"),
        ("<l>", "no length", b"")] + [g for g in got if g[1] == "not a record"], key=repr)
    faults = [r.fault for r in warc.read_pages(spark, str(folder)).collect()]
    assert faults.count("not a record") == 1 and faults.count("cut off") >= 2
    torn = [r.fault for r in warc.read_pages(spark, str(folder)).collect() if r.record_id == "<n>"]
    assert torn.count(None) >= 1 and torn.count("cut off") == 1


# --- models ----------------------------------------------------------------------------

def labelled(spark, label, good, bad, n=240):
    rng = random.Random(8)
    made, marks = [], []
    for k in range(n):
        y = int(rng.random() < 0.4)
        made.append((k, (bad if y else good)(rng), "en", "s"))
        marks.append((k, y))
    marks += [(3, None), (None, 1), (n + 5, 1)]
    made += [(n, "", "en", "s"), (n + 1, None, "en", "s")]
    return (spark.createDataFrame(made, "doc_id bigint, text string, lang string, source string"),
            spark.createDataFrame(marks, f"doc_id bigint, {label} int"), dict(marks))


WORDS = ["alder", "birch", "cedar", "fir", "hazel", "larch", "maple", "oak", "pine", "rowan", "willow", "yew"]


def held_out_accuracy(out, marks):
    rows = [r for r in out if r.held_out and marks.get(r.doc_id) is not None]
    assert all(0 <= r.score <= 1 for r in out) and len(rows) > 20
    return sum(r.predicted == marks[r.doc_id] for r in rows) / len(rows)


def test_quality_model_on_held_out_rows(spark):
    plain = lambda rng: " ".join(rng.choice(WORDS) for _ in range(60))
    docs, labels, marks = labelled(spark, "quality", lambda rng: "$$$ ".join(plain(rng).upper().split()), plain)
    out = quality_model.quality_scores(docs, labels, quality_model.remainder(3, 1)).collect()
    assert len(out) == 242 and held_out_accuracy(out, marks) >= 0.95
    none = quality_model.quality_scores(docs, labels.limit(0), quality_model.remainder(3, 1)).collect()
    assert {r.score for r in none} == {0.5}
    assert quality_model.quality_scores(docs.limit(0), labels, quality_model.remainder(3, 1)).collect() == []


def hidden(rng):
    word = rng.choice(["gorbok", "plimster"])
    form = rng.choice([lambda w: w, lambda w: w.replace("o", "0").replace("l", "1"), lambda w: " ".join(w),
                       lambda w: w[:3] + w[2] * 4 + w[3:], lambda w: ".".join(w)])
    w = [rng.choice(WORDS) for _ in range(40)]
    w.insert(rng.randrange(40), form(word))
    return " ".join(w)


def test_toxicity_finds_hidden_words(spark):
    clean = lambda rng: " ".join(rng.choice(WORDS) for _ in range(40))
    docs, labels, marks = labelled(spark, "toxic", clean, hidden, 400)
    # the words are known to the language model from plain use
    docs = docs.unionByName(spark.createDataFrame(
        [(9000 + k, "gorbok plimster " * 9, "en", "s") for k in range(5)], docs.schema))
    out = toxicity.toxicity_scores(docs, labels, quality_model.remainder(5, 0)).collect()
    assert held_out_accuracy(out, marks) >= 0.9
    assert toxicity.toxicity_scores(docs.limit(0), labels, quality_model.remainder(5, 0)).collect() == []
    none = toxicity.toxicity_scores(docs, labels.limit(0), quality_model.remainder(5, 0)).collect()
    assert {r.score for r in none} == {0.0}


def every_path(decoder, span):
    """The least cost over all paths of the lattice."""
    def go(k, last):
        if k == len(span):
            return decoder.end(last)
        out = []
        for letter, paid in decoder.edges(span, k):
            taken = decoder.step(last, letter)
            if taken is not None:
                out.append(paid + taken[0] + go(k + 1, taken[1]))
        return min(out)

    return go(0, "^^")


def model_of(words):
    counts = np.zeros((2, 1 << 12), np.float32)
    for word in words:
        marked = f"^^{word}$"
        for k in range(len(marked) - 2):
            counts[0, toxicity._slot(marked[k:k + 3], 1 << 12)] += 20
            counts[1, toxicity._slot(marked[k:k + 2] + "?", 1 << 12)] += 20
    return toxicity.Decoder(counts)


def test_decoder_finds_the_cheapest_path():
    decoder = model_of(["stupid", "idiot", "hello", "that", "loser", "is", "an"])
    rng = random.Random(6)
    for _ in range(150):
        span = "".join(rng.choice("stupidaao01$.-" + toxicity.WIDE) for _ in range(rng.randint(1, 9)))
        cost, letters = decoder.decode(span)
        assert cost == pytest.approx(every_path(decoder, span)) and "  " not in letters
    noisy = {"1d10t": "idiot", "s.t.u.p.i.d": "stupid", "looooser": "loser", "stup1d": "stupid"}
    assert {k: decoder.restore(k) for k in noisy} == noisy
    assert "loser" in decoder.words("lo$er") and "stupid" in decoder.words("stup!d") and "hello" in decoder.words("hello!")
    assert "is" in decoder.words("i$") and "is" in decoder.words("i5")
    assert list(decoder.spaced("say i d i o t now")) == ["idiot"] == list(decoder.spaced("say i  d  i  o  t now"))
    assert list(decoder.spaced("t h a t  i s  a n  i d i o t")) == ["that", "is", "an", "idiot"]


def test_long_spans_are_decoded_as_a_whole():
    words = ["stupid", "idiot", "hello", "that", "loser"]
    decoder = model_of(words)
    rng = random.Random(2)
    for _ in range(20):
        said = [rng.choice(words) for _ in range(40)]
        span = toxicity.WIDE.join(".".join(w).replace("i", "1").replace("o", "0") for w in said)
        assert len(span) > 300 and decoder.decode(span)[1].split() == said
    assert len(decoder.decode("a.b" * 20_000)[1]) > 20_000
