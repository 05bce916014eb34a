from zlib import crc32

import brute
import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
import corpus_pipeline
from compare import rows_of
from goldweave.llm import mixing, queries, sql

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(sql.statements()))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "conversations", "pages", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    df = queries.registered()[name](spark, FOLDER)
    cursor = con.execute(sql.statements()[name])
    want = rows_of([d[0] for d in cursor.description], cursor.fetchall())
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == want


def test_one_query_for_each_operator():
    names = {n.split("_")[0] for n in queries.registered()}
    assert names == {f"op{n}" for n in range(1, 14)}
    assert "pipeline" in contract.queries()
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality rules", "MinHash near-dedup", "substring dedup", "benchmark decontamination", "mixing"]


COLUMNS = {
    "op2_minhash_near_dedup": "doc_id bigint, n_shingles bigint, component_id bigint, kept boolean",
    "op3_suffix_array_dedup": "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string",
    "op4_warc_segments": "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint",
    "op5_quality_classifier": "doc_id bigint, held_out boolean, score double, predicted int",
    "op6_substring_dedup": "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string",
    "op7_benchmark_decontamination": "doc_id bigint, item_id bigint, contaminated boolean",
    "op9_toxicity": "doc_id bigint, held_out boolean, score double, predicted int",
}


@pytest.fixture(scope="module")
def texts(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_queries_without_sql(spark, texts, name):
    df = queries.registered()[name](spark, FOLDER)
    kinds = dict(df.dtypes)
    wanted = dict(c.split(" ") for c in COLUMNS[name].split(", "))
    assert {c: kinds.get(c) for c in wanted} == wanted
    rows = df.collect()
    got = lambda *columns: {r.doc_id: tuple(r[c] for c in columns) for r in rows}
    if name.startswith("op2_"):
        want = brute.near_components(texts)
        assert got("n_shingles", "component_id", "kept") == {d: (*v, v[1] == d) for d, v in want.items()}
    elif name.startswith("op3_"):
        assert got("n_bytes", "n_removed", "n_spans", "kept_sha256") == brute.repeated_bytes(texts)
    elif name.startswith("op6_"):
        want = brute.repeated_runs(texts)
        assert got("n_removed", "n_spans", "n_units") == {
            d: (len((t or "").encode()) - len(want[d][0].encode()), len(want[d][1]), want[d][2]) for d, t in texts}
    elif name.startswith(("op5_", "op9_")):
        keep, left = (3, 1) if name.startswith("op5_") else (5, 0)
        assert got("held_out") == {d: (crc32(str(d).encode()) % keep == left,) for d, _ in texts}
        assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    elif name.startswith("op7_"):
        items = {r.item_id: r.text for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()}
        want = {(d, i) for d, t in texts for i, b in items.items()
                if (c := brute.greedy_cover(t or "", b)) and 2 * c[0] >= c[1] > 4}
        assert {(r.doc_id, r.item_id) for r in rows} == want


def test_whole_pipeline(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    out = corpus_pipeline.run(spark, FOLDER)
    assert set(docs.columns) <= set(out.columns) and {"taken", "position", "target"} <= set(out.columns)
    rows = out.collect()
    assert rows and {r.doc_id for r in rows} <= {r.doc_id for r in docs.collect()}
    assert all(0 <= r.position <= 1 and 0 < r.taken <= r["size"] for r in rows)


def test_pipeline_of_an_empty_and_an_odd_table(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    odd = docs.limit(3).unionByName(docs.limit(3)).withColumns(
        {"id": F.lit("clash"), "kept": F.lit(None).cast("string"), "row": F.lit(1), "size": F.lit(2)})
    nulls = spark.createDataFrame([(None, None, None, None, None, "x", "y", 1, 2)], odd.schema)
    for k, table in enumerate((odd.limit(0), odd.unionByName(nulls))):
        folder = f"{tmp_path}/{k}"
        table.write.parquet(f"{folder}/documents.parquet")
        spark.read.parquet(f"{FOLDER}/benchmark.parquet").write.parquet(f"{folder}/benchmark.parquet")
        out = corpus_pipeline.run(spark, folder)
        assert set(table.columns) <= set(out.columns) and out.count() >= 0


def test_pipeline_against_plain_versions(spark):
    """Each stage on all that the one before it kept, held against brute force."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    bench = [r.text for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    texts = lambda df: {r.doc_id: r.text for r in df.collect()}
    stages = dict(corpus_pipeline.STAGES)
    first = stages["quality rules"](spark, docs, FOLDER).cache()
    facts = {r.doc_id: brute.rules(r.text) for r in docs.collect()}
    good = {d for d, f in facts.items() if f[0] >= 50 and 2 * f[4] <= f[0]}
    kept = texts(first)
    assert first.columns == docs.columns and set(kept) <= good and len(kept) >= 0.9 * len(good)
    second = stages["MinHash near-dedup"](spark, first, FOLDER).cache()
    groups = brute.near_components(list(kept.items()))
    assert set(texts(second)) == {d for d, g in groups.items() if g[1] == d}
    third = stages["substring dedup"](spark, second, FOLDER).cache()
    assert texts(third) == {d: v[0] for d, v in brute.repeated_runs(list(texts(second).items())).items()}
    fourth = stages["benchmark decontamination"](spark, third, FOLDER).cache()
    leaks = {d for d, t in texts(third).items() for b in bench if (c := brute.greedy_cover(t, b)) and 2 * c[0] >= c[1] > 4}
    assert set(texts(fourth)) == set(texts(third)) - leaks
    assert third.columns == fourth.columns == docs.columns
    taken, sizes = {}, {}
    for r in stages["mixing"](spark, fourth, FOLDER).collect():
        taken[r.source] = taken.get(r.source, 0) + r.taken
    for r in fourth.collect():
        sizes[r.source] = sizes.get(r.source, 0) + len(brute.WORD.findall(r.text))
    want = brute.targets(sizes)
    assert all(abs(taken[s] - want[s]) <= 1 for s in want)


def test_op8_goes_through_the_training_order(spark, monkeypatch):
    """The curriculum's order is made for every copy, not planned only."""
    made, whole = [], mixing._in_order
    monkeypatch.setattr(mixing, "_in_order", lambda *a: made.append(whole(*a)) or made[-1])
    got = queries.registered()["op8_source_mixing"](spark, FOLDER).agg(F.sum("taken")).first()[0]
    rows = made[0].select("taken", "position").collect()
    assert sum(r.taken for r in rows) == got and rows == sorted(rows, key=lambda r: r.position)
