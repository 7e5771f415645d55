"""Registered queries and the pipeline: contracts, and brute force on the smallest tables."""

import zlib

import pytest

import __spark_entry__ as entry_points
import corpus_pipeline
from slumptrace.llm.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_secrets": "doc_id n_assign n_access n_hex base_sha256 spans",
    "op2_brown": "doc_id held_out n_tokens n_known train_tokens base_score score",
    "op3_reshard": "doc_id size text_crc32 law shard slot grown_shard",
    "op5_url_aliases": "page_id host path rule verdict",
    "op6_jaccard": "doc_id n_shingles component_id",
    "op7_toxicity": "doc_id held_out score predicted",
    "op9_packing": "doc_id piece start length ids_crc32 sequence_id offset",
    "op10_vectors": "vec_id n_links component_id kept",
    "op11_sentencepieces": "doc_id n_tokens ids_sha256 decoded_sha256",
    "op12_whitening": "vec_id component n deviation whitened explained identity_error",
}


def test_registration():
    assert set(QUERIES) | {"pipeline"} <= set(entry_points.queries())
    assert {n.split("_")[0] for n in QUERIES} == {f"op{k}" for k in range(1, 14)}
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", COLUMNS)
def test_columns_and_rows(spark, name):
    df = QUERIES[name](spark, FOLDER)
    assert set(COLUMNS[name].split()) <= set(df.columns)
    key = {"op5": "page_id", "op10": "vec_id", "op12": "vec_id"}.get(name.split("_")[0], "doc_id")
    source = {"page_id": "pages", "vec_id": "embeddings", "doc_id": "documents"}[key]
    ids = sorted(r[0] for r in df.select(key).distinct().collect())
    assert ids == sorted(r[0] for r in spark.read.parquet(f"{FOLDER}/{source}.parquet").select(key).collect())


@pytest.mark.parametrize("name", ORACLES)
def test_sql(spark, name):
    import duckdb

    oracle = duckdb.connect()
    for view in ("documents", "benchmark", "pages", "labels", "embeddings"):
        oracle.execute(f"CREATE VIEW {view} AS SELECT * FROM '{FOLDER}/{view}.parquet'")
    found = oracle.execute(ORACLES[name])
    names = [d[0] for d in found.description]
    rows = QUERIES[name](spark, FOLDER).select(*names).collect()
    plain = lambda part: sorted(repr([round(x, 9) if isinstance(x, float) else x for x in r]) for r in part)
    assert plain(map(tuple, rows)) == plain(found.fetchall())


def test_pipeline(spark):
    """Each stage against what its operator's own tests hold right, on the rows of the stage before."""
    from slumptrace.llm.decontam import overlaps
    from slumptrace.llm.jaccard import near_copies
    from slumptrace.llm.secrets import scan, train
    from slumptrace.llm.toxicity import THRESHOLD, score
    from slumptrace.llm.toxicity import train as train_toxicity

    staging = corpus_pipeline.Staging(spark, "test")
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns = docs.columns
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        made = staging.keep(stage(spark, docs, FOLDER), name.replace(" ", "-"))
        before, after = {r.doc_id: r for r in docs.collect()}, made.collect()
        if k < 4:
            assert made.columns == columns
            after = {r.doc_id: r for r in after}
            assert len(after) == made.count() and set(after) <= set(before)
        if name == "toxicity":
            model = train_toxicity(docs, spark.read.parquet(f"{FOLDER}/labels.parquet"))
            assert set(after) == {r.doc_id for r in score(docs, model).collect() if r.score < THRESHOLD}
        elif name == "near copies":
            copies = near_copies(docs, n=corpus_pipeline.COPY_WORDS, percent=corpus_pipeline.COPY_PERCENT)
            assert (corpus_pipeline.COPY_WORDS, corpus_pipeline.COPY_PERCENT) == (5, 80)
            assert set(after) == {r.component_id for r in copies.collect()}
        elif name == "benchmark decontamination":
            dirty = {r.doc_id for r in overlaps(docs, spark.read.parquet(f"{FOLDER}/benchmark.parquet")).collect()}
            assert set(after) == set(before) - dirty
        elif name == "secret scan":
            spans = {r.doc_id: r.spans for r in scan(docs, train(docs)).collect()}
            assert set(after) == set(before)
            assert {i for i in after if after[i].text != before[i].text} == {i for i, s in spans.items() if s}
            assert all(r.n_chars == len(r.text) for r in after.values())
        else:
            assert {r.doc_id for r in after} == set(before)
            assert max(r.offset + r.length for r in after) <= 2048
        docs = made
    assert corpus_pipeline.run(spark, FOLDER).count() == docs.count()


def test_pipeline_on_odd_rows(spark, documents):
    """Null, empty, very long and repeated rows, null ids and columns of names that are used inside, through all stages."""
    base = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon phi chi psi omega"
    rows = [(1, None), (2, ""), (None, None), (None, base), (3, base), (3, base), (4, base + " end"), (5, "token = abcdef0123456789abcdef01 here"),
            (6, " ".join(f"w{k}" for k in range(30_000))), (7, "one"), (7, "another text under the same id")]
    docs = documents(*rows)
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, FOLDER)
        assert docs.columns == columns, name
    left = sorted((str(r.doc_id), r.text or "") for r in docs.collect())
    assert ("5", "[SECRET] here") in left
    assert [i for i, t in left if t.startswith("alpha")] == ["3"]
    assert {i for i, _ in left} == {"1", "2", "None", "3", "5", "6", "7"} and len([1 for i, _ in left if i == "7"]) == 2
    packed = corpus_pipeline.packing(spark, docs, FOLDER).collect()
    assert {str(r.doc_id) for r in packed} == {i for i, _ in left}
    assert all(r.offset + r.length <= 2048 for r in packed)


def test_held_out_rows_follow_the_checksum(spark):
    rows = QUERIES["op7_toxicity"](spark, FOLDER).select("doc_id", "held_out").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
