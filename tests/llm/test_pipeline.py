"""The pipeline's stages against plain restatements of what each must keep."""

import pytest
from pyspark.sql import functions as F

corpus_pipeline = pytest.importorskip("corpus_pipeline")

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Every stage's result, written and read again."""
    base, docs = tmp_path_factory.mktemp("pipeline"), spark.read.parquet(f"{SF}/documents.parquet")
    out = [("documents", docs)]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(str(base / name))
        docs = spark.read.parquet(str(base / name))
        out.append((name, docs))
    return dict(out)


def test_stages_and_columns(tables):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "line_dedup", "near_dedup", "mixing", "packing"]
    for name in ("quality", "line_dedup", "near_dedup", "mixing"):
        assert tables[name].columns == tables["documents"].columns
        assert dict(tables[name].dtypes) == dict(tables["documents"].dtypes)


def test_quality_keeps_good_documents_only(tables, spark):
    lab = spark.read.parquet(f"{SF}/labels.parquet")
    kept = {r["doc_id"] for r in tables["quality"].select("doc_id").collect()}
    rows = lab.collect()
    assert all((r["doc_id"] in kept) == (r["quality"] == 1) for r in rows)


def test_line_dedup_against_brute_force(tables):
    from tests.llm.test_linededup import _brute
    before = [(r["doc_id"], r["text"]) for r in tables["quality"].collect()]
    want = {i: t for i, t in _brute(before)[0].items() if t is None or t.strip(" ") or t == dict(before)[i]}
    after = {r["doc_id"]: r for r in tables["line_dedup"].collect()}
    assert {i: r["text"] for i, r in after.items()} == want
    assert all(r["n_chars"] == len(r["text"]) for r in after.values())


def test_near_dedup_keeps_the_least_of_every_group(tables):
    from tests.llm.helpers import components
    from tests.llm.test_jaccardjoin import _set
    rows = {r["doc_id"]: _set(r["text"], 5) for r in tables["line_dedup"].collect()}
    links = [(a, b) for a in rows for b in rows if a < b and rows[a] and rows[b]
             and 100 * len(rows[a] & rows[b]) >= 80 * len(rows[a] | rows[b])]
    comp = components(list(rows), links)
    assert {r["doc_id"] for r in tables["near_dedup"].collect()} == {i for i in rows if comp[i] == i}


def test_mixing_repeats_within_bounds_and_packing_covers_all(tables):
    from corpusforge.llm.mixing import source_targets, word_count
    before = tables["near_dedup"].withColumn("size", word_count(F.col("text")))
    after = tables["mixing"].withColumn("size", word_count(F.col("text")))
    times = {r["doc_id"]: r["count"] for r in after.groupBy("doc_id").count().collect()}
    assert set(times.values()) <= {1, 2} and set(times) <= {r["doc_id"] for r in before.collect()}
    sizes = {r["source"]: r["s"] for r in before.groupBy("source").agg(F.sum("size").alias("s")).collect()}
    taken = {r["source"]: r["s"] for r in after.groupBy("source").agg(F.sum("size").alias("s")).collect()}
    target = source_targets(sizes)
    assert sum(taken.values()) == pytest.approx(sum(target.values()), rel=0.05)
    packed = tables["packing"].where("last").groupBy("doc_id").count().collect()
    assert {r["doc_id"]: r["count"] for r in packed} == times


def test_run_gives_the_last_stage(tables, spark):
    got = corpus_pipeline.run(spark, SF)
    key = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    assert sorted(map(tuple, got.select(*key).collect())) == sorted(map(tuple, tables["packing"].select(*key).collect()))
    assert corpus_pipeline.ORACLE_SQL is None


def test_near_dedup_keeps_one_row_of_repeated_null_and_colliding_ids(spark):
    from tests.llm.helpers import docs_of
    text = [" ".join(f"w{t}x{i}" for i in range(40)) for t in range(8)]
    near = text[2] + " more"                                      # 36 of 37 shingles
    rows = [(1, text[0], "s"), (1, text[0], "s"), (1, text[0], "r"),             # a file read twice
            (None, text[1], "s"), (None, text[1], "s"),                         # null ids only
            (4, text[2], "s"), (None, near, "s"),                               # a null copy of a numbered one
            (5, text[3], "s"), (9, text[3] + " more", "s"), (9, text[4], "s"),     # 9 names a copy and a clean text
            (7, text[5], "s"), (7, text[5] + " more", "s"),                       # near texts of one id
            (None, text[6], "s"), (None, text[6] + " more", "s"),
            (11, "", "s"), (12, "", "s"), (12, "", "s"), (13, None, "s"), (None, None, "s")]
    docs = docs_of(spark, rows, ", source string").repartition(3)
    got = [tuple(r) for r in corpus_pipeline.near_dedup(spark, docs, SF).collect()]
    least = lambda t: min([t, t + " more"], key=lambda x: spark.sql("select xxhash64(?)", args=[x]).head()[0])
    want = [(1, text[0], "r"), (None, text[1], "s"), (4, text[2], "s"), (5, text[3], "s"), (9, text[4], "s"),
            (7, least(text[5]), "s"), (None, least(text[6]), "s"),
            (11, "", "s"), (12, "", "s"), (13, None, "s"), (None, None, "s")]
    assert sorted(got, key=str) == sorted(want, key=str)
