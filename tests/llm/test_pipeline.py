"""The pipeline stage by stage, each held against what its operator says of its input."""

import zlib

import pytest

pytest.importorskip("public_tokenizers")

import corpus_pipeline  # noqa: E402
from evidar.llm import language_id, mixing, similar  # noqa: E402
from evidar.llm.common import written  # noqa: E402


@pytest.fixture(scope="module")
def stages(spark):
    given = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    first = given.first()
    more = [(9001, "123 456", "en", "src0", 7), (9002, None, None, None, None), (9003, first.text + " more", first.lang, first.source, 1), (9004, first.text.replace(" ", "\n"), first.lang, first.source, 1)]
    out = [written(given.unionByName(spark.createDataFrame(more, given.schema)), "given")]
    for name, stage in corpus_pipeline.STAGES:
        out.append(written(stage(spark, out[-1], ""), "stage"))
    return out


def test_stages(stages):
    given, language, exact, near, mixed, packed = [s.collect() for s in stages]
    assert all(s.columns == stages[0].columns for s in stages[1:5])
    assert {r.doc_id for r in given} - {r.doc_id for r in language} == {9001, 9002}
    kept = {}
    for r in sorted(language, key=lambda r: r.doc_id):
        kept.setdefault(" ".join(r.text.split()), r.doc_id)
    assert {r.doc_id for r in exact} == set(kept.values()) and 9004 not in kept.values()
    rows = sorted(exact, key=lambda r: r.doc_id)
    root = {r.doc_id: r.doc_id for r in rows}
    shingles = {r.doc_id: set(similar.distinct_shingles(r.text).tolist()) for r in rows}
    for i, a in enumerate(rows):
        for b in rows[:i]:
            x, y = shingles[a.doc_id], shingles[b.doc_id]
            if len(x & y) >= 0.8 * len(x | y):
                low, high = sorted((root[a.doc_id], root[b.doc_id]))
                root = {k: low if v == high else v for k, v in root.items()}
    assert {r.doc_id for r in near} == set(root.values()) and 9003 not in root.values()
    copies = {r.id: r.copies for r in mixing.mix(stages[3]).collect()}
    assert sorted(r.doc_id for r in mixed) == sorted(i for i, n in copies.items() for _ in range(n))
    pieces = {}
    for r in packed:
        pieces.setdefault(r.doc_id, []).append(r.length)
        assert r.offset + r.length <= 2048
    assert set(pieces) == {r.doc_id for r in mixed}
    totals = {r.doc_id: r.doc_tokens for r in packed}
    assert all(sum(v) == totals[i] * copies[i] for i, v in pieces.items())


def test_language_stage_without_labels(spark):
    rows = [(1, "some clean text", None, "s", 1), (2, "123 456", None, "s", 1), (3, None, None, "s", 1), (None, "noch ein Text", None, "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert {r.doc_id for r in language_id.language_stage(docs).collect()} == {1, None}
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 4 == 2)
    docs = spark.createDataFrame([(held, "labelled but held out", "en", "s", 1), *rows[1:]], docs.schema)
    assert {r.doc_id for r in language_id.language_stage(docs).collect()} == {held, None}


def test_run(spark):
    from pyspark.sql import functions as F

    rows = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert rows.agg(F.countDistinct("doc_id")).first()[0] > 100


def test_missing_languages_are_told(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(120)
    from pyspark.sql import functions as F

    hidden = docs.withColumn("lang", F.when(F.col("doc_id") % 5 != 0, F.col("lang")))
    told = {r.doc_id: r.lang for r in language_id.language_stage(hidden).collect()}
    true = {r.doc_id: r.lang for r in docs.collect()}
    asked = [i for i in told if i % 5 == 0]
    assert sum(told[i] == true[i] for i in asked) >= 0.9 * len(asked)


def test_stages_take_an_empty_table_repeated_rows_and_more_columns(spark):
    from pyspark.sql import functions as F

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(30)
    docs = docs.unionByName(docs.limit(5)).withColumn("__size", F.lit("x")).withColumn("id", F.lit(1))
    for given in (docs, docs.limit(0)):
        out = given
        for _, stage in corpus_pipeline.STAGES:
            out = written(stage(spark, out, ""), "stage")
        assert (out.count() > 0) == (given is docs)
