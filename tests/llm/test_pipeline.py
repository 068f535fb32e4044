"""The pipeline, stage by stage, on the smallest tables."""

import base64

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from pagemill.llm.queries import TOKENIZER

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    docs, kept = spark.read.parquet(f"{SF}/documents.parquet"), []
    kept.append(docs)
    for k, (_, stage) in enumerate(pipeline.STAGES):
        path = str(tmp_path_factory.mktemp("stages") / str(k))
        stage(spark, docs, SF).write.parquet(path)
        docs = spark.read.parquet(path)
        kept.append(docs)
    return kept


def test_all_but_the_last_keep_the_columns(stages):
    assert all(s.columns == pipeline.COLUMNS for s in stages[1:-1])


def test_clean_documents_stay(stages):
    docs, known, cleaned, unique = stages[:4]
    assert docs.count() - known.count() <= 2
    assert known.join(cleaned, "doc_id", "left_anti").count() < 0.05 * known.count()
    assert unique.count() == unique.select("doc_id").distinct().count() <= cleaned.count()


def test_documents_stay_where_no_language_is_known(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("lang", F.lit(None).cast("string"))
    assert pipeline.identify_language(spark, docs, SF).count() == docs.count() == 200


def test_many_languages_share_the_certainty(spark):
    """Short clean texts in one of 40 close languages stay."""
    rows = [
        (k * 40 + i, f"a{chr(97 + i % 26)}b{i} common words of all {k % 3} here and there", f"l{i}", "s", 1)
        for k in range(20)
        for i in range(40)
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert pipeline.identify_language(spark, docs, SF).count() > 0.9 * len(rows)


def test_passages_of_few_sites_go_but_once(spark):
    """50 words shared by otherwise different documents: of two sources, of none, of one."""
    def passage(name):
        return " ".join(f"{name}{k}" for k in range(50))

    rows = [(i, f"own text of {i}\n{passage('two')}\nshort", "xx", f"s{i}", 0) for i in range(2)]
    rows += [(10 + i, f"own text of {10 + i}\n{passage('none')}", "xx", None, 0) for i in range(3)]
    rows += [(20 + i, f"own text of {20 + i}\n{passage('one')}", "xx", "s9", 0) for i in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id: r for r in pipeline.drop_boilerplate(spark, docs, SF).collect()}
    changed = {1: "own text of 1\nshort", 11: "own text of 11", 12: "own text of 12"}
    assert {i: got[i].text for i in got} == {r[0]: changed.get(r[0], r[1]) for r in rows}
    assert {i: got[i].source for i in got} == {r[0]: r[3] for r in rows}


def test_last_stage_encodes_the_mix(spark, stages):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(public_tokenizers.path(TOKENIZER), "rb"))}
    encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    wanted = sorted((r.doc_id, encoding.encode_ordinary(r.text)) for r in stages[4].collect())
    assert sorted((r.doc_id, r.ids) for r in stages[5].collect()) == wanted
    assert stages[5].where(F.size("ids") != F.col("n_tokens")).count() == 0


def test_run_gives_the_last_stage(spark, stages):
    assert pipeline.run(spark, SF).count() == stages[5].count()


def test_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.count() == 0
