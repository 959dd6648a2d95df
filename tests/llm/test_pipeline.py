"""Every stage of the corpus pipeline on awkward rows: nulls, empties, repeats, clashing columns, no rows."""

import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline

SF_DIR = "/root/testdata/sf0.001"
STAGES = dict(corpus_pipeline.STAGES)

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="sample tables not present")
EXTRA = ["key", "row", "id", "text_hash", "n"]
KEY = "AKIA" + "QX7ZP2MW9RT4LK8V"


@pytest.fixture(scope="module")
def docs(spark):
    sample = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    item = spark.read.parquet(f"{SF_DIR}/benchmark.parquet").orderBy(F.length("text").desc()).first()["text"]
    words = " ".join(f"plain{i}" for i in range(60))
    odd = [
        (None, None, None, None, None), (900_001, None, "en", "web", None), (900_002, "", "en", None, 0),
        (900_003, words, "en", "web", 1), (900_003, words, "en", "web", 1), (900_004, words, None, "web", 1),
        (900_005, f"{words[:40]} {item} end", "en", "web", 1),
        (900_006, f"note the access {KEY} now and go on", "en", "web", 1),
    ]
    columns = sample.columns
    rows = spark.createDataFrame(
        [dict(zip(("doc_id", "text", "lang", "source", "n_chars"), r, strict=True)) for r in odd], sample.schema)
    whole = sample.limit(60).select(*columns).unionByName(rows.select(*columns))
    whole = whole.select("*", *[F.lit(i).alias(c) for i, c in enumerate(EXTRA)]).cache()
    yield whole
    whole.unpersist()


def rows_of(df):
    return Counter((r.doc_id, r.text) for r in df.select("doc_id", "text").collect())


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES[:-1]])
def test_stage_keeps_columns_and_takes_no_rows(spark, docs, name):
    assert STAGES[name](spark, docs, SF_DIR).columns == docs.columns
    none = STAGES[name](spark, docs.limit(0), SF_DIR)
    assert none.columns == docs.columns and none.count() == 0


def test_toxicity_only_drops_rows(spark, docs):
    before, after = rows_of(docs), rows_of(STAGES["toxicity"](spark, docs, SF_DIR))
    assert not after - before and after[(None, None)] == 1 and after[(900_002, "")] == 1


def test_one_of_each_group_of_copies_stays(spark, docs):
    before, after = rows_of(docs), rows_of(STAGES["near_copies"](spark, docs, SF_DIR))
    assert not after - before
    words = " ".join(f"plain{i}" for i in range(60))
    assert sum(n for (_, text), n in after.items() if text == words) == 1
    assert after[(None, None)] == 1 and after[(900_001, None)] == 1 and after[(900_002, "")] == 1


def test_contaminated_documents_go(spark, docs):
    before, after = rows_of(docs), rows_of(STAGES["decontamination"](spark, docs, SF_DIR))
    assert not after - before
    assert 900_005 not in {i for i, _ in after} and after[(900_003, next(t for i, t in before if i == 900_003))] == 2


def test_secrets_are_masked_and_nothing_is_dropped(spark, docs):
    out = STAGES["secrets"](spark, docs, SF_DIR)
    assert out.count() == docs.count()
    masked = out.where("doc_id = 900006").first()
    assert KEY not in masked.text and masked.n_chars == len(masked.text)
    kept = out.where("doc_id = 900003").collect()
    assert len(kept) == 2 and all("plain0 plain1" in r.text for r in kept)
    assert out.where("doc_id = 900001").first().text is None


def test_mixing_places_every_row_once(spark, docs):
    out = STAGES["mixing"](spark, docs, SF_DIR)
    assert out.count() == docs.count()
    assert STAGES["mixing"](spark, docs.limit(0), SF_DIR).count() == 0
