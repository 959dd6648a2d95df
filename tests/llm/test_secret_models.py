"""What the models of the secret scan are trained from."""

import random

from pyspark.sql import functions as F

from tidegate.llm.secret_scan import scan

LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"


def test_words_of_all_documents_train_the_ordinary_model(spark):
    rng = random.Random(3)
    usual = "the understanding of representation internationalization responsibilities"
    name = "XqZkVjWpQxKzJvPwXqZkVjWp"  # an identifier style of few documents
    rows = [(i, f"api_key={''.join(rng.choice(LETTERS) for _ in range(32))} {usual}") for i in range(60)]
    many = spark.range(100, 30_100).select(F.col("id").alias("doc_id"), F.concat(F.lit(usual + " "), F.col("id").cast("string")).alias("text"))
    # Texts that a sample of 4,000 by hash of the text leaves out.
    odd = spark.range(100_000, 100_600).select(F.col("id").alias("doc_id"), F.concat(F.lit(f"{name} " * 200), F.col("id").cast("string")).alias("text"))
    odd = odd.where(F.pmod(F.xxhash64("text"), F.lit(1_000_000)) >= 200_000)
    docs = spark.createDataFrame(rows, "doc_id long, text string").unionByName(many).unionByName(odd)
    assert scan(docs).where("doc_id >= 100000 AND spans != ''").count() == 0
