"""The sample is bounded a language, and a text may have any number of languages."""

import random

import numpy as np
from pyspark.sql import functions as F

from bidbox.llm import langmix

LETTERS = {"aa": "abcde", "bb": "fghij", "cc": "klmno", "dd": "pqrst", "ee": "uvwxy"}


def text(lang: str, n: int, seed: int) -> str:
    rnd = random.Random(f"{lang}{seed}")
    return " ".join("".join(rnd.choice(LETTERS[lang]) for _ in range(rnd.randint(3, 7))) for _ in range(n))


def test_a_rare_language_is_learned_beside_a_common_one(spark):
    common = spark.range(200_000).select(F.col("id").alias("doc_id"), F.lit(text("aa", 6, 1)).alias("text"), F.lit("aa").alias("lang"))
    rare = spark.createDataFrame([(10**6 + i, text("bb", 6, i), "bb") for i in range(20)], "doc_id long, text string, lang string")
    langs, logp = langmix.learn(common.union(rare), max_train=500)
    assert langs == ["aa", "bb"] and np.isfinite(logp).all()
    new = spark.createDataFrame([(1, text("bb", 10, 999))], "doc_id long, text string")
    assert langmix.identify(new, (langs, logp)).first().lang_pred == "bb"


def test_a_text_of_five_languages(spark):
    rows = [(100 * k + i, text(lang, 40, i), lang) for k, lang in enumerate(LETTERS) for i in range(40)]
    model = langmix.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    mixed = [" ".join(text(lang, 60, 7) for lang in list(LETTERS)[:n]) for n in range(1, 6)]
    got = {r.doc_id: {m.lang: m.share for m in r.mixture} for r in langmix.identify(spark.createDataFrame(list(enumerate(mixed)), "doc_id long, text string"), model).collect()}
    for n in range(1, 6):
        assert set(got[n - 1]) == set(list(LETTERS)[:n])
        assert all(abs(x - 1 / n) < 0.05 for x in got[n - 1].values())
