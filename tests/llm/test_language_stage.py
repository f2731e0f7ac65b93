"""Mixed, rare and unlabelled languages."""

import corpus_pipeline
from pyspark.sql import functions as F

from strata.llm import language

TEXTS = {"en": "the quick brown fox jumps over the lazy dog and runs away", "ru": "быстрая коричневая лиса прыгает",
         "el": "η γρήγορη καφέ αλεπού πηδάει πάνω", "ka": "სწრაფი ყავისფერი მელა ხტება"}


def test_mixed_and_rare_and_unlabelled_documents_stay(spark):
    train = [(i, TEXTS["en"], "en") for i in range(3000)] + [(5000, TEXTS[k], k) for k in ("ru", "el", "ka")]
    train = [(k, t, lang) for k, (_, t, lang) in enumerate(train)]
    docs = spark.createDataFrame(train, "doc_id long, text string, lang string")
    model = language.fit(docs, max_rows=40)
    assert model.langs == ["el", "en", "ka", "ru"]
    mixed = "quick brown αλεπού γρήγορη лисица прыгае მელახტ ყავისფ"
    ask = spark.createDataFrame([(1, mixed), (2, TEXTS["ka"]), (3, "漢字漢字漢字漢字 one"), (4, "12 34"), (5, None)],
                                "doc_id long, text string")
    assert [r.doc_id for r in language.reject(ask, model, min_score=0.3).orderBy("doc_id").collect()] == [1, 2]
    unlabelled = ask.withColumn("lang", F.lit(None).cast("string"))
    got = corpus_pipeline.by_language(spark, unlabelled, "").orderBy("doc_id").collect()
    assert [r.doc_id for r in got] == [1, 2, 3]
