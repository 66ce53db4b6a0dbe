"""Carried columns named like a result or an inner column of op3 and op8."""

from pyspark.sql import functions as F

from ledgerline.llm import langid, toxicity
from ledgerline.llm.toxicity import Model


def test_scores_replace_carried_columns_of_their_names(spark):
    docs = spark.createDataFrame([(1, "you vile scum", 7.0, "x", 9), (2, None, None, None, None)], "doc_id long, text string, score double, features string, predicted int")
    plain = Model(share=0.1)
    for model in (plain, Model(share=0.1, terms={"scum": 3.0}, stems={}, weights=[0.1] * (toxicity.N_FEATURES + 1))):
        rows = toxicity.score(docs, model, docs.columns).orderBy("doc_id")
        assert rows.columns == ["doc_id", "text", "features", "score", "predicted"]
        assert [(r.doc_id, r.features) for r in rows.collect()] == [(1, "x"), (2, None)]
        assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= toxicity.THRESHOLD) for r in rows.collect())


def test_languages_replace_carried_columns_of_their_names(spark):
    train = spark.createDataFrame([("the cat and the dog went home", "en"), ("der Hund und die Katze sind da", "de")] * 12, "text string, lang string")
    model = langid.train(train)
    docs = spark.createDataFrame([(1, "the dog and the cat", "xx", 5.0, "kept"), (2, "die Katze und der Hund", None, None, None)], "id long, text string, lang string, confidence double, likelihood string")
    rows = langid.identify(docs, docs.columns, model, F.col("text"), F.col("lang"), F.lit(None).cast("string")).orderBy("id")
    assert rows.columns == ["id", "text", "likelihood", "lang", "confidence", "text_lang", "declared_lang"]
    found = rows.collect()
    assert [(r.id, r.likelihood, r.text_lang) for r in found] == [(1, "kept", "en"), (2, None, "de")]
    assert all(0 <= r.confidence <= 1 for r in found)
