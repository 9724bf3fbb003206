"""Rows that share an id, or have none, and texts without a letter."""

from pyspark.sql import functions as F

from trolley.llm import common, language

WORDS = {"en": "the of and to in is", "de": "der die und das ist nicht"}


def test_rows_without_an_id_are_drawn_one_by_one(spark):
    rows = [(None if k % 2 else 7, f"{WORDS[lang]} {k}", lang) for k in range(4000) for lang in WORDS]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    drawn = common.bounded_sample(df, "lang", "doc_id", 400, {"en": 4000, "de": 4000}, more=("text",))
    found = {(r["lang"], r["doc_id"]): r["count"] for r in drawn.groupBy("lang", "doc_id").count().collect()}
    assert all(120 < found[lang, i] < 280 for lang in WORDS for i in (None, 7))
    out = language.held_out_predictions(df.limit(600))
    assert out.where(F.col("lang_pred") == "und").count() == 0


def test_numerals_are_no_letters(spark):
    rows = [(k, f"{WORDS[lang]} {k}", lang) for k in range(60) for lang in WORDS]
    odd = ["½", "² ①", "Ⅷ", "٣", "12 !?", "_", "ª", "é", "漢", "ͅ"]
    rows += [(1000 + k, text, None) for k, text in enumerate(odd)]
    out = language.held_out_predictions(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    found = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in out.where("doc_id >= 1000").collect()}
    assert [found[1000 + k][0] == "und" for k in range(len(odd))] == [True] * 6 + [False] * 3 + [True]
    assert all(found[1000 + k] == ("und", 0.0) for k in range(6))
