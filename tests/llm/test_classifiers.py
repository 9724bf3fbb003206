import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from trolley.llm import language, ordinal_quality, toxicity
from trolley.llm.features import NgramSpace

DATA = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet"), spark.read.parquet(f"{DATA}/labels.parquet")


def test_scores_equal_rows_times_weights():
    texts = ["", "a", "Ünï cödé", "hello world hello", "x" * 3000, "same same same ! 12"]
    space = NgramSpace(8, (1, 2, 3), lower=False, marks=True)
    weights = np.random.default_rng(3).normal(size=(space.size, 3))
    rows = space.rows(texts)[:, :-1]
    assert np.allclose(space.scores(texts, weights), rows @ weights, atol=1e-4)


def test_language_held_out(tables):
    documents, _ = tables
    out = language.held_out_predictions(documents).collect()
    lang = {r["doc_id"]: r["lang"] for r in documents.collect()}
    assert len(out) == len(lang)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in out)
    assert all(0 <= r["score"] <= 1 for r in out)
    right = [r["lang_pred"] == lang[r["doc_id"]] for r in out if r["held_out"]]
    assert sum(right) / len(right) > 0.97


def language_rows(spark):
    random.seed(4)
    words = {"en": "the of and to in is".split(), "de": "der die und das ist nicht".split(), "xx": "zug kpo mnu".split()}
    rows = [(i, " ".join(random.choices(words[k], k=20)), k) for i, k in enumerate(["en", "de", "xx", None] * 40) if k]
    rows += [(500, None, "en"), (501, "", "de"), (502, "12 !? 34", None), (503, "the of and", None), (503, "the of and", None), (None, "die und das", "de"), (504, "the " * 200_000, "en")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string"), rows


def test_language_of_odd_rows(spark):
    df, rows = language_rows(spark)
    df = df.withColumns({"lang_pred": F.lit("?"), "score": F.lit(9), "label": F.lit(1)})
    out = language.held_out_predictions(df).collect()
    assert len(out) == len(rows)
    by_id = {r["doc_id"]: r for r in out}
    assert all(by_id[i]["lang_pred"] == "und" and by_id[i]["score"] == 0 for i in (500, 501, 502))
    assert by_id[503]["lang_pred"] == "en" and by_id[504]["lang_pred"] == "en" and by_id[None]["lang_pred"] == "de"
    nothing = language.held_out_predictions(df.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {r["lang_pred"] for r in nothing} == {"und"}
    assert language.held_out_predictions(df.limit(0)).count() == 0
    one = language.held_out_predictions(df.where("lang = 'en'")).where("doc_id = 504").first()
    assert one["lang_pred"] == "en"


def test_quality_accuracy(tables):
    documents, labels = tables
    kept = {r["doc_id"]: r for r in ordinal_quality.rate(documents, labels.where("doc_id % 5 != 0")).collect()}
    held_out = labels.where("doc_id % 5 = 0").collect()
    right = [kept[r["doc_id"]]["keep"] == (r["quality"] == 1) for r in held_out]
    assert sum(right) / len(right) > 0.97
    good = [kept[r["doc_id"]]["keep"] for r in held_out if r["quality"] == 1]
    assert sum(good) / len(good) > 0.98


def test_quality_with_three_grades(spark):
    random.seed(5)
    words = ["bad awful", "fair plain", "good fine"]
    rows = [(i, " ".join([words[i % 3]] * 30 + [str(random.random())])) for i in range(300)]
    documents = spark.createDataFrame([*rows, (900, None), (901, ""), (902, "good fine " * 50_000), (902, "x")], "doc_id long, text string")
    documents = documents.withColumns({"tail": F.lit("?"), "expected_grade": F.lit(0), "quality": F.lit(7)})
    grades = [(i, i % 3) for i in range(200)] + [(0, None), (None, 1), (7777, 2), (3, 0)]
    labels = spark.createDataFrame(grades, "doc_id long, quality int")
    out = {r["doc_id"]: r for r in ordinal_quality.rate(documents, labels, wanted=2).where("doc_id < 300").collect()}
    for g in range(3):
        assert abs(np.mean([out[i]["expected_grade"] for i in range(200 + (g - 200) % 3, 300, 3)]) - g) < 0.4
    assert all(out[i]["keep"] == (i % 3 == 2) for i in range(200, 300))
    assert ordinal_quality.rate(documents, labels, wanted=2).count() == 304
    assert ordinal_quality.keep_good(documents, labels, 2).columns == documents.columns
    assert ordinal_quality.rate(documents, labels.limit(0)).where("keep").count() == 304
    assert ordinal_quality.rate(documents.limit(0), labels).count() == 0


def test_thresholds_are_ordered():
    rng = np.random.default_rng(6)
    x = np.hstack([rng.random((200, ordinal_quality.SPACE.size)), np.ones((200, 1))]).astype(np.float32)
    model = ordinal_quality.OrdinalModel.fit(x, rng.integers(0, 4, 200).tolist(), steps=30)
    assert (np.diff(model.thresholds) >= 0).all()


def test_toxicity_held_out(spark):
    data = "/root/testdata/sf0.1"
    documents, labels = spark.read.parquet(f"{data}/documents.parquet"), spark.read.parquet(f"{data}/labels.parquet")
    out = {r["doc_id"]: r for r in toxicity.held_out_scores(documents, labels).collect()}
    assert len(out) == documents.count()
    rows = [(out[r["doc_id"]], r["toxic"]) for r in labels.collect() if out[r["doc_id"]]["held_out"]]
    caught = [r["predicted"] for r, toxic in rows if toxic == 1]
    wrong = [r["predicted"] for r, toxic in rows if toxic == 0]
    assert sum(caught) / len(caught) > 0.9
    assert sum(wrong) / len(wrong) < 0.01


def test_folding():
    fold = toxicity.Folder()
    assert fold("1D10T idíot ІDІОТ").split() == ["idiot", "idiot", "idiot"]
    assert fold("Clown，fish") == " clown fish "
    assert fold("") == "  "


def test_folding_takes_out_combining_and_invisible_signs():
    fold = toxicity.Folder()
    hidden = ["i\u0301diot", "id\u200biot", "\ufeffidi\u00adot", "idio\u0336t\u0336", "id\U000e0100iot"]
    assert [fold(t) for t in hidden] == [" idiot "] * 5
    assert fold("\u0301") == "  " and fold("a\x00b") == " a b "


def toxic_rows():
    random.seed(7)
    fill = "la le lu lo li na ne nu".split()
    rows, labels = [], []
    for i in range(600):
        words = random.choices(fill, k=30)
        toxic = i % 6 == 0
        if toxic:
            words[5:6] = [random.choice(["clown", "idiot"])]
        elif i % 30 == 1:
            words[5:6] = ["clown", "fish"]
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return rows, labels


def test_exception_phrases_and_odd_rows(spark):
    rows, labels = toxic_rows()
    extra = [(1000, None), (1001, ""), (1002, "la le CL0WN lu na ne lo li"), (1003, "la clown fish lu ne na li"), (1004, "la le " * 100_000 + " idiot"), (1002, "la le CL0WN lu na ne lo li"), (None, "la")]
    documents = spark.createDataFrame(rows + extra, "doc_id long, text string").withColumns({"toxic": F.lit("?"), "score": F.lit(1)})
    marked = spark.createDataFrame([*labels, (3, None), (None, 1), (8888, 1), (0, 1)], "doc_id long, toxic int")
    model = toxicity.fit(documents, marked)
    assert any("clown fish" in x for x in model.exceptions) and " clown " in model.lexicon
    out = toxicity.held_out_scores(documents, marked).collect()
    assert len(out) == len(rows) + len(extra)
    by_id = {r["doc_id"]: r for r in out}
    assert by_id[1002]["predicted"] == 1 and by_id[1003]["predicted"] == 0 and by_id[1000]["predicted"] == 0
    assert by_id[1000]["score"] == by_id[1001]["score"]
    assert toxicity.held_out_scores(documents, marked.limit(0)).where("score = 0").count() == len(out)
    assert toxicity.held_out_scores(documents.limit(0), marked).count() == 0
