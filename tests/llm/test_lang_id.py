import zlib

import cases
import pytest
from pyspark.sql import functions as F

from tallyframe.llm import lang_id

FOLDER = "/root/testdata/sf0.001"


def test_held_out_accuracy(spark):
    """Every row of the table is predicted; those held out of the training tell the accuracy."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    got = lang_id.identify(docs).collect()
    langs = {r.doc_id: r.lang for r in docs.collect()}
    assert len(got) == len(langs)
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1
    held = [r for r in got if r.held_out]
    assert sum(r.lang_pred == langs[r.doc_id] for r in held) >= 0.97 * len(held)


def test_word_first_then_shorter_grams():
    counts = [(0, "the", "en", 9), (0, "der", "de", 9), (1, "a", "en", 5), (1, "z", "de", 5), (2, "zz", "de", 4), (3, "ing", "en", 4)]
    model = lang_id.Model.fitted(counts)
    assert model.languages == ["de", "en"]
    assert model.predict("The THE the")[0] == "en" and model.predict("der")[0] == "de"
    # "the" is known: its n-grams, known elsewhere, don't matter
    assert (model.word("the") == model.tables[0][1][model.tables[0][0]["the"]]).all()
    assert (model.word("king") == model.tables[3][1][model.tables[3][0]["ing"]]).all()
    assert (model.word("zzq") == model.tables[2][1][model.tables[2][0]["zz"]]).all()
    assert (model.word("qza") == model.tables[1][1].mean(axis=0)).all()
    assert model.predict("qqq")[0] == "de"  # a tie goes to the first
    for text in (None, "", "12 34", "½ ² .", " \n"):
        assert model.predict(text) == ("und", 0.0)


def test_awkward_rows(spark):
    rows = [(i, f"the house and the garden of word{i}", "en") for i in range(40)] + [(100 + i, f"das haus und der garten von wort{i}", "de") for i in range(40)]
    rows += [(500, None, "en"), (501, "", "de"), (502, "123", None), (503, "the house", None), (None, "das haus", "de"), (503, "the house", None), (504, "haus " * 30000, None)]
    docs = spark.createDataFrame([(*r, "und", 1.0) for r in rows], "doc_id long, text string, lang string, lang_pred string, score double")
    got = lang_id.identify(docs).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got}
    assert by_id[500].lang_pred == by_id[501].lang_pred == by_id[502].lang_pred == "und"
    assert by_id[503].lang_pred == "en" and by_id[504].lang_pred == "de" and by_id[None].lang_pred == "de" and not by_id[None].held_out
    kept = lang_id.accepted(docs)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {r[0] for r in rows} - {500, 501, 502}


def test_label_is_no_input(spark):
    """With other labels on held-out rows the predictions are the same."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(150)
    wrong = docs.withColumn("lang", F.when(lang_id.held_out("doc_id"), F.lit("xx")).otherwise(F.col("lang")))
    assert sorted(map(tuple, lang_id.identify(docs).collect())) == sorted(map(tuple, lang_id.identify(wrong).collect()))


def test_nothing_labelled_and_empty(spark):
    docs = spark.createDataFrame([(1, "the house", None)], "doc_id long, text string, lang string")
    assert [(r.lang_pred, r.score) for r in lang_id.identify(docs).collect()] == [("und", 0.0)]
    assert lang_id.identify(cases.empty(spark)).count() == 0


@pytest.mark.parametrize("rows", [5, 1000])
def test_sample_is_bounded_for_each_label(spark, rows):
    table = spark.range(3000).selectExpr("id", "IF(id % 10 = 0, 'rare', 'often') AS lang")
    counts = {r.lang: r["count"] for r in lang_id.sample(table, "lang", F.col("id"), rows).groupBy("lang").count().collect()}
    assert counts == {"rare": min(rows, 300), "often": min(rows, 2700)}
