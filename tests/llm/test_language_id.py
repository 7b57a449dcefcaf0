from grainmill.llm import language_id
from grainmill.llm.language_id import accept, identify, train


def test_held_out_accuracy_and_defined_results(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    model = train(docs)
    got = identify(docs, model).join(docs.select("doc_id", "lang"), "doc_id")
    held = got.where("held_out").collect()
    assert len(held) > 100 and sum(r.lang == r.lang_pred for r in held) / len(held) > 0.97
    assert all(0 <= r.score <= 1 for r in held)
    odd = spark.createDataFrame([(1, None, 3), (1, "", 3), (2, "12 %$", 3), (3, docs.first().text * 50, 3), (None, "and the of", 3)], "doc_id long, text string, score int")
    rows = identify(odd, model).collect()
    assert [r.lang_pred for r in rows[:3]] == ["und"] * 3 and rows[4].lang_pred == "en" and rows[4].held_out
    kept = accept(odd, model, 0.0)
    assert kept.columns == odd.columns and kept.count() == 2
    assert identify(odd.limit(0), model).count() == 0
    assert identify(odd, train(docs.limit(0))).where("lang_pred = 'und'").count() == 5


def test_predictions_do_not_depend_on_id_lang_or_source(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    model = train(docs)
    a = {r.text: r.lang_pred for r in docs.select("text").join(identify(docs, model).join(docs.select("doc_id", "text"), "doc_id"), "text").collect()}
    swapped = docs.selectExpr("doc_id + 7 as doc_id", "text", "'zz' as lang", "null as source")
    b = identify(swapped, model).join(swapped.select("doc_id", "text"), "doc_id").collect()
    assert all(a[r.text] == r.lang_pred for r in b)


def test_a_text_without_a_letter_is_und(spark, small):
    model = train(spark.read.parquet(f"{small}/documents.parquet"))
    texts = ["½ ² 12", "Ⅷ ① ⅓", "_ - _", "\u0301\u0308", "日", "ʰ", "x"]
    odd = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert [r.lang_pred == "und" for r in sorted(identify(odd, model).collect())] == [True] * 4 + [False] * 3
    assert accept(odd, model, 0.0).count() == 3


def test_the_sample_shrinks_until_its_features_fit(spark, small, monkeypatch):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    seen, fit = [], language_id.train_svm
    monkeypatch.setattr(language_id, "train_svm", lambda rows, y, **k: (seen.append(sum(len(a) for a, _ in rows)), fit(rows, y, **k))[1])
    monkeypatch.setattr(language_id, "SAMPLE_FEATURES", 60_000)
    got = identify(docs, train(docs)).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert 30_000 < max(seen) <= 60_000 and sum(r.lang == r.lang_pred for r in got) / len(got) > 0.9
    monkeypatch.setattr(language_id, "SAMPLE_FEATURES", 0)
    assert train(docs).members == {}
