"""Operator 2 on columns that have the names of its results."""

from synthtext.llm.language import fit, predict


def test_results_replace_columns_of_their_names(spark):
    rows = [(k, "the cat sat on the mat and the dog", "en", 5, "old") if k % 2 else
            (k, "der hund und die katze sind im haus", "de", 5, "old") for k in range(40)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, score int, lang_pred string")
    out = predict(df, fit(df))
    assert out.columns == ["doc_id", "text", "lang", "lang_pred", "score"]
    got = out.collect()
    assert len(got) == 40 and all(r.lang_pred == r.lang and 0 <= r.score <= 1 for r in got)
    assert predict(df.limit(0), fit(df.limit(0))).collect() == []
