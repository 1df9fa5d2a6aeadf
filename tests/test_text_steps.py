from conftest import rows
from newsloom.operators.entities import entities
from newsloom.operators.sentiment import sentiment_scores


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_repeated_phrases_meet_the_entries_once(spark):
    documents = spark.createDataFrame([("a", "1", "Ann Lee met Ann Lee. " * 300), ("a", "2", None)], "source string, id string, summary string")
    gazetteer = spark.createDataFrame([("Ann", "PERSON"), ("Ann Lee", "PERSON"), ("Lee met", "ORG")], "phrase string, label string")
    found = entities(documents, gazetteer)
    assert rows(found) == [("a", "1", ["Ann", "Ann Lee"], ["Lee met"], [])]
    plan = plan_of(found)
    assert "arrays_zip" not in plan
    inlined = plan.index("inline(entries")  # above its input in the printed tree
    assert "Aggregate [source" in plan[inlined:], plan


def test_words_before_are_picked_for_words_of_the_lexicon_only(spark):
    documents = spark.createDataFrame([("a", "1", "It is NOT very good, but fine."), ("a", "2", "")], "source string, id string, summary string")
    lexicon = spark.createDataFrame([("good", 2.0), ("fine", 1.0), ("very", 3.0)], "token string, valence double")
    scored = sentiment_scores(documents, lexicon)
    assert [r["id"] for r in scored.collect()] == ["1"]
    plan = plan_of(scored)
    assert "arrays_zip" not in plan and " IN (absolutely" not in plan.split("Generate")[-1] and "INSET" not in plan[plan.index("Generate"):]
