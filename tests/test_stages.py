import time

from hearthline.llm import jaccard_join
from hearthline.sources import stages


def test_kept_lets_shuffles_go(spark):
    shuffles = spark.sparkContext._jsc.sc().env().mapOutputTracker().shuffleStatuses()
    stages.let_go(spark)
    time.sleep(1)
    before = shuffles.size()
    for _ in range(3):
        stages.kept(spark.range(1000).groupBy("id").count(), "grouped")
    for _ in range(60):
        if shuffles.size() <= before + 1:
            break
        time.sleep(0.25)
        stages.let_go(spark)
    assert shuffles.size() <= before + 1


def test_the_join_lets_go_after_each_table(spark, monkeypatch):
    gone, made = [], []
    plain = stages.stage
    monkeypatch.setattr(stages, "let_go", lambda spark: gone.append(1))
    monkeypatch.setattr(stages, "stage", lambda df, name: made.append(name) or plain(df, name))
    docs = spark.createDataFrame([(1, "a b c d e f g"), (2, "a b c d e f g h"), (3, "x")], "doc_id long, text string")
    found = {r["id"]: r["component"] for r in jaccard_join.join(docs, settings=jaccard_join.Settings(n=2)).collect()}
    assert found == {1: 1, 2: 1, 3: 3}
    assert len(made) > 5 and len(gone) == len(made)
