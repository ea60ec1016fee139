import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from hearthline.ml import encoders as en
from tests.conftest import values


def test_median_impute(frame):
    df = frame(
        [(1, 1.0, None, "7"), (2, 2.0, None, None), (3, 10.0, None, "x"), (4, None, None, "9"),
         (5, 11.0, None, None), (6, float("nan"), None, None)],
        "id int, a double, b double, c string",
    )
    stage = en.MedianImputer(inputCols=["a", "b", "c"]).fit(df)
    assert en.output_columns(stage, "num_", ["a", "b", "c"]) == ["num_a", "num_c"]
    assert values(stage.transform(df), "id", "num_a", "num_c") == [
        (1, 1.0, 7.0), (2, 2.0, 8.0), (3, 10.0, 8.0), (4, 6.0, 9.0), (5, 11.0, 8.0), (6, 6.0, 8.0),
    ]


def test_fit_and_transform_read_text_alike(frame):
    texts = ["5d", "1f", "7", " 8.0 ", "1e1", "NaN", "x", None]
    df = frame([(i, t, t) for i, t in enumerate(texts)], "id int, a string, b string")
    fitted = en.MedianImputer(inputCols=["a"]).fit(df).transform(df)
    assert values(fitted, "id", "num_a") == [
        (0, 8.0), (1, 8.0), (2, 7.0), (3, 8.0), (4, 10.0), (5, 8.0), (6, 8.0), (7, 8.0),
    ]
    zero = en.zero_fill(["a"]).transform(df)
    assert [r[1] for r in values(zero, "id", "flag_a")] == [0.0, 0.0, 7.0, 8.0, 10.0, 0.0, 0.0, 0.0]
    flags = frame([(1, True, 2), (2, False, None), (3, None, 0)], "id int, a boolean, b int")
    assert values(en.zero_fill(["a", "b"]).transform(flags), "flag_a", "flag_b") == [(0.0, 0.0), (0.0, 0.0), (1.0, 2.0)]


def test_free_text_is_no_category(frame):
    df = frame([(f"note {i}",) for i in range(300)], "cat_a string")
    with pytest.raises(ValueError, match="more than 100 categories"):
        en.check_categories(df, ["a"], 100)
    en.check_categories(df, ["a"], 400)


def test_standardise_uses_the_population_deviation(frame):
    df = frame([(1, 1.0, 5.0), (2, 3.0, 5.0), (3, 8.0, 5.0)], "id int, a double, b double")
    got = values(en.Standardizer(inputCols=["a", "b"]).fit(df).transform(df), "id", "std_a", "std_b")
    a = np.array([1.0, 3.0, 8.0])
    assert [r[1] for r in got] == pytest.approx(list((a - a.mean()) / a.std()))
    assert [r[2] for r in got] == [0.0, 0.0, 0.0]


def test_zero_and_unknown(frame):
    df = frame([(1, 1, None), (2, None, "it's"), (3, 0, "x")], "id int, a int, b string")
    assert values(en.zero_fill(["a"]).transform(df), "id", "flag_a") == [(1, 1.0), (2, 0.0), (3, 0.0)]
    assert values(en.unknown_fill(["a", "b"]).transform(df), "id", "cat_a", "cat_b") == [
        (1, "1", "Unknown"), (2, "Unknown", "it's"), (3, "0", "x"),
    ]


def test_one_hot_has_a_slot_per_category_and_none_for_unseen(frame):
    fitted = en.unknown_fill(["c"]).transform(frame([("b",), ("a",), (None,)], "c string"))
    indexer, encoder = en.one_hot(["c"])
    indexer = indexer.fit(fitted)
    encoder = encoder.fit(indexer.transform(fitted))
    new = en.unknown_fill(["c"]).transform(frame([(1, "a"), (2, "b"), (3, "z"), (4, None)], "id int, c string"))
    hot = encoder.transform(indexer.transform(new))
    got = values(hot.select("id", vector_to_array("hot_c")))
    # Slots in alphabetical order: Unknown, a, b.
    assert got == [(1, [0, 1, 0]), (2, [0, 0, 1]), (3, [0, 0, 0]), (4, [1, 0, 0])]


def test_ordinal_rank(frame):
    df = frame([(1, "low"), (2, "it's high"), (3, "other"), (4, None)], "id int, s string")
    got = en.ordinal_rank({"s": ["low", "it's high"]}).transform(df)
    assert values(got, "id", "ord_s", "ord_s_missing") == [
        (1, 0.0, 0.0), (2, 1.0, 0.0), (3, -1.0, 1.0), (4, -1.0, 1.0),
    ]


def _encode(cats, y, cat):
    """The textbook form: weight n*v / (n*v + own variance)."""
    y = np.asarray(y, float)
    own = np.array([v for c, v in zip(cats, y) if c == cat])
    if not len(own):
        return y.mean()
    top = y.var() * len(own)
    if top + own.var() == 0:
        return y.mean()
    w = top / (top + own.var())
    return w * own.mean() + (1 - w) * y.mean()


@pytest.fixture
def labelled(spark):
    return spark.range(600).select(
        "id",
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") == 1, "once")
        .otherwise(F.concat(F.lit("c"), (F.col("id") % 7).cast("string"))).alias("c"),
        (F.lit(1e6) + F.sin(F.col("id").cast("double")) + (F.col("id") % 7)).alias("label"),
        (F.col("id") % 5).cast("int").alias("fold"),
    )


def test_target_encoding_against_brute_force(labelled):
    rows = labelled.collect()
    encoder = en.CrossFitTargetEncoder(inputCol="c", outputCol="e")
    model, encoded = encoder.fit_training(labelled)
    got = {r["id"]: r["e"] for r in encoded.collect()}
    assert len(got) == 600
    for r in rows:
        rest = [o for o in rows if o["fold"] != r["fold"]]
        want = _encode([o["c"] for o in rest], [o["label"] for o in rest], r["c"])
        assert got[r["id"]] == pytest.approx(want, abs=1e-7), r
    whole = {r["c"]: r["e"] for r in model.transform(labelled).collect()}
    for c in {r["c"] for r in rows}:
        want = _encode([r["c"] for r in rows], [r["label"] for r in rows], c)
        assert whole[c] == pytest.approx(want, abs=1e-7)


def test_unseen_categories_get_the_mean(labelled, frame):
    model = en.CrossFitTargetEncoder(inputCol="c", outputCol="e").fit(labelled)
    mean = labelled.agg(F.avg("label")).first()[0]
    new = frame([("never",), (None,)], "c string")
    assert [r["e"] for r in model.transform(new).collect()] == pytest.approx([mean, mean])


def test_constant_target(frame):
    df = frame([("a", 2.0, 0), ("a", 2.0, 1), ("b", 2.0, 0)], "c string, label double, fold int")
    model, encoded = en.CrossFitTargetEncoder(inputCol="c", outputCol="e").fit_training(df)
    assert [r["e"] for r in encoded.collect()] == [2.0, 2.0, 2.0]
    assert [r["e"] for r in model.transform(df).collect()] == [2.0, 2.0, 2.0]


def test_one_fold_only(frame):
    df = frame([("a", 1.0, 3), ("b", 3.0, 3)], "c string, label double, fold int")
    _, encoded = en.CrossFitTargetEncoder(inputCol="c", outputCol="e").fit_training(df)
    assert [r["e"] for r in encoded.collect()] == [2.0, 2.0]


def test_encoder_model_saves_and_loads(labelled, tmp_path):
    model = en.CrossFitTargetEncoder(inputCol="c", outputCol="e").fit(labelled)
    model.write().overwrite().save(str(tmp_path / "m"))
    again = en.CrossFitTargetEncoderModel.load(str(tmp_path / "m"))
    assert again.uid == model.uid and again.getOutputCol() == "e"
    assert values(again.transform(labelled), "id", "e") == values(model.transform(labelled), "id", "e")


def test_estimators_save_and_load(tmp_path):
    en.MedianImputer(inputCols=["a"]).save(str(tmp_path / "m"))
    assert en.MedianImputer.load(str(tmp_path / "m")).getInputCols() == ["a"]
    en.CrossFitTargetEncoder(inputCol="c", outputCol="e", foldCol="f").save(str(tmp_path / "t"))
    assert en.CrossFitTargetEncoder.load(str(tmp_path / "t")).getFoldCol() == "f"


def test_assembled_values_have_no_gaps(listings):
    names = ["latitude", "longitude", "livable_surface", "floor"]
    filled = en.MedianImputer(inputCols=names).fit(listings).transform(listings)
    made = VectorAssembler(inputCols=[f"num_{n}" for n in names], outputCol="v").transform(filled)
    assert made.select("v").count() == listings.count()
