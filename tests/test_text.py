from pyspark.sql import functions as F

from foliospark.functions import text as T
from foliospark.functions.stem import porter


def one(spark, column, **values):
    return spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values)).select(column.alias("x")).first().x


def test_normalise(spark):
    assert one(spark, T.normalise(F.col("a")), a="  The board-\n ing ■ “House”  ﬁne — day ") == 'the boarding "house" fine - day'
    assert one(spark, T.normalise(F.col("a")), a=None) is None


def test_cite_and_year(spark):
    assert one(spark, T.cite_key(F.col("a")), a="1  Wend. 16") == "1 wend 16"
    assert one(spark, T.leading_year(F.col("a")), a="1908-04") == 1908
    assert one(spark, T.leading_year(F.col("a")), a="unknown") == 0


def test_era(spark):
    rows = spark.createDataFrame([(None,), (1993,), (1994,), (2050,)], "y int")
    assert [r.e for r in rows.select(T.era_label(F.col("y"), [("a", 1994), ("b", 2000)]).alias("e")).collect()] == ["unknown", "a", "b", "b"]


def test_dates(spark):
    for a, b, want in (("1908", "1908-04-24", True), ("1908-04", "1908", True), ("1908", "1909", False), ("", "1908", False), (None, "1908", False)):
        assert one(spark, T.dates_compatible(F.col("a"), F.col("b")), a=a, b=b) is want


def test_porter_published_examples():
    pairs = "caresses caress ponies poni ties ti cats cat feed feed agreed agre plastered plaster motoring motor sing sing conflated conflat hopping hop falling fall hissing hiss filing file happy happi sky sky relational relat conditional condit rational ration digitizer digit operator oper feudalism feudal hopefulness hope triplicate triplic formative form electrical electr revival reviv allowance allow inference infer adjustment adjust adoption adopt probate probat rate rate cease ceas controll control roll roll".split()
    assert {w: porter(w) for w in pairs[::2]} == dict(zip(pairs[::2], pairs[1::2], strict=True))
