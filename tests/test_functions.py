from pyspark.sql import functions as F

from trailhead.functions import scalar as S
from trailhead.operators import landmarks


def column(spark, values, build, kind="double"):
    return [r[0] for r in spark.createDataFrame([(v,) for v in values], f"x {kind}").select(build(F.col("x"))).collect()]


def test_spoken_metres(spark):
    assert column(spark, [0.0, 4.0, 5.0, 15.0, 25.0, 35.0, 999.99, 1025.0, 1075.0, 1125.0], S.spoken_metres) == [10, 10, 10, 20, 20, 40, 1000, 1000, 1100, 1100]


def test_turn_bounds(spark):
    assert column(spark, [24.9, 25.0, 60.0, 135.0, -25.0, -60.0, -135.0, -180.0], S.turn_name) == ["straight", "slight right", "right", "sharp right", "slight left", "left", "sharp left", "sharp left"]


def test_plain_and_words(spark):
    assert column(spark, ["St. Mary's North-West ", None], S.plain, "string") == ["st marys north west", None]
    assert column(spark, [" a b\n c "], S.squash, "string") == ["a b c"]


def test_first_label_counts_and_supermarket_is_a_market(spark):
    got = spark.createDataFrame([(["Zoo", "Supermarket", "Hotel"],), (["Zoo"],), (None,)], "x array<string>").select(landmarks.classify(F.col("x"))["cat"]).collect()
    assert [r[0] for r in got] == ["market", None, None]


def test_tags(spark):
    rows = [({"amenity": "place_of_worship", "religion": "muslim"},), ({"shop": "mall"},), ({"shop": "shoes"},), ({"foo": "bar"},)]
    got = spark.createDataFrame(rows, "x map<string,string>").select(landmarks.tag_category(F.col("x"))["cat"]).collect()
    assert [r[0] for r in got] == ["mosque", "mall", "shop", None]


def test_names(spark):
    assert column(spark, ["Room 4", "Big Market", "A, B", "Lot 123", "abc"], landmarks.kept_name, "string") == [False, True, False, False, False]
