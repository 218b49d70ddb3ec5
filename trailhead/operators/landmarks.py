"""Landmark tables: categories of tags and labels, filters of places, deduplication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trailhead.functions import scalar as S

# Keyword in a place's label, category, importance; the first match counts.
LABELS = [
    ("Bus Station", "lorry park", 5), ("Market", "market", 5), ("Shopping Mall", "mall", 4), ("Hospital", "hospital", 4), ("Stadium", "stadium", 4),
    ("Supermarket", "supermarket", 3), ("Hotel", "hotel", 3), ("Lodging", "hotel", 3), ("School", "school", 3), ("College", "school", 3),
    ("University", "school", 3), ("Police Station", "police station", 3), ("Post Office", "post office", 3), ("Monument", "monument", 3),
    ("Park", "park", 3), ("Bank", "bank", 2), ("ATM", "ATM", 2), ("Gas Station", "filling station", 2), ("Fuel", "filling station", 2),
    ("Pharmacy", "pharmacy", 2), ("Clinic", "clinic", 2), ("Church", "church", 2), ("Mosque", "mosque", 2), ("Restaurant", "eatery", 2),
    ("Café", "eatery", 2), ("Coffee", "eatery", 2), ("Bar", "eatery", 2), ("Fast Food", "eatery", 2), ("Bus Stop", "bus stop", 2),
]
# Words of names that are no landmarks.
NO_LANDMARK = r"(?iU)\b(room|gate|block|dept|department|unit|office|lab|laboratory|hostel|flat|floor|annex|dormitory|lecture|hall \d)\b|,|\d{3,}"


def label_category(label: Column) -> Column:
    """struct(cat, imp) of the first keyword that a label holds, whatever its case; null if none."""
    out = None
    for word, cat, imp in LABELS:
        value = F.struct(F.lit(cat).alias("cat"), F.lit(imp).alias("imp"))
        hit = F.lower(label).contains(word.lower())
        out = F.when(hit, value) if out is None else out.when(hit, value)
    return out


def classify(labels: Column) -> Column:
    """The category of the first label that has one."""
    return F.get(F.filter(F.transform(labels, label_category), lambda x: x.isNotNull()), F.lit(0))


def tag_category(tags: Column) -> Column:
    """struct(cat, imp) of a map of tags; rules in order, the first that holds counts.

    Fixed values: keys, values, categories and importances, and their order."""
    t = lambda k: tags[k]
    v = lambda cat, imp: F.struct(F.lit(cat).alias("cat") if isinstance(cat, str) else cat.alias("cat"), F.lit(imp).alias("imp"))
    a = t("amenity")
    return (
        F.when(a == "marketplace", v("market", 5)).when(a == "bus_station", v("lorry park", 5)).when(a == "hospital", v("hospital", 4)).when(a == "police", v("police station", 3))
        .when((a == "place_of_worship") & (t("religion") == "muslim"), v("mosque", 2)).when(a == "place_of_worship", v("church", 2))
        .when(a.isin("school", "university", "college"), v("school", 3)).when(a == "bank", v("bank", 2)).when(a == "fuel", v("filling station", 2))
        .when(t("junction") == "roundabout", v("roundabout", 4)).when(t("tourism").isin("attraction", "museum", "hotel"), v(t("tourism"), 3))
        .when(t("leisure").isin("stadium", "park"), v(t("leisure"), 4)).when(t("shop") == "mall", v("mall", 4)).when(t("railway") == "station", v("railway station", 4))
        .when(a == "pharmacy", v("pharmacy", 2)).when(a.isin("restaurant", "fast_food", "cafe", "bar", "pub"), v("eatery", 2)).when(a.isin("clinic", "doctors", "dentist"), v("clinic", 2))
        .when(a.isin("post_office", "townhall", "community_centre", "courthouse", "fire_station"), v(F.replace(a, F.lit("_"), F.lit(" ")), 3)).when(a == "atm", v("ATM", 2))
        .when((t("highway") == "bus_stop") | (t("public_transport") == "station"), v("bus stop", 2)).when(F.length(t("shop")) > 0, v("shop", 2))
        .when((F.length(t("building")) > 0) & (F.length(t("name")) > 0), v("building", 2)).when(t("place").isin("suburb", "neighbourhood", "town", "quarter"), v("area", 4))
    )


def kept_name(name: Column) -> Column:
    """Whether a squashed name may be a landmark's."""
    return (F.length(S.squash(name)) >= 4) & ~S.squash(name).rlike(NO_LANDMARK)


def best_by_name(rows: DataFrame, position: str = "pos") -> DataFrame:
    """One row for each trimmed lower-case name: the most important, ties to the first; ``pos`` is where the name came first."""
    key = F.lower(F.trim("name"))
    w = Window.partitionBy("_k")
    found = rows.withColumn("_k", key).where(F.length("_k") >= 3)
    ranked = found.withColumn("_n", F.row_number().over(w.orderBy(F.desc("imp"), position))).withColumn("first_pos", F.min(position).over(w))
    return ranked.where("_n = 1").drop("_n").withColumnRenamed("_k", "key")
