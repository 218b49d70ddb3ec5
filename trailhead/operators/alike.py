"""Texts alike by their words, found without comparing all with all.

Two lower-case texts are alike if ``fuzzy.token_set_score`` gives them ``least`` or more.  Let e be ``1 - least / 100`` and n the
length of a text's distinct words, joined by spaces.  Then either their joined words are alike, so that of a text's n + 1
pairs of neighbouring letters at most 4 e n / (1 + e) are lost; or the words they share make up nearly all of one of them, so
that this one's other words, with a space each, are at most 2 e n / (1 + e) long.  So it is enough to meet by a pair of letters
that is among the rarest of both (a number that exceeds the loss), or by a word that is among the rarest of one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trailhead.functions import fuzzy
from trailhead.functions import scalar as S
from trailhead.sources.stages import settled


def _words(low: Column) -> Column:
    return F.array_sort(F.array_distinct(S.words(low)))


def _letter_pairs(joined: Column) -> Column:
    padded = F.concat(F.lit(" "), joined, F.lit(" "))
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(joined) + 1), lambda i: F.substring(padded, i, 2)))


def _items(texts: DataFrame, letters: bool) -> DataFrame:
    """low, n, x, weight: the letter pairs or words (x) of each text, and what losing one costs."""
    joined = F.array_join(_words(F.col("low")), " ")
    x = _letter_pairs(joined) if letters else _words(F.col("low"))
    rows = texts.select("low", F.length(joined).alias("n"), F.explode(x).alias("x")).where("n > 0")
    return rows.withColumn("weight", F.lit(1) if letters else F.length("x") + 1)


def _rarest(items: DataFrame, counts: DataFrame, loss: float) -> DataFrame:
    """low, x and whether x is among the text's rarest, of which more than ``loss * n`` can't be lost."""
    order = Window.partitionBy("low").orderBy(F.coalesce("count", F.lit(0)), "x").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("weight").over(order), F.lit(0))
    return items.join(counts, "x", "left").select("low", "x", (before <= F.col("n") * loss + 1e-6).alias("rare"))


def _met(asked: DataFrame, known: DataFrame, least: float, letters: bool) -> DataFrame:
    """low, known: the pairs that meet by a rare pair of letters, or by a rare word; repeats are not dropped."""
    e = 1 - least / 100
    loss = (4 if letters else 2) * e / (1 + e)
    there = _items(known, letters)
    counts = there.groupBy("x").count()
    a = _rarest(_items(asked, letters), counts, loss)
    b = _rarest(there, counts, loss).withColumnsRenamed({"low": "known", "rare": "known_rare"})
    met = a.where("rare").join(b.where("known_rare"), "x").select("low", "known")
    if not letters:
        for mine, theirs in (("rare", "not known_rare"), ("not rare", "known_rare")):
            met = met.unionByName(a.where(mine).join(b.where(theirs), "x").select("low", "known"))
    return met


def pairs(asked: DataFrame, known: DataFrame, least: float = 90.0) -> DataFrame:
    """low, known: those pairs of texts (low of each table) that may be alike, all that are among them, each once."""
    return _met(asked, known, least, True).unionByName(_met(asked, known, least, False)).distinct()


def most_alike(names: DataFrame, landmarks: DataFrame, least: float = 90.0) -> DataFrame:
    """low, likeness, id, lat, lon: for each lower-case name the landmark (id, name, lat, lon) most alike, if alike enough; ties go to the smaller id.

    Pairs of likeness 100 hold all words of one text, so they meet by words.  Only the names without such a landmark meet others by
    letters, of which there are so few that most texts of one kind share some."""
    known = landmarks.groupBy(F.lower("name").alias("known")).agg(F.min(F.struct("id", "lat", "lon")).alias("place"))
    names, texts = names.distinct(), known.select(F.col("known").alias("low"))
    scored = lambda met: met.distinct().withColumn("likeness", fuzzy.token_set_ratio("low", "known")).where(F.col("likeness") >= least)
    by_words = settled(scored(_met(names, texts, least, False)))
    rest = settled(names.join(by_words.where("likeness = 100").select("low"), "low", "left_anti"))
    found = by_words.unionByName(scored(_met(rest, texts, least, True)))
    best = F.max_by(F.struct("likeness", "place"), F.struct("likeness", -F.col("place.id"))).alias("b")
    return found.join(known, "known").groupBy("low").agg(best).select("low", "b.likeness", "b.place.*")
