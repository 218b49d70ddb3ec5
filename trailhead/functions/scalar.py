"""Column builders: geometry, rounding, text normalisation, hashing.  All stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Compass points clockwise from north.
POINTS = ["north", "north-east", "east", "south-east", "south", "south-west", "west", "north-west"]


def great_circle(lat1, lon1, lat2, lon2) -> Column:
    """Haversine distance in metres."""
    up, over = F.sin(F.radians(lat2 - lat1) / 2), F.sin(F.radians(lon2 - lon1) / 2)
    return F.lit(12742000.0) * F.asin(F.sqrt(up * up + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * over * over))


def planar(lat1, lon1, lat2, lon2) -> Column:
    """Metres on the plane that touches the globe at the first point."""
    dy, dx = (lat2 - lat1) * 111000.0, (lon2 - lon1) * 111000.0 * F.cos(F.radians(lat1))
    return F.sqrt(dy * dy + dx * dx)


def heading(lat1, lon1, lat2, lon2) -> Column:
    """Initial bearing, 0 to 360 degrees."""
    turn, a, b = F.radians(lon2 - lon1), F.radians(lat1), F.radians(lat2)
    y, x = F.sin(turn) * F.cos(b), F.cos(a) * F.sin(b) - F.sin(a) * F.cos(b) * F.cos(turn)
    return (F.degrees(F.atan2(y, x)) + 360.0) % 360.0


def compass(bearing: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, POINTS)), (F.floor((bearing + 22.5) / 45.0) % 8 + 1).cast("int"))


def spoken_metres(m: Column) -> Column:
    """To 10 m under a kilometre, else to 50 m, half to even; never zero."""
    whole = F.when(m < 1000, F.bround(m / 10) * 10).otherwise(F.bround(m / 50) * 50).cast("int")
    return F.when(whole == 0, 10).otherwise(whole)


def turn_angle(after: Column, before: Column) -> Column:
    return (after - before + 540.0) % 360.0 - 180.0


def turn_name(d: Column) -> Column:
    return (
        F.when(F.abs(d) < 25, "straight").when(d >= 135, "sharp right").when(d >= 60, "right").when(d >= 25, "slight right")
        .when(d > -60, "slight left").when(d > -135, "left").otherwise("sharp left")
    )


def side(d: Column, least: float, most: float) -> Column:
    return F.when((d > least) & (d < most), "right").when((d < -least) & (d > -most), "left").otherwise("ahead")


def plain(s: Column) -> Column:
    """Lower case, hyphens as spaces, letters a-z, digits and spaces only."""
    return F.trim(F.regexp_replace(F.replace(F.lower(s), F.lit("-"), F.lit(" ")), "[^a-z0-9 ]", ""))


def words(s: Column) -> Column:
    return F.filter(F.split(s, r"(?U)\s+"), lambda w: w != "")


def squash(s: Column) -> Column:
    return F.array_join(words(s), " ")


def md5_mod(s: Column, m: int) -> Column:
    """The 128-bit md5 of a text modulo ``m``."""
    h, out = F.md5(s.cast("binary")), F.lit(0).cast("long")
    for at in (1, 9, 17, 25):
        out = (out * ((1 << 32) % m) + F.conv(F.substring(h, at, 8), 16, 10).cast("long")) % m
    return out


def near_word(m: Column) -> Column:
    """Bounds and wording."""
    return F.when(m < 60, "right beside it").when(m < 250, "a short walk away").otherwise("a bit further on")


def first_year(date: Column) -> Column:
    return F.coalesce(F.substring(date, 1, 4).try_cast("int"), F.lit(0))
