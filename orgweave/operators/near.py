"""Pairs of places within a distance, on the whole sphere."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geo import RADIUS_KM, haversine_by
from ..scratch import written
from .hot import ROWS, by_shuffle

#: Places of a cell, and places sent there, that are compared in one go at most; fuller cells are
#: dealt out as tiles.
DENSE = 10_000


def _band(lat: Column, height: float) -> Column:
    return F.floor((F.greatest(F.lit(-90.0), F.least(F.lit(90.0), lat)) + 90) / height).cast("int")


def _cells(band: Column, height: float) -> Column:
    """Cells of a band, about as wide as high where the band is widest; one at a pole."""
    low, high = band * height - 90, (band + 1) * height - 90
    # the circle nearest to the equator is the longest
    widest = F.when((low <= 0) & (high >= 0), 0.0).otherwise(F.least(F.abs(low), F.abs(high)))
    return F.greatest(F.lit(1), F.floor(F.cos(F.radians(F.least(widest, F.lit(90.0)))) * (360 / height))).cast("int")


def _longitude(lon: Column) -> Column:
    """Degrees east of the date line, from 0 to less than 360."""
    return F.pmod(lon + 180, F.lit(360.0))


def _one_turn(lon: Column) -> Column:
    """lon from -180 to less than 180; what is there already stays as it is, to the last bit."""
    return F.when((lon >= -180) & (lon < 180), lon).otherwise(_longitude(lon) - 180)


def place_classes(places: DataFrame) -> DataFrame:
    """places (id, lat, lon) by coordinates: (rep, lat, lon, n), rep the least id. Places without
    coordinates or beyond the sphere are left out; longitudes that mean the same are one, and
    at a pole all are."""
    ok = places.where("abs(lat) <= 90 AND abs(lon) <= 360")
    lon = F.when(F.abs("lat") == 90, 0.0).otherwise(_one_turn(F.col("lon")))
    return ok.groupBy((F.col("lat") + 0.0).alias("lat"), (lon + 0.0).alias("lon")).agg(F.min("id").alias("rep"), F.count("*").alias("n")).select("rep", "lat", "lon", "n")


def near_pairs(classes: DataFrame, km: float) -> DataFrame:
    """(a, b, n_a, n_b, km): pairs a < b of place_classes() at most km apart, each once, and how
    many places either class has; places of one class are 0 km apart and aren't listed.

    The sphere is cut into bands twice km high and these into cells. A place lies in one cell,
    and is sent to all cells that its surroundings touch: over the date line, and around a
    pole all of them, which are few there. So a pair meets in the cell of a, once, and is
    verified. Pairs can be very many and are shuffled nowhere; so places bring along what is
    told of them. Cells that more than DENSE places are sent to are dealt out by both ids, as
    tiles, and all to several tasks a core, as cells make more or less of their rows. classes
    is read more than once and should be a written table.
    """
    height = min(180.0, math.degrees(km / RADIUS_KM) * (1 + 1e-9) + 1e-9)
    angle, side = math.radians(height), 2 * height
    own = F.floor(_longitude(F.col("lon")) / 360 * _cells(F.col("band"), side)).cast("int")
    a = classes.withColumn("band", _band(F.col("lat"), side)).withColumn("cell", F.least(own, _cells(F.col("band"), side) - 1))
    b = classes.withColumn("band", F.explode(F.sequence(_band(F.col("lat") - height, side), _band(F.col("lat") + height, side))))
    # how far east and west a place within km can lie; around a pole anywhere
    pole = F.abs("lat") + height >= 90
    reach = F.when(pole, 180.0).otherwise(F.degrees(F.asin(F.least(F.lit(1.0), F.sin(F.lit(min(angle, math.pi / 2))) / F.cos(F.radians("lat")))))) + 1e-9
    n = _cells(F.col("band"), side)
    first, last = F.floor((_longitude(F.col("lon")) - reach) / 360 * n), F.floor((_longitude(F.col("lon")) + reach) / 360 * n)
    every = F.when(last - first + 1 >= n, F.sequence(F.lit(0).cast("bigint"), (n - 1).cast("bigint"))).otherwise(F.transform(F.sequence(first, last), lambda c: F.pmod(c, n.cast("bigint"))))
    b = b.withColumn("cell", F.explode(every.cast("array<int>"))).select(F.col("rep").alias("b"), F.col("n").alias("n_b"), F.col("lat").alias("lat2"), F.col("lon").alias("lon2"), "band", "cell")

    # every place is sent to its own cell too, so a cell has the more of those
    of = lambda df, name: df.groupBy("band", "cell").agg(F.ceil(F.count("*") / DENSE).cast("int").alias(name))
    dense = F.broadcast(of(a, "of_a").join(of(b, "of_b").where("of_b > 1"), ["band", "cell"]))  # a few for DENSE classes at most

    def dealt(df: DataFrame, key: str, own: str, other: str) -> DataFrame:
        one = F.pmod(F.xxhash64(key), F.coalesce(f"of_{own}", F.lit(1))).cast("int").alias(f"in_{own}")
        each = F.explode(F.sequence(F.lit(0), F.coalesce(f"of_{other}", F.lit(1)) - 1)).alias(f"in_{other}")
        return df.join(dense, ["band", "cell"], "left").select(*df.columns, one, each).repartition(tasks, *keys)

    keys = ["band", "cell", "in_a", "in_b"]
    tasks = max(16 * classes.sparkSession.sparkContext.defaultParallelism, 4 * classes.count() // ROWS + 1)  # a place is sent to four cells or so
    a = dealt(a.select(F.col("rep").alias("a"), F.col("n").alias("n_a"), "lat", "lon", "band", "cell"), "a", "a", "b")
    b = dealt(b, "b", "b", "a")
    # worked out for each place, behind the shuffle, and not for each pair
    a, b = a.withColumn("p", F.radians("lat")).withColumn("cos_p", F.cos("p")), b.withColumn("q", F.radians("lat2")).withColumn("cos_q", F.cos("q"))
    d = haversine_by(*(F.col(c) for c in ("p", "cos_p", "lon", "q", "cos_q", "lon2")))
    met = a.join(by_shuffle(b), keys).where("a < b").where(F.abs(F.col("p") - F.col("q")) <= angle).withColumn("km", d)
    return met.where(F.col("km") <= km).select("a", "b", "n_a", "n_b", "km")


def near(places: DataFrame, km: float) -> tuple[DataFrame, DataFrame]:
    """(members, pairs) of places (id, lat, lon): members (id, rep, n) tells each place's class
    of equal coordinates and its size, pairs links classes (a, b, km). Null and impossible
    coordinates are in neither."""
    classes = written(place_classes(places))
    lon = F.when(F.abs("lat") == 90, 0.0).otherwise(_one_turn(F.col("lon"))) + 0.0
    ids = places.select("id", (F.col("lat") + 0.0).alias("lat"), lon.alias("lon"))
    return ids.join(classes, ["lat", "lon"]).select("id", "rep", "n"), near_pairs(classes, km).select("a", "b", "km")
