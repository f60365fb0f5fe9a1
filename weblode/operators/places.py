"""Location lookup in a gazetteer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weblode.operators.joins import looked_up
from weblode.session import stored, work_path

# A gazetteer of at most this many bytes of names is broadcast.
BROADCAST_BYTES = 128 << 20


def place_key(text: Column) -> Column:
    return F.lower(F.trim(text))


def gazetteer_by_name(cities: DataFrame) -> DataFrame:
    """One place per lower-cased name, the one with the least id."""
    place = F.struct(
        "geonameid", F.concat_ws(", ", "name", F.nullif("subcountry", F.lit("")), "country").alias("place")
    )
    return (
        cities.groupBy(place_key(F.col("name")).alias("place_key"))
        .agg(F.min_by(place, "geonameid").alias("hit"))
        .select("place_key", "hit.geonameid", "hit.place")
    )


def locate(records: DataFrame, column: str, cities: DataFrame) -> DataFrame:
    """Replace a place text by the gazetteer's ``name, subcountry, country``; unknown places become NULL.

    The gazetteer is reduced, stored and measured first: if it is small it is broadcast and the
    records stay where they are, otherwise places that many records share are looked up apart.
    """
    spark = records.sparkSession
    reduced = gazetteer_by_name(cities).select("place_key", F.col("place").alias("known_place"))
    known = stored(reduced, work_path(spark, "gazetteer"))
    size = known.agg(F.sum(F.octet_length("place_key") + F.octet_length("known_place"))).first()[0] or 0
    keyed = records.withColumn("place_key", place_key(F.col(column)))
    if size <= BROADCAST_BYTES:
        found = keyed.join(F.broadcast(known), "place_key", "left")
    else:
        # The rows are read more than once, so they are not extracted more than once.
        found = looked_up(stored(keyed, work_path(spark, "places")), known, ["place_key"], "known_place")
    return found.select(*[F.col("known_place").alias(c) if c == column else F.col(c) for c in records.columns])
