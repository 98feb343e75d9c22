"""Three-level geocoding as equi joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landquill.functions.address import normalize_addr, oaza_name, parse_town, split_municipality

#: Characters of a municipality's name at most.
MUNI_LENGTH = 12


def block_index(rows: DataFrame, prefecture: str = "東京都") -> DataFrame:
    """muni, town, block, lat, lon: of each block the row with the flags set, then the smallest coordinates.

    rows: pref, muni, town, block, rep_flag, addr_flag, lat, lon, all as text.
    Rows of other prefectures or without coordinates are left out, bad flags
    count as 0. Town names are normalised like addresses.
    """
    lat, lon = F.col("lat").try_cast("double"), F.col("lon").try_cast("double")
    flag = lambda c: -F.coalesce(F.col(c).try_cast("int"), F.lit(0))
    good = rows.filter((F.col("pref") == prefecture) & lat.isNotNull() & lon.isNotNull())
    best = good.groupBy("muni", normalize_addr(F.col("town")).alias("town"), "block").agg(F.min(F.struct(flag("rep_flag").alias("r"), flag("addr_flag").alias("a"), lat.alias("lat"), lon.alias("lon"))).alias("b"))
    return best.select("muni", "town", "block", "b.lat", "b.lon")


def town_index(rows: DataFrame, prefecture: str = "東京都") -> DataFrame:
    """muni, town, lat, lon: the smallest coordinates of each town."""
    lat, lon = F.col("lat").try_cast("double"), F.col("lon").try_cast("double")
    good = rows.filter((F.col("pref") == prefecture) & lat.isNotNull() & lon.isNotNull())
    return good.groupBy("muni", normalize_addr(F.col("town")).alias("town")).agg(F.min(F.struct(lat.alias("lat"), lon.alias("lon"))).alias("b")).select("muni", "town", "b.lat", "b.lon")


def centroid_index(rows: DataFrame, prefecture: str = "東京都") -> DataFrame:
    """muni, lat, lon: the mean of a municipality's rows."""
    good = rows.filter(F.col("pref") == prefecture).select("muni", F.col("lat").try_cast("double").alias("lat"), F.col("lon").try_cast("double").alias("lon")).filter("lat IS NOT NULL AND lon IS NOT NULL")
    return good.groupBy("muni").agg(F.avg("lat").alias("lat"), F.avg("lon").alias("lon"))


def geocode(addresses: DataFrame, blocks: DataFrame, towns: DataFrame, centroids: DataFrame, muni_match: str = "pattern") -> DataFrame:
    """lat, lon, level for each different address; the first level that knows it: gaiku, oaza_chome, muni_centroid.

    addresses: address. Each one becomes ordered candidate keys, joined with
    the level's table by equality, and the first hit counts. With 丁目 and a
    block the town may also be the plain one with the 丁目 number as block.
    Unresolved and foreign addresses have null lat, lon and level.
    ``muni_match="dimension"`` takes the longest municipality of the tables
    instead of the shortest prefix that looks like one.
    """
    base = addresses.select("address").distinct()
    parts = base.select("address", split_municipality(F.col("address")).alias("m"), parse_town(F.col("address")).alias("t"))
    if muni_match == "dimension":
        # Every beginning of an address that may be a municipality meets the table by equality; the longest counts.
        named = parts.select("address", "m", "t", normalize_addr(F.col("address")).alias("_a"))
        starts = named.filter(F.startswith("_a", F.lit("東京都"))).select("address", F.explode(F.transform(F.sequence(F.lit(1), F.lit(MUNI_LENGTH)), lambda n: F.substring(F.col("_a"), F.lit(4), n))).alias("_m")).distinct()
        longest = starts.join(centroids.select(F.col("muni").alias("_m")).distinct(), "_m").groupBy("address").agg(F.max_by("_m", F.length("_m")).alias("_m"))
        named = named.join(longest, "address", "left")
        rest = F.concat(F.lit("東京都外区"), F.substring("_a", F.lit(4) + F.length("_m"), F.length("_a")))
        parts = named.select("address", F.when(F.col("_m").isNull(), F.col("m")).otherwise(F.struct(F.col("_m").alias("muni"), F.col("m.rest").alias("rest"))).alias("m"), F.when(F.col("_m").isNull(), F.col("t")).otherwise(parse_town(rest)).alias("t"))
    p = parts.select("address", F.col("m.muni").alias("muni"), F.col("t.town").alias("town"), F.col("t.chome").alias("chome"), F.col("t.block").alias("block"))
    named = F.when(F.col("chome").isNotNull(), normalize_addr(oaza_name(F.col("town"), F.col("chome"))))
    text = lambda c: F.col(c).cast("string")
    key = lambda prio, town, block: F.struct(F.lit(prio).alias("prio"), town.alias("town"), block.alias("block"))
    has_both = F.col("chome").isNotNull() & F.col("block").isNotNull() & (F.col("chome") <= 99)
    block_keys = F.array_compact(
        F.array(F.when(has_both, key(0, named, text("block"))), F.when(has_both, key(1, F.col("town"), text("chome"))), F.when(F.col("chome").isNull() & F.col("block").isNotNull(), key(0, F.col("town"), text("block"))))
    )
    town_keys = F.array_compact(F.array(F.when(named.isNotNull(), key(0, named, F.lit(None).cast("string"))), F.when(F.col("town").isNotNull(), key(1, F.col("town"), F.lit(None).cast("string")))))

    def level(keys, table: DataFrame, on: list[str], name: str) -> DataFrame:
        asked = p.filter("muni IS NOT NULL").select("address", "muni", F.explode(keys).alias("k")).select("address", "muni", "k.*")
        rule = (asked["muni"] == table["muni"]) & (asked["town"] == table["town"])
        rule = rule & (asked["block"] == table["block"]) if "block" in on else rule
        return asked.join(table, rule).groupBy(asked["address"]).agg(F.min_by(F.struct(table["lat"], table["lon"]), F.col("prio")).alias(name))

    b, t = level(block_keys, blocks, ["town", "block"], "b"), level(town_keys, towns, ["town"], "t")
    c = centroids.select("muni", F.struct("lat", "lon").alias("c"))
    out = p.join(b, "address", "left").join(t, "address", "left").join(c, "muni", "left")
    hit = F.coalesce("b", "t", "c")
    return out.select("address", hit["lat"].alias("lat"), hit["lon"].alias("lon"), F.when(F.col("b").isNotNull(), "gaiku").when(F.col("t").isNotNull(), "oaza_chome").when(F.col("c").isNotNull(), "muni_centroid").alias("level"))
