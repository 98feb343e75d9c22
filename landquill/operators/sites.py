"""Overrides, split expansion, allocation and totals of sites."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from landquill.shared import unsent

#: Fixed value: the reason of splits whose book values are more than their site's.
OVER_TOTAL = "split book values exceed the total"


def merge_same_name(sites: DataFrame) -> DataFrame:
    """Sites of one company and name as one: area and book value added up, the rest from the first by seq."""
    rest = [c for c in sites.columns if c not in ("code", "site_name", "area", "book")]
    merged = sites.groupBy("code", "site_name").agg(F.sum("area").alias("area"), F.sum("book").alias("book"), F.min_by(F.struct(*rest), F.col("seq")).alias("_rest"))
    return merged.select("code", "site_name", "area", "book", "_rest.*").select(sites.columns)


def expand_splits(sites: DataFrame, splits: DataFrame) -> DataFrame:
    """Replace each site that has splits by them; sites without stay.

    sites: code, site_name, seq, area, book, equipment, has_hoka. splits: code,
    site_name, pos, name, area, book (null: its share). Equal names are first
    merged. The book value that no split names is shared among the other splits
    by area, 0 without area. A split has no equipment and has_hoka false.
    Returns the sites' columns, pos, and reject_reason, set where the named
    values exceed the total. Splits without a site have no row. Where sites
    have a location, that of a split is its address.
    """
    totals = merge_same_name(sites).select("code", "site_name", F.col("seq").alias("_seq"), F.col("book").alias("_total"))
    hit = splits.select("code", "site_name").distinct()
    plain = sites.join(unsent(hit), ["code", "site_name"], "left_anti").withColumn("pos", F.lit(0).cast("int")).withColumn("reject_reason", F.lit(None).cast("string"))
    w = Window.partitionBy("code", "site_name")
    open_area = F.sum(F.when(F.col("book").isNull(), F.col("area"))).over(w)
    left = F.col("_total") - F.coalesce(F.sum("book").over(w), F.lit(0.0))
    joined = splits.join(unsent(totals), ["code", "site_name"]).withColumn("_left", left).withColumn("_open", open_area)
    share = F.when(F.coalesce(F.col("_open"), F.lit(0.0)) > 0, F.col("_left") * F.col("area") / F.col("_open")).otherwise(F.lit(0.0))
    has_open = F.col("_open").isNotNull()
    place = [F.col("address").alias("location")] if "location" in sites.columns else []
    made = joined.select(
        "code", *place, F.col("name").alias("site_name"), F.col("_seq").alias("seq"), "area", F.coalesce("book", share).alias("book"), F.lit("").alias("equipment"), F.lit(False).alias("has_hoka"), "pos",
        F.when(has_open & (F.col("_left") < 0), OVER_TOTAL).alias("reject_reason"),
    )
    return plain.select(made.columns).unionByName(made)


def flat_overrides(overrides: DataFrame, splits: DataFrame) -> DataFrame:
    """code, site_name, address: plain overrides of sites that aren't split, and the splits' own addresses, the last by pos."""
    keys = splits.select("code", "site_name").distinct()
    plain = overrides.select("code", "site_name", "address").join(unsent(keys), ["code", "site_name"], "left_anti").withColumn("_pos", F.lit(-1))
    own = splits.select("code", F.col("name").alias("site_name"), "address", F.col("pos").alias("_pos"))
    return plain.unionByName(own).groupBy("code", "site_name").agg(F.max_by("address", "_pos").alias("address"))


def filed_and_split(sites: DataFrame, splits: DataFrame, overrides: DataFrame, prices: DataFrame) -> DataFrame:
    """The rows of ``expand_splits`` with ``override``, their address in ``flat_overrides``, ``overridden``, whether they have a row there, and ``override_price``.

    The four tables are put together and sent once, by code; what is by code and
    name lies in the same task and is found there by windows, also later by whoever goes on with the rows.
    sites have a location. Several prices of a name make as many rows, as in ``price_overridden``.
    """
    kept = ["code", "site_name", "seq", "area", "book", "equipment", "has_hoka", "location"]
    own = splits.select("code", F.col("name").alias("site_name"), F.col("site_name").alias("_of"), "pos", "area", "book", F.col("address").alias("location"), F.lit(1).alias("_kind"))
    plain = overrides.select("code", "site_name", F.lit(-1).alias("pos"), F.col("address").alias("location"), F.lit(2).alias("_kind"))
    priced = prices.select("code", "site_name", F.col("unit_price").alias("_price"), F.lit(3).alias("_kind"))
    rows = sites.select(*kept, F.lit(0).alias("_kind"))
    for more in (own, plain, priced):
        rows = rows.unionByName(more, allowMissingColumns=True)
    site, split, price, placed = F.col("_kind") == 0, F.col("_kind") == 1, F.col("_kind") == 3, F.col("_kind").isin(1, 2)
    w = Window.partitionBy("code", "_of")
    rows = rows.repartition("code").withColumn("_of", F.when(split, F.col("_of")).otherwise(F.col("site_name"))).withColumns(
        {
            "_site": F.max(site).over(w), "_split": F.max(split).over(w), "_seq": F.min(F.when(site, F.col("seq"))).over(w), "_total": F.sum(F.when(site, F.col("book"))).over(w),
            "_named": F.sum(F.when(split, F.col("book"))).over(w), "_open": F.sum(F.when(split & F.col("book").isNull(), F.col("area"))).over(w),
        }
    )
    known = F.col("code").isNotNull() & F.col("_of").isNotNull()  # a key with a null is equal to none
    rows = rows.filter(split | price | ~(F.col("_split") & known))
    w = Window.partitionBy("code", "site_name")
    named = F.col("code").isNotNull() & F.col("site_name").isNotNull()
    rows = rows.withColumns({"override": F.max_by("location", F.when(placed, F.col("pos"))).over(w), "overridden": F.max(placed).over(w) & named, "_prices": F.collect_list("_price").over(w)})
    rows = rows.filter(site | (split & F.col("_site") & known))
    left = F.col("_total") - F.coalesce("_named", F.lit(0.0))
    share = F.when(F.coalesce("_open", F.lit(0.0)) > 0, left * F.col("area") / F.col("_open")).otherwise(F.lit(0.0))
    either = lambda of_split, c: F.when(split, of_split).otherwise(F.col(c)).alias(c)
    return rows.select(
        "code", "location", "site_name", either(F.col("_seq"), "seq"), "area", either(F.coalesce("book", share), "book"), either(F.lit(""), "equipment"), either(F.lit(False), "has_hoka"), F.when(split, F.col("pos")).otherwise(F.lit(0)).cast("int").alias("pos"),
        F.when(split & F.col("_open").isNotNull() & (left < 0), OVER_TOTAL).alias("reject_reason"), F.when(named, F.col("override")).alias("override"), "overridden", F.explode_outer(F.when(named, F.col("_prices"))).alias("override_price"),
    )


def addressed(rows: DataFrame) -> DataFrame:
    """``override``, ``web`` and ``url`` replaced by address, address_source and address_source_url: an override, else an accepted web address, else the filing's location."""
    source = F.when(F.col("override").isNotNull(), "override").when(F.col("web").isNotNull(), "web").otherwise("securities_report")
    out = rows.withColumns({"address": F.coalesce("override", "web", "location"), "address_source": source})
    return out.withColumn("address_source_url", F.when(F.col("address_source") == "web", F.coalesce("url", F.lit(""))).otherwise("")).drop("override", "web", "url")


def with_address(sites: DataFrame, overrides: DataFrame, web: DataFrame | None = None) -> DataFrame:
    """address, address_source and address_source_url: an override, else an accepted web address, else the filing's location.

    web: code, site_name, location, has_hoka, address, source_url; a site's own by all of the first four.
    """
    out = sites.join(unsent(overrides.select("code", "site_name", F.col("address").alias("override"))), ["code", "site_name"], "left")
    if web is None:
        out = out.withColumns({"web": F.lit(None).cast("string"), "url": F.lit(None).cast("string")})
    else:
        found = web.select("code", "site_name", F.col("location").alias("_l"), F.col("has_hoka").alias("_h"), F.col("address").alias("web"), F.col("source_url").alias("url")).alias("w")
        same = (F.col("s.code") == F.col("w.code")) & (F.col("s.site_name") == F.col("w.site_name")) & F.col("location").eqNullSafe(F.col("_l")) & F.col("has_hoka").eqNullSafe(F.col("_h"))
        out = out.alias("s").join(unsent(found), same, "left").select("s.*", "web", "url")
    return addressed(out)


def price_overridden(sites: DataFrame, prices: DataFrame) -> DataFrame:
    """override_price, null where none; rows with one need no estimate."""
    return sites.join(unsent(prices.select("code", "site_name", F.col("unit_price").alias("override_price"))), ["code", "site_name"], "left")


def company_totals(companies: DataFrame, valued: DataFrame) -> DataFrame:
    """One row for each company, with zeros without sites: n_sites, est, book, gain, multiple, cap_ratio.

    valued: code, est, book, est_raw. Sums of est and book are of rounded
    values; multiple (over book) and ratio (over market value) are of the raw estimate.
    """
    sums = valued.groupBy("code").agg(F.count(F.lit(1)).alias("n_sites"), F.sum("est").alias("est"), F.sum(F.bround("book", 0)).cast("long").alias("book"), F.sum("est_raw").alias("_e"), F.sum("book").alias("_b"))
    out = companies.join(unsent(sums), "code", "left").fillna(0, ["n_sites", "est", "book"]).fillna(0.0, ["_e", "_b"])
    return out.select(*companies.columns, "n_sites", "est", "book", (F.col("est") - F.col("book")).alias("gain"), F.when(F.col("_b") != 0, F.col("_e") / F.col("_b")).alias("multiple"), F.when(F.col("market_cap") != 0, F.col("_e") / F.col("market_cap")).alias("cap_ratio"))


def sites_and_totals(sites: DataFrame) -> DataFrame:
    """Site rows and one total row (is_total) for each company that has sites."""
    out = sites.groupingSets([["code", "site"], ["code"]], "code", "site").agg(F.grouping("site").alias("is_total"), F.sum("est").alias("est"), F.sum("book").alias("book"))
    return out


def repeated_address_warning(sites: DataFrame, least: float = 50_000.0, counted: Column | None = None) -> DataFrame:
    """repeated_large: two or more sites of a company at one address with an area, together of ``least`` square metres; of the ``counted`` sites only, if these are given."""
    w = Window.partitionBy("code", "address")
    area = F.round("area", 2)
    area = area if counted is None else F.when(counted, area)
    rule = (F.count(area).over(w) >= 2) & (F.sum(area).over(w) >= least)
    return sites.withColumn("repeated_large", F.coalesce(rule & area.isNotNull() & F.col("address").isNotNull(), F.lit(False)))
