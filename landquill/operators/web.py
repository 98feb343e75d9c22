"""Addresses of sites from web pages and sections of filings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landquill.functions.mining import address_index, indexed_score, site_keys
from landquill.functions.valuation import accepts_web_address
from landquill.shared import fresh, unsent


def page_entries(pages: DataFrame) -> DataFrame:
    """url, entries: the addresses of each page, with the little that scoring needs of its text.

    pages: url, text. A page is mined where it is read; texts are in no shuffle. Of several texts of
    one url that with the smallest md5 counts, also if it has no address.
    """
    mined = pages.filter("url IS NOT NULL").select("url", F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("digest"), F.coalesce(address_index(F.col("text")), F.array()).alias("entries"))
    return mined.groupBy("url").agg(F.min_by("entries", "digest").alias("entries"))


def page_index(pages: DataFrame) -> DataFrame:
    """url, entry: one row for each of ``page_entries``."""
    return page_entries(pages).select("url", F.explode("entries").alias("entry"))


def _placing(keys: Column, entry: Column, at: Column, url: Column) -> Column:
    """What candidates are ordered by: the higher score, the smaller address, the page named first."""
    return F.struct((-indexed_score(keys, entry)).alias("worse"), entry["address"].alias("address"), at.alias("at"), url.alias("source_url"))


def best_addresses(sites: DataFrame, pages: DataFrame, least: int = 40) -> DataFrame:
    """For each site the candidate of the highest score on its pages: the site's columns, address, score, source_url, accepted.

    sites: code, site_name, location, has_hoka, source_urls (array), and any more columns; equal rows
    count once. pages: url, text. Of equal scores the smaller address counts, then the
    page named first. ``accepted``: the site isn't several sites in one and
    the score is ``least`` or more. Sites without a candidate have no row.
    """
    keys = [c for c in sites.columns if c != "source_urls"]
    key, at, url = fresh([*sites.columns, "entry"], "keys", "at", "url")
    asked = sites.withColumn(key, site_keys(F.col("site_name"), F.col("location"))).select(*keys, key, F.posexplode("source_urls").alias(at, url))
    index = page_index(pages).withColumnRenamed("url", f"{url}_of")
    scored = asked.join(unsent(index), F.col(url) == F.col(f"{url}_of"))
    best = scored.groupBy(*keys).agg(F.min(_placing(F.col(key), F.col("entry"), F.col(at), F.col(url))).alias(key))
    score = -F.col(f"{key}.worse")
    accepted = accepts_web_address(F.col("site_name"), F.coalesce("has_hoka", F.lit(False)), score, least)
    return best.select(*keys, f"{key}.address", score.alias("score"), f"{key}.source_url", accepted.alias("accepted"))


def company_pages(companies: DataFrame, pages: DataFrame) -> DataFrame:
    """code, named: the pages with addresses that a company names, as structs of at, url and entries.

    companies: code, source_urls (array). Sites that look on their company's pages
    only needn't be sent to the pages; see ``accepted_address``.
    """
    asked = companies.select("code", F.posexplode("source_urls").alias("at", "url"))
    index = page_entries(pages).filter(F.size("entries") > 0).withColumnRenamed("url", "_url")
    return asked.join(unsent(index), F.col("url") == F.col("_url")).groupBy("code").agg(F.collect_list(F.struct("at", "url", "entries")).alias("named"))


def accepted_address(sites: DataFrame, asks: Column, least: int = 40) -> DataFrame:
    """sites with web and url, address and page of what ``best_addresses`` would accept for those that ``asks`` holds for, without ``named``.

    sites: site_name, location, has_hoka and ``named`` of ``company_pages``.
    """
    keyed = sites.withColumn("_keys", F.when(asks & F.col("named").isNotNull(), site_keys(F.col("site_name"), F.col("location"))))
    every = F.flatten(F.transform("named", lambda page: F.transform(page["entries"], lambda entry: _placing(F.col("_keys"), entry, page["at"], page["url"]))))
    best = keyed.withColumn("_best", F.when(F.col("_keys").isNotNull(), F.array_min(every))).drop("named", "_keys")
    accepted = F.col("_best").isNotNull() & accepts_web_address(F.col("site_name"), F.coalesce("has_hoka", F.lit(False)), -F.col("_best.worse"), least)
    return best.withColumns({"web": F.when(accepted, F.col("_best.address")), "url": F.when(accepted, F.col("_best.source_url"))}).drop("_best")
