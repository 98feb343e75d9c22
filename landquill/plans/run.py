"""The whole valuation run: from sites of filings to the rows of the output contract."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from landquill.functions import valuation as fv
from landquill.functions.geo import plane_xy
from landquill.operators import geocode, knn, master, ranking, sites, web
from landquill.shared import checkpointed, stored, unsent

#: The columns of the output, in order, by the names that they have here.
OUTPUT_COLUMNS = {
    "code": "証券コード",
    "company_name": "企業名",
    "site_name": "事業所名",
    "address": "住所",
    "address_source": "住所取得元",
    "address_source_url": "住所取得元URL",
    "level": "住所解決レベル",
    "area": "土地面積(m2)",
    "unit_price": "地価単価(円/m2)",
    "factor": "地価単価補正係数",
    "geocode_factor": "住所解像度補正係数",
    "method": "地価単価算出方法",
    "target_kind": "基準用途区分",
    "nearest_kind": "最近傍用途区分",
    "nearest_id": "公示点ID",
    "nearest_dist": "公示点距離(m)",
    "knn_ids": "k近傍ID",
    "knn_kinds": "k近傍用途区分",
    "knn_dist": "k近傍距離(m)",
    "knn_prices": "k近傍単価(円/m2)",
    "variance": "k近傍距離分散(m2)",
    "max_dist": "k近傍最遠距離(m)",
    "score": "地価推定信頼度スコア",
    "label": "地価推定信頼度",
    "warnings": "異常値警告",
    "est": "推定土地時価(円)",
    "book": "土地簿価(円)",
    "gain": "含み益(円)",
    "multiple_raw": "評価倍率(実値)",
    "multiple": "評価倍率",
    "market_cap": "時価総額(円)",
    "ratio_raw": "時価総額比(実値)",
    "ratio": "時価総額比",
}
#: Fixed value: the name of a company's total row.
TOTAL = "東京都合計"
#: What a company or a site can be refused for, by the stage that finds it; the first that holds counts.
NO_NAME, NO_FILING, NO_MARKET_VALUE, NO_TARGET, OVER_ALLOCATED, ELSEWHERE, UNRESOLVED = (
    "missing name", "missing filing", "missing market value", "no target", "split book values exceed the total", "outside the region", "unresolved address",
)
STAGES = {"company": [NO_NAME, NO_FILING, NO_MARKET_VALUE], "site_company": [NO_NAME, NO_FILING, NO_MARKET_VALUE, NO_TARGET], "split": [OVER_ALLOCATED], "region": [ELSEWHERE], "geocode": [UNRESOLVED]}


class Traced(NamedTuple):
    """companies and sites with ``reason`` (null: accepted), and the number of each outcome as {(item, stage, reason): n}."""

    companies: DataFrame
    sites: DataFrame
    counters: dict[tuple[str, str, str], int]


def company_reasons(targets: DataFrame, filings: DataFrame | None = None) -> DataFrame:
    """targets (code, company_name, market_cap) with ``reason``: no name, no filing (if ``filings``, of code, are given), no market value."""
    if filings is None:
        known, has_filing = targets.withColumn("_filed", F.lit(True)), F.lit(True)
    else:
        known = targets.join(unsent(filings.select("code").distinct().withColumn("_filed", F.lit(True))), "code", "left")
        has_filing = F.col("_filed").isNotNull()
    rules = [(NO_NAME, master.is_placeholder(F.col("company_name"), F.col("code"))), (NO_FILING, ~has_filing), (NO_MARKET_VALUE, F.col("market_cap").isNull())]
    reason = F.coalesce(*[F.when(F.coalesce(rule, F.lit(False)), name) for name, rule in rules])
    return known.withColumn("reason", reason).drop("_filed")


def site_reasons(companies: DataFrame, rows: DataFrame, overrides: DataFrame, splits: DataFrame, price_overrides: DataFrame, blocks: DataFrame, towns: DataFrame, centroids: DataFrame, pages: DataFrame | None = None, region: str = "東京都") -> DataFrame:
    """Every filed site after its splits, with its company's columns, address, override_price, family, lat, lon, level, stage and reason.

    companies: as from ``company_reasons``, or accepted ones without ``reason``. pages: url, text; with them the sites in the
    region that have no override look for an address on their company's ``source_urls``. A
    site without ``reason`` goes on; the others lie outside or can't be valued, and ``stage`` says where that was found.
    ``repeated_large`` is that of ``sites.repeated_address_warning`` over the sites that go on.
    Sites, splits, overrides and prices are sent once each, by code.
    """
    known = companies if "reason" in companies.columns else companies.withColumn("reason", F.lit(None).cast("string"))
    asking = known.filter("reason IS NULL AND source_urls IS NOT NULL").select("code", "source_urls") if pages is not None else None
    known = known.withColumn("_target", F.lit(True)).withColumnRenamed("reason", "_company_reason").drop("source_urls")
    if asking is not None:
        known = known.join(unsent(web.company_pages(asking, pages)), "code", "left")
    every = sites.filed_and_split(rows, splits, overrides, price_overrides).join(unsent(known), "code", "left")  # by code, and so is all up to the end of this pass
    by_company = F.coalesce("_company_reason", F.when(F.col("_target").isNull(), NO_TARGET))
    outside = F.when(F.coalesce(~F.startswith("location", F.lit(region)), F.lit(True)), ELSEWHERE)
    stage = F.when(by_company.isNotNull(), "company").when(F.col("reject_reason").isNotNull(), "split").when(outside.isNotNull(), "region")
    every = every.withColumns({"stage": stage, "reason": F.coalesce(by_company, F.when(F.col("reject_reason").isNotNull(), OVER_ALLOCATED), outside)}).drop("reject_reason", "_company_reason", "_target")
    accepted = F.col("reason").isNull()
    if asking is None:
        every = every.withColumns({"web": F.lit(None).cast("string"), "url": F.lit(None).cast("string")})
    else:
        every = web.accepted_address(every, accepted & F.col("site_name").isNotNull() & ~F.col("overridden"))
    # Whether a site is resolved depends on its address alone, so those that share one go on together or not at all.
    local = sites.repeated_address_warning(sites.addressed(every.drop("overridden")), counted=accepted)
    local = stored(local.withColumn("family", fv.equipment_family(F.col("equipment"))))
    where = geocode.geocode(local.filter("reason IS NULL"), blocks, towns, centroids).filter("level IS NOT NULL")
    local = local.join(_counted_side(where), "address", "left")
    lost = F.col("reason").isNull() & F.col("level").isNull()
    return local.withColumns({"stage": F.when(lost, "geocode").otherwise(F.col("stage")), "reason": F.when(lost, UNRESOLVED).otherwise(F.col("reason"))})


def _counted_side(rows: DataFrame) -> DataFrame:
    """rows, made once, for a join with many more: sent to all tasks if they are few, so that keys that many rows share aren't shuffled, else not."""
    kept, seen = knn._kept(rows, n=F.count(F.lit(1)))
    return knn._few(kept, seen["n"])


def _counted(rows: DataFrame, item: str, stages: dict[str, list[str]], stage: Column) -> tuple[DataFrame, dict[tuple[str, str, str], int]]:
    """rows, written once, and how many there are of each outcome, counted while they are written."""
    outcomes = [("", "")] + [(s, r) for s, reasons in stages.items() for r in reasons]
    seen = Observation(item)
    counts = [F.count_if(F.col("reason").isNull() if not r else (stage == s) & (F.col("reason") == r)).alias(f"n{k}") for k, (s, r) in enumerate(outcomes)]
    kept = stored(rows.observe(seen, *counts))
    return kept, {(item, s, r): seen.get[f"n{k}"] for k, (s, r) in enumerate(outcomes)}


def trace(
    targets: DataFrame, rows: DataFrame, overrides: DataFrame, splits: DataFrame, price_overrides: DataFrame, blocks: DataFrame, towns: DataFrame, centroids: DataFrame, filings: DataFrame | None = None, pages: DataFrame | None = None, region: str = "東京都"
) -> Traced:
    """One pass over companies and filed sites that says of each whether it goes on, and if not, where and why.

    Companies and sites are written once each; what goes on, the rejects and the
    counters, which are taken while the rows are written, all come from those two tables.
    """
    companies, by_company = _counted(company_reasons(targets, filings), "company", {"company": STAGES["company"]}, F.lit("company"))
    every = site_reasons(companies, rows, overrides, splits, price_overrides, blocks, towns, centroids, pages, region)
    stages = {"company" if s == "site_company" else s: r for s, r in STAGES.items() if s != "company"}
    tagged, by_site = _counted(every, "site", stages, F.col("stage"))
    return Traced(companies, tagged, by_company | by_site)


def rejects(run: Traced) -> DataFrame:
    """stage, code, site_name, seq, pos, reason of each company (without a site) and each site that doesn't go on."""
    none = F.lit(None)
    companies = run.companies.filter("reason IS NOT NULL").select(F.lit("company").alias("stage"), "code", none.cast("string").alias("site_name"), none.cast("long").alias("seq"), none.cast("int").alias("pos"), "reason")
    return companies.unionByName(run.sites.filter("reason IS NOT NULL").select("stage", "code", "site_name", F.col("seq").cast("long").alias("seq"), "pos", "reason"))


def report(run: Traced) -> DataFrame:
    """item (company or site), stage, reason, n: the run's counters that aren't zero; those accepted have an empty stage and reason."""
    counted = [(item, stage, reason, n) for (item, stage, reason), n in run.counters.items() if n]
    return run.sites.sparkSession.createDataFrame(counted, "item string, stage string, reason string, n long")




def placed(points: DataFrame) -> DataFrame:
    """points or queries with x and y in the plane of the search."""
    return points.withColumn("_p", plane_xy(F.col("lat"), F.col("lon"))).withColumns({"x": F.col("_p.x"), "y": F.col("_p.y")}).drop("_p")


def estimates(places: DataFrame, points: DataFrame, k: int = 3, power: float = 3.0, eps: float = 1.0, far: float = 1500.0, landuse_match: bool = True) -> DataFrame:
    """lat, lon, family of each different place with target_kind and the estimate of ``knn.idw``.

    The nearest point of the family, or of all points beyond ``far`` metres and
    without a family, gives the kind of land use among whose points the k
    nearest are sought; without ``landuse_match`` they are sought among all points. Distances are on the ellipsoid.
    """
    asked = places.select("lat", "lon", "family").distinct().withColumn("query_id", F.to_json(F.struct("lat", "lon", "family")))
    asked = checkpointed(placed(asked))
    if landuse_match:
        scoped = checkpointed(knn.with_scopes(placed(points)))
        if scoped.count() * asked.count() > knn.BROADCAST_PAIRS:  # three searches over the same points
            scoped = knn.point_tree(scoped, k)
        seed = knn.nearest_with_fallback(asked, scoped, far=far, join=knn.geodesic_knn_join).select("query_id", F.col("kind").alias("target_kind"))
        seeded = checkpointed(asked.join(seed, "query_id"))
        wanted = knn.known_scope(seeded, scoped, "target_kind")
    else:
        scoped = placed(points).withColumn("scope", F.lit(""))
        seeded = asked.withColumn("target_kind", F.lit(""))
        wanted = seeded.withColumn("scope", F.lit(""))
    found = knn.idw(knn.geodesic_knn_join(wanted, scoped, k), power=power, eps=eps)
    return seeded.select("query_id", "lat", "lon", "family", "target_kind").join(found, "query_id").drop("query_id")


def method_name(price_method: str, k: int, power: int, landuse_match: bool) -> str:
    """Fixed format: how a price was found."""
    return ("nearest" if price_method == "nearest" else f"idw(k={k},p={power})") + ("+landuse_match" if landuse_match else "")


def site_values(
    companies: DataFrame, rows: DataFrame, overrides: DataFrame, splits: DataFrame, price_overrides: DataFrame, blocks: DataFrame, towns: DataFrame, centroids: DataFrame, points: DataFrame,
    pages: DataFrame | None = None, **options: object,
) -> DataFrame:
    """One typed row for each site of the accepted companies whose address is resolved; ``options`` are those of ``valued``."""
    every = site_reasons(companies, rows, overrides, splits, price_overrides, blocks, towns, centroids, pages)
    return valued(stored(every.filter("reason IS NULL").drop("stage", "reason")), points, **options)


def valued(local: DataFrame, points: DataFrame, k: int = 3, power: int = 3, eps: float = 1.0, far: float = 1500.0, price_method: str = "idw", landuse_match: bool = True) -> DataFrame:
    """The rows of ``site_reasons`` that go on, with price, value, score and warnings.

    ``price_method`` is "idw", of the k nearest points, or "nearest", of one. Sites with a price override don't
    enter the search for neighbours: factor and score are 1, distances 0.
    """
    if price_method not in ("idw", "nearest") or k < 1:
        raise ValueError(f"price_method {price_method!r}, k {k}")
    fixed = local.filter("override_price IS NOT NULL")
    found = estimates(local.filter("override_price IS NULL"), points, 1 if price_method == "nearest" else k, power, eps, far, landuse_match).withColumnRenamed("unit_price", "price")
    found = _counted_side(found)
    same = (F.col("s.lat") == F.col("e.lat")) & (F.col("s.lon") == F.col("e.lon")) & F.col("s.family").eqNullSafe(F.col("e.family"))
    sought = local.filter("override_price IS NULL").alias("s").join(found.alias("e"), same).select("s.*", *[f"e.{c}" for c in found.columns if c not in ("lat", "lon", "family")])
    out = sought.unionByName(fixed.withColumn("price", F.col("override_price")), allowMissingColumns=True)
    is_fixed = F.col("override_price").isNotNull()
    either = lambda a, b: F.when(is_fixed, a).otherwise(b)
    level = fv.level_factor(F.col("level"))
    factor = either(F.lit(1.0), level)
    score = fv.uncertainty(F.col("max_dist"), F.col("variance"))
    value = fv.valuation(F.col("price"), factor, F.col("area"), F.col("book"), F.col("market_cap"))
    out = out.select(
        "*", factor.alias("factor"), either(F.lit("override"), F.lit(method_name(price_method, k, power, landuse_match))).alias("method"), either(F.lit(1.0), score).alias("score"), either(F.lit("override"), fv.confidence_label(score)).alias("label"),
        value["unit_price"].alias("unit_price"), value["est"].alias("est"), value["gain"].alias("gain"), (F.col("price") * factor * F.col("area")).alias("est_raw"), value["multiple"].alias("multiple"), value["cap_ratio"].alias("ratio"),
    )
    out = out.withColumns({"variance": F.coalesce("variance", F.lit(0.0)), "max_dist": F.coalesce("max_dist", F.lit(0.0)), "target_kind": F.coalesce("target_kind", F.lit(""))})
    out = out if "repeated_large" in local.columns else sites.repeated_address_warning(out)
    own = fv.warnings(F.col("has_hoka"), F.col("level"), F.col("max_dist"), F.col("label"), F.col("area"), F.col("multiple"))
    return out.withColumn("warnings", F.when(F.col("repeated_large"), F.array_append(own, F.lit(fv.REPEATED_ADDRESS))).otherwise(own))


def output_rows(companies: DataFrame, values: DataFrame, k: int = 3, power: int = 3, decimals: int = 12, price_method: str = "idw", landuse_match: bool = True) -> DataFrame:
    """The 33 columns of the contract: a row for each site, and a total for each company, with or without sites.

    Amounts are whole numbers, other figures text of fixed decimals, lists are
    joined with a bar; what a total doesn't have is empty. ``decimals`` are
    those of the exact multiple and ratio.
    """
    shown = lambda x, n: F.coalesce(F.format_string(f"%.{n}f", x), F.lit(""))
    joined = lambda x: F.coalesce(F.array_join(x, "|"), F.lit(""))
    amount = lambda c: F.bround(F.col(c), 0).cast("long")
    ratios = [F.when(F.col(c).isNull(), "").otherwise(shown(F.col(c), n)).alias(name) for c in ("multiple", "ratio") for name, n in ((f"{c}_raw", decimals), (c, 3))]
    rows = values.select(
        "code", "company_name", "site_name", "address", "address_source", F.coalesce("address_source_url", F.lit("")).alias("address_source_url"), "level", shown(F.col("area"), 2).alias("area"), "unit_price", shown(F.col("factor"), 6).alias("factor"),
        shown(F.col("factor"), 6).alias("geocode_factor"), "method", "target_kind", F.coalesce(F.try_element_at("knn_kinds", F.lit(1)), F.lit("")).alias("nearest_kind"), F.coalesce(F.try_element_at("knn_ids", F.lit(1)), F.lit("")).alias("nearest_id"),
        shown(F.coalesce(F.try_element_at("knn_dist_m", F.lit(1)), F.lit(0.0)), 3).alias("nearest_dist"), joined("knn_ids").alias("knn_ids"), joined("knn_kinds").alias("knn_kinds"), joined(F.transform("knn_dist_m", lambda d: shown(d, 3))).alias("knn_dist"),
        joined(F.col("knn_prices").cast("array<string>")).alias("knn_prices"), shown(F.col("variance"), 3).alias("variance"), shown(F.col("max_dist"), 3).alias("max_dist"), shown(F.col("score"), 6).alias("score"), "label", F.array_join("warnings", " | ").alias("warnings"),
        "est", amount("book").alias("book"), "gain", "market_cap", *ratios,
    )
    totals = sites.company_totals(companies.select("code", "company_name", "market_cap"), values).withColumn("ratio", F.col("cap_ratio"))
    totals = totals.select("code", "company_name", F.lit(TOTAL).alias("site_name"), F.lit(method_name(price_method, k, power, landuse_match)).alias("method"), "est", "book", "gain", "market_cap", *ratios)
    text = [c for c in rows.columns if c not in totals.columns and c != "unit_price"]
    totals = totals.withColumns({c: F.lit("") for c in text}).withColumn("unit_price", F.lit(None).cast("long"))
    both = rows.unionByName(totals)
    return both.select(*[F.col(c).alias(name) for c, name in OUTPUT_COLUMNS.items()])


def ranking_payload(rows: DataFrame, metrics: DataFrame, nested: list[str], allowed: DataFrame | None = None) -> DataFrame:
    """Companies by rank with a nested ``metrics``, of the allowed codes only where these are given."""
    rows = rows if allowed is None else ranking.screened(rows, allowed)
    return ranking.with_metrics(ranking.ranked(rows), metrics, nested)

