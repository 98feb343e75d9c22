"""Valuation, uncertainty and risk as Columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Factor by geocode level.
LEVEL_FACTOR = {"gaiku": 1.0, "oaza_chome": 0.95, "muni_centroid": 0.85}
#: Keywords of equipment and the family that the first one found stands for.
EQUIPMENT_FAMILY = (
    ("タンク", "工業系"), ("工場", "工業系"), ("倉庫", "工業系"), ("製造", "工業系"), ("洗濯", "工業系"), ("車庫", "工業系"), ("整備", "工業系"),
    ("物流", "工業系"), ("配送", "工業系"), ("リサイクル", "工業系"), ("プラント", "工業系"), ("生産", "工業系"), ("作業所", "工業系"), ("油槽", "工業系"),
    ("事務所", "商業系"), ("本社機能", "商業系"), ("店舗", "商業系"), ("営業所", "商業系"), ("賃貸ビル", "商業系"), ("賃貸オフィス", "商業系"), ("競馬場", "商業系"),
    ("斎場", "商業系"), ("ホテル", "商業系"), ("婚礼", "商業系"), ("販売", "商業系"), ("賃貸", "商業系"), ("商業", "商業系"), ("展示", "商業系"),
    ("社宅", "住居系"), ("寮", "住居系"), ("社員寮", "住居系"), ("独身寮", "住居系"), ("賃貸マンション", "住居系"),
)
#: Wards where a large area is suspicious, and from which area on.
HIGH_PRICE_WARDS = ("千代田区", "中央区", "港区", "新宿区", "渋谷区", "文京区", "台東区", "豊島区", "目黒区", "品川区")
LARGE_AREA = 10_000.0
#: The texts of warnings.
WARNINGS = {
    "multi_location": "所在地に複数所在地シグナルを含む(他/ほか/及び/等/外)(合算面積の可能性)",
    "muni_centroid": "muni_centroid",
    "oaza_chome": "oaza_chome",
    "far_points": "k近傍最遠距離10000m以上",
    "low_confidence_large": "信頼度lowかつ土地面積5000m2以上",
    "extreme_multiple": "評価倍率閾値超過",
}
REPEATED_ADDRESS = "同一住所かつ大面積の複数拠点"


def level_factor(level: Column, factors: dict[str, float] | None = None) -> Column:
    """Factor of a geocode level, 1 for any other."""
    out = None
    for name, value in (factors or LEVEL_FACTOR).items():
        out = F.when(level == name, value) if out is None else out.when(level == name, value)
    return out.otherwise(F.lit(1.0))


def equipment_family(equipment: Column) -> Column:
    """Family of the first keyword, in the list's order, that the text contains; null without one."""
    out = None
    for keyword, family in EQUIPMENT_FAMILY:
        found = F.contains(equipment, F.lit(keyword))
        out = F.when(found, family) if out is None else out.when(found, family)
    return out


def valuation(unit_price: Column, factor: Column, area: Column, book: Column, cap: Column) -> dict[str, Column]:
    """unit_price, est, gain, multiple, cap_ratio.

    The estimate uses the unit price after the factor, rounded half to even;
    multiple (over book) and ratio (over market value) use the exact one and are null if their divisor is 0.
    """
    exact = unit_price * factor
    unit = F.bround(exact, 0)
    est, gross = F.bround(unit * area, 0), exact * area
    return {"unit_price": unit.cast("long"), "est": est.cast("long"), "gain": (est - F.bround(book, 0)).cast("long"), "multiple": F.when(book != 0, gross / book), "cap_ratio": F.when(cap != 0, gross / cap)}


def uncertainty(max_dist: Column, variance: Column) -> Column:
    """1 - (0.7 of the largest distance over 5 km + 0.3 of the variance over 1e6), each part at most 1; 0 to 1."""
    part = F.lit(0.7) * F.least(max_dist / 5000.0, F.lit(1.0)) + F.lit(0.3) * F.least(variance / 1e6, F.lit(1.0))
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), 1.0 - part))


def confidence_label(score: Column) -> Column:
    return F.when(score >= 0.67, "high").when(score >= 0.34, "medium").otherwise("low")


def is_aggregate(name: Column) -> Column:
    """Names that stand for several sites."""
    return F.contains(name, F.lit("本社他")) | F.startswith(name, F.lit("本社・")) | F.endswith(name, F.lit("他")) | F.endswith(name, F.lit("等"))


def is_multi_location(name: Column) -> Column:
    return F.rlike(name, F.lit("他|ほか|及び|等|外"))


def accepts_web_address(name: Column, has_hoka: Column, score: Column, least: int = 40) -> Column:
    return ~is_aggregate(name) & ~has_hoka & (score >= least)


def warnings(has_hoka: Column, level: Column, max_dist: Column, label: Column, area: Column, multiple: Column) -> Column:
    """Array of the texts of the rules that a site meets, in a fixed order."""
    rules = [
        (has_hoka, "multi_location"), (level == "muni_centroid", "muni_centroid"), (level == "oaza_chome", "oaza_chome"), (max_dist >= 10_000, "far_points"),
        ((label == "low") & (area >= 5000), "low_confidence_large"), (multiple >= 500, "extreme_multiple"),
    ]
    return F.array_compact(F.array(*[F.when(rule, F.lit(WARNINGS[code])) for rule, code in rules]))


def high_value_risk(name: Column, ward: Column, area: Column) -> Column:
    """A name for several sites, or a large area in a ward of high prices."""
    return is_aggregate(name) | (F.coalesce(ward.isin(*HIGH_PRICE_WARDS), F.lit(False)) & F.coalesce(area >= LARGE_AREA, F.lit(False)))


def good_metric(ratio: Column, least: float = 0.5) -> Column:
    return F.coalesce(ratio >= least, F.lit(False))
