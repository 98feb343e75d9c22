"""Mining and scoring of address candidates in text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from landquill.functions.address import normalize_addr, split_municipality

#: Fixed patterns: how an address is cut back, the first that matches.
TRIMS = (r"^(東京都.+?号)", r"^(東京都.+?[0-9]{1,4}-[0-9]{1,4})-[0-9]{5,}.*$", r"^(東京都.+?(?:[0-9]+丁目)?[0-9]{1,4}-[0-9]{1,4}(?:-[0-9]{1,4})?).*$", r"^(東京都.+?[0-9]+丁目[0-9]+番(?:地|[0-9]+)?).*$", r"^(東京都.+?[0-9]+丁目).*$")

#: Fixed patterns: what ends an address in running text.
NOISE = (r"TEL|FAX|https?://|〒|[（()）]", r"[。､,，;；]")


def _cut_noise(a: Column) -> Column:
    for pattern in NOISE:
        a = F.element_at(F.split(a, pattern), 1)
    return F.regexp_replace(a, "(?:に移転|へ移転|移転予定|移転)$", "")


#: The steps of trimming; each sees the value of the one before, which is computed once.
_STEPS = (
    lambda s: F.replace(normalize_addr(s), F.lit(" ")),
    lambda a: F.when(F.instr(a, "東京都") > 0, F.substring(a, F.instr(a, "東京都"), F.length(a))).otherwise(a),
    _cut_noise,
    lambda a: F.coalesce(*[F.nullif(F.regexp_extract(a, p, 1), F.lit("")) for p in TRIMS], a),
)


def trim_addresses(found: Column) -> Column:
    """An array of addresses without what stands before them and without contact data, notes and other noise behind them."""
    for step in _STEPS:
        found = F.transform(found, step)
    return found


def address_candidates(text: Column) -> Column:
    """The different addresses of a text that name a municipality and a block, in order."""
    found = trim_addresses(F.regexp_extract_all(text, F.lit(r"東京都[^\n]{0,120}"), F.lit(0)))
    good = lambda a: F.startswith(a, F.lit("東京都")) & F.rlike(a, F.lit("区|市|町|村")) & F.rlike(a, F.lit("[0-9]+丁目|[0-9]+-[0-9]+|[0-9]+番|[0-9]+号"))
    return F.array_distinct(F.filter(found, good))


#: The points of a candidate, and the characters to each side of its first place on the page where names count.
POINTS = {"municipality": 20, "other_municipality": -40, "location": 30, "chome_or_hyphen": 10, "block": 20, "chome_only": -5, "site_near": 40, "municipality_near": 10}
NEAR = 100


def _points(rule: Column, name: str) -> Column:
    return F.when(F.coalesce(rule, F.lit(False)), POINTS[name]).otherwise(0)


def address_index(text: Column, near: int = NEAR) -> Column:
    """An array of what scoring needs of a text, one struct for each candidate: address, norm, detail, around.

    ``detail`` are the points of the address alone, ``around`` the characters about
    its first place in the text (null if it stands there in another form). With these, at most 2 ``near``
    characters for an address, the text itself isn't needed again.
    """
    found = F.transform(address_candidates(text), lambda a: F.struct(a.alias("address"), normalize_addr(a).alias("norm")))
    found = F.transform(found, lambda x: F.struct(x["address"].alias("address"), x["norm"].alias("norm"), F.instr(text, x["norm"]).alias("at")))
    return F.transform(found, lambda x: _entry(x["address"], x["norm"], x["at"], text, near))


def _entry(address: Column, norm: Column, at: Column, text: Column, near: int) -> Column:
    left = F.greatest(at - 1 - near, F.lit(0))
    around = F.when(at > 0, F.substring(text, left + 1, F.least(at - 1 + near, F.length(text)) - left))
    detail = _points(F.contains(norm, F.lit("丁目")) | F.contains(norm, F.lit("-")), "chome_or_hyphen") + _points(F.rlike(norm, F.lit("[0-9]+番[0-9]*号?|[0-9]+-[0-9]+")), "block") + _points(F.endswith(norm, F.lit("丁目")), "chome_only")
    return F.struct(address.alias("address"), norm.alias("norm"), detail.alias("detail"), around.alias("around"))


def site_keys(site: Column, location: Column) -> Column:
    """struct(name, location, muni) of a site as ``indexed_score`` compares them; made once for each site."""
    place = normalize_addr(location)
    return F.struct(normalize_addr(site).alias("name"), place.alias("location"), split_municipality(place)["muni"].alias("muni"))


def indexed_score(keys: Column, entry: Column) -> Column:
    """How well an entry of ``address_index`` suits a site: its municipality and place, its detail, and names near it on the page."""
    a, around, loc, muni = entry["norm"], entry["around"], keys["location"], keys["muni"]
    return (
        F.when(muni.isNull(), 0).when(F.contains(a, muni), POINTS["municipality"]).otherwise(POINTS["other_municipality"])
        + _points((loc != "") & F.contains(a, loc), "location")
        + entry["detail"]
        + _points((keys["name"] != "") & F.contains(around, keys["name"]), "site_near")
        + _points(F.contains(around, muni), "municipality_near")
    )


def candidate_score(site: Column, location: Column, addr: Column, page: Column, near: int = NEAR) -> Column:
    """The score of one address on one page."""
    norm = normalize_addr(addr)
    return indexed_score(site_keys(site, location), _entry(addr, norm, F.instr(page, norm), page, near))
