"""Functions on cells of filing tables and on numbers in text."""

from __future__ import annotations

from html.entities import name2codepoint

import functools
import operator

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Full-width characters and what they stand for.
FULL, HALF = "０１２３４５６７８９，．（）－", "0123456789,.()-"
NUMBER = r"[0-9][0-9,]*(?:\.[0-9]+)?"
#: Fixed pattern: a prefecture and, up to 40 characters on, a municipality.
LOCATION = r"((?:東京都|北海道|京都府|大阪府|[^\s()（）]{1,8}県)[^()（）]{0,40}?(?:区|市|町|村|郡[^\s()（）]{0,20}(?:町|村)))"
EDGES = r"^[\s　]+|[\s　]+$"


def plain(s: Column) -> Column:
    """Half-width digits and marks, no blanks at the ends; null is empty."""
    return F.regexp_replace(F.translate(F.coalesce(s, F.lit("")), FULL, HALF), EDGES, "")


def parse_number(cell: Column) -> Column:
    """The first number of a cell; null for dashes and for none."""
    s = plain(cell)
    return F.when(~s.isin("", "-", "－", "ー", "―", "─"), F.nullif(F.replace(F.regexp_extract(s, f"({NUMBER})", 1), F.lit(",")), F.lit("")).try_cast("double"))


def without_notes(cell: Column) -> Column:
    """A cell without note marks and without what stands in brackets."""
    s = F.regexp_replace(plain(cell), "\n", " ")
    for pattern in (r"[※*]\s*[0-9]+", r"\[[^\]]*\]", r"[（(][^）)]*[）)]"):
        s = F.regexp_replace(s, pattern, " ")
    return s


def parse_land_cell(cell: Column) -> Column:
    """struct(book, area): the first number outside brackets, and the one in brackets unless it is the same."""
    book = parse_number(without_notes(cell))
    inside = F.nullif(F.replace(F.regexp_extract(plain(cell), rf"[（(]\s*({NUMBER})\s*[）)]", 1), F.lit(",")), F.lit("")).try_cast("double")
    return F.struct(book.alias("book"), F.when(book.isNull() | (F.abs(inside - book) >= 1e-6), inside).alias("area"))


def parse_area_cell(cell: Column) -> Column:
    return parse_number(without_notes(cell))


def extract_location(cell: Column) -> Column:
    """struct(location, has_hoka): the municipality, and whether other places follow; empty without one."""
    flat = F.regexp_replace(plain(cell), r"[\s　]+", "")
    found = F.regexp_extract(flat, LOCATION, 1)
    rest = F.regexp_replace(F.substring(flat, F.instr(flat, found) + F.length(found), F.length(flat)), r"^[)）】\]］]+", "")
    hoka = (found != "") & F.rlike(rest, F.lit("^[他等外]|ほか|及び|その他"))
    return F.struct(F.regexp_replace(F.regexp_replace(found, "他$", ""), "ほか.*$", "").alias("location"), hoka.alias("has_hoka"))


def extract_site_name(cell: Column) -> Column:
    """The first line without brackets, with the second one if that is no place or number or if the first ends in 及び."""
    lines = F.filter(F.transform(F.split(plain(cell), r"\r\n|\r|\n"), lambda x: F.regexp_replace(x, EDGES, "")), lambda x: x != "")
    head = lambda k: F.regexp_replace(F.element_at(F.split(F.coalesce(F.try_element_at(lines, F.lit(k)), F.lit("")), "[(（]"), 1), EDGES, "")
    first, second = head(1), head(2)
    no_place = (second != "") & ~F.rlike(second, F.lit("都|道|府|県|区|市|町|村")) & ~F.rlike(second, F.lit(NUMBER))
    joined = F.when(no_place, F.concat(first, second)).otherwise(first)
    joined = F.when(F.endswith(joined, F.lit("及び")) & (second != ""), F.concat(joined, second)).otherwise(joined)
    return F.when(joined == "", "不明").otherwise(joined)


#: The notes of units in headers, thousand and million yen and thousand square metres.
THOUSAND_YEN, MILLION_YEN = ("帳簿価額(千円)", "帳簿価額（千円）"), ("帳簿価額(百万円)", "帳簿価額（百万円）", "(百万円)", "（百万円）")
OTHER_THOUSAND_YEN, THOUSAND_METRES = ("(千円)", "（千円）"), ("面積千㎡", "(千㎡)", "（千㎡）", "(千m2)", "（千m2）")


def book_multiplier(header: Column) -> Column:
    """Yen of a unit of book value; a million unless the header says thousand."""
    has = lambda *words: F.coalesce(*[F.when(F.contains(header, F.lit(w)), True) for w in words], F.lit(False))
    return F.when(has(*THOUSAND_YEN), 1000).when(has(*MILLION_YEN), 1_000_000).when(has(*OTHER_THOUSAND_YEN), 1000).otherwise(1_000_000)


def area_scale(header: Column) -> Column:
    found = [F.contains(header, F.lit(w)) for w in THOUSAND_METRES]
    return F.when(functools.reduce(operator.or_, found), 1000.0).otherwise(F.lit(1.0))


def to_float(s: Column) -> Column:
    """A number with or without commas; null for blanks and anything else."""
    return F.nullif(F.trim(F.replace(s, F.lit(","))), F.lit("")).try_cast("double")


def url_list(s: Column) -> Column:
    """The non-empty parts between bars, trimmed."""
    return F.filter(F.transform(F.split(F.coalesce(s, F.lit("")), r"\|"), lambda x: F.trim(x)), lambda x: x != "")


def supported_url(url: Column) -> Column:
    """Not a document by its suffix; what follows a question mark doesn't count."""
    path = F.lower(F.element_at(F.split(url, r"\?"), 1))
    return ~F.rlike(path, F.lit(r"\.(pdf|docx?|xlsx?|pptx?|zip|csv)$"))


_ENTITY = "&(?:#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});"


def unescape_html(s: Column) -> Column:
    """Character references replaced once, from the left: the names of HTML 4 and apos, decimal and hexadecimal numbers.

    Other names stay as they are; numbers of no character give U+FFFD.
    """
    names = F.create_map(*[F.lit(x) for name, point in {**name2codepoint, "apos": 0x27}.items() for x in (f"&{name};", chr(point))])
    gaps, found = F.split(s, _ENTITY, -1), F.regexp_extract_all(s, F.lit(_ENTITY), F.lit(0))

    def char(e: Column) -> Column:
        digits = F.when(F.rlike(e, F.lit("^&#[xX]")), F.regexp_extract(e, "([0-9a-fA-F]+);$", 1)).when(F.startswith(e, F.lit("&#")), F.conv(F.regexp_extract(e, "([0-9]+);$", 1), 10, 16))
        point = F.conv(digits, 16, 10).cast("long")
        sound = point.between(1, 0xD7FF) | point.between(0xE000, 0x10FFFF)
        number = F.when(sound, F.decode(F.unhex(F.lpad(F.when(sound, digits).otherwise("20"), 8, "0")), "UTF-32")).when(digits.isNotNull(), "�")
        return F.coalesce(F.try_element_at(names, e), number, e)

    joined = F.concat_ws("", F.zip_with(gaps, F.transform(found, char), lambda g, x: F.concat(g, F.coalesce(x, F.lit("")))))
    return F.when(F.size(found) > 0, joined).otherwise(s)


def html_to_text(s: Column) -> Column:
    """Character references replaced, then line breaks and tags as line feeds, blanks collapsed."""
    out = F.regexp_replace(unescape_html(s), r"<br ?/?>", "\n")
    out = F.regexp_replace(out, r"<[^>]+>", "\n")
    return F.regexp_replace(out, r"[ \t\r\f\x0B]+", " ")
