"""Japanese address functions: Columns in, Columns out, all on the JVM side."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

#: Digits in Chinese numerals; 零 is another 〇.
DIGITS = "〇一二三四五六七八九"
NUMERAL = "[零〇一二三四五六七八九十]+"
FULL_WIDTH, HALF_WIDTH = "０１２３４５６７８９－ー―−", "0123456789----"
BLANKS = r"^[\s　]+|[\s　]+$"


def _digit(c: Column) -> Column:
    return F.instr(F.lit(DIGITS), F.translate(c, "零", "〇")) - 1


def kanji_to_int(token: Column) -> Column:
    """0 to 99 in positional tens, else null: 三 is 3, 十一 is 11, 二十三 is 23."""
    t = F.regexp_replace(token, BLANKS, "")
    tens, ones = F.regexp_extract(t, "^(.?)十(.?)$", 1), F.regexp_extract(t, "^(.?)十(.?)$", 2)
    value = F.when(tens == "", 1).otherwise(_digit(tens)) * 10 + F.when(ones == "", 0).otherwise(_digit(ones))
    return F.when(F.rlike(t, F.lit("^[零〇一二三四五六七八九]$")), _digit(t)).when(F.rlike(t, F.lit("^[零〇一二三四五六七八九]?十[零〇一二三四五六七八九]?$")), value).cast("int")


def num_to_kanji(n: Column, strict: bool = False) -> Column:
    """The numeral of 0 to 99; beyond that null, or an error with ``strict``."""
    digits = F.translate(F.lit(DIGITS), "〇", "零")
    tens, ones = F.floor(n / 10).cast("int"), F.pmod(n, F.lit(10)).cast("int")
    one = lambda k: F.substring(digits, k + 1, F.lit(1))
    head = F.when(tens == 0, F.lit("")).when(tens == 1, F.lit("十")).otherwise(F.concat(one(tens), F.lit("十")))
    text = F.concat(head, F.when((ones == 0) & (tens > 0), F.lit("")).otherwise(one(ones)))
    out = F.when(n.between(0, 99), text)
    return out.when(n.isNotNull(), F.raise_error(F.concat(F.lit("no numeral for "), n.cast("string")))) if strict else out


def normalize_addr(s: Column) -> Column:
    """Half-width digits and dashes, no 〒 or ideographic space, and digits for numerals before 丁目, 番 and 号.

    Numerals that are none of 0 to 99 stay as they are.
    """
    t = F.translate(F.regexp_replace(s, BLANKS, ""), FULL_WIDTH + "〒　", HALF_WIDTH)
    number = f"{NUMERAL}(?=丁目|番|号)"
    gaps, tokens = F.split(t, number, -1), F.regexp_extract_all(t, F.lit(number), F.lit(0))
    joined = F.concat_ws("", F.zip_with(gaps, tokens, lambda g, x: F.concat(g, F.coalesce(kanji_to_int(x).cast("string"), x, F.lit("")))))
    return F.when(F.size(tokens) > 0, joined).otherwise(t)


def split_municipality(addr: Column) -> Column:
    """struct(muni, rest) of a Tokyo address; muni is null and rest the whole address elsewhere.

    The shortest prefix that ends in 区, 市, 町 or 村 counts, so 東村山市 gives 東村.
    """
    a = normalize_addr(addr)
    pattern = "^東京都(.+?(?:区|市|町|村))(.*)$"
    inside = F.rlike(a, F.lit(pattern))
    return F.struct(F.when(inside, F.regexp_extract(a, pattern, 1)).alias("muni"), F.when(inside, F.regexp_extract(a, pattern, 2)).otherwise(a).alias("rest"))


def parse_town(addr: Column) -> Column:
    """struct(town, chome, block): the town with 丁目, with hyphens, with a block number only, or alone."""
    rest = F.regexp_replace(split_municipality(addr)["rest"], r"^[\s　]+", "")
    part = lambda pattern, k: F.regexp_extract(rest, pattern, k)
    number = lambda c: F.nullif(c, F.lit("")).try_cast("int")
    made = lambda town, chome, block: F.struct(town.alias("town"), chome.cast("int").alias("chome"), block.cast("int").alias("block"))
    none = F.lit(None)
    chome, hyphen, block, alone = "(.+?)([0-9]+)丁目(.*)$", "(.+?)([0-9]+)-([0-9]+)(?:-[0-9]+)?.*$", "(.+?)([0-9]+)(?:番地?|号).*$", "^(?:[^0-9,，、]+|.+(?:町|丁目))$"
    return (
        F.when(F.rlike(rest, F.lit(chome)), made(part(chome, 1), number(part(chome, 2)), number(F.regexp_extract(part(chome, 3), "([0-9]{1,4})", 1))))
        .when(F.rlike(rest, F.lit(hyphen)), made(part(hyphen, 1), number(part(hyphen, 2)), number(part(hyphen, 3))))
        .when(F.rlike(rest, F.lit(block)), made(F.regexp_replace(part(block, 1), BLANKS, ""), none, number(part(block, 2))))
        .when((rest != "") & F.rlike(rest, F.lit(alone)), made(rest, none, none))
        .otherwise(made(none.cast("string"), none, none))
    )


def oaza_name(town: Column, chome: Column) -> Column:
    """六本木 and 3 give 六本木三丁目; null beyond 99."""
    return F.concat(town, num_to_kanji(chome), F.lit("丁目"))


def ward(addr: Column) -> Column:
    """The municipality in an address, or null."""
    return F.nullif(F.regexp_extract(addr, r"東京都(\S+?[区市町村])", 1), F.lit(""))


def register_address_functions(spark: SparkSession) -> None:
    """The same functions as temporary SQL functions."""
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION land_kanji_digit(c STRING) RETURNS INT RETURN instr('〇一二三四五六七八九', translate(c, '零', '〇')) - 1")
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION land_kanji_to_int(t STRING) RETURNS INT RETURN CASE WHEN t RLIKE '^[零〇一二三四五六七八九]$' THEN land_kanji_digit(t) "
        "WHEN t RLIKE '^[零〇一二三四五六七八九]?十[零〇一二三四五六七八九]?$' THEN CASE WHEN t LIKE '十%' THEN 1 ELSE land_kanji_digit(left(t, 1)) END * 10 + CASE WHEN t LIKE '%十' THEN 0 ELSE land_kanji_digit(right(t, 1)) END END"
    )
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION land_normalize_addr(s STRING) RETURNS STRING RETURN concat_ws('', zip_with("
        f"split(translate(trim(s), '{FULL_WIDTH}〒　', '{HALF_WIDTH}'), '{NUMERAL}(?=丁目|番|号)', -1), "
        f"regexp_extract_all(translate(trim(s), '{FULL_WIDTH}〒　', '{HALF_WIDTH}'), '({NUMERAL})(?=丁目|番|号)', 1), "
        "(g, x) -> concat(g, coalesce(CASE WHEN x IS NULL THEN '' END, CAST(CASE WHEN x RLIKE '^[零〇一二三四五六七八九]$' THEN instr('〇一二三四五六七八九', translate(x, '零', '〇')) - 1 "
        "WHEN x RLIKE '^[零〇一二三四五六七八九]?十[零〇一二三四五六七八九]?$' THEN CASE WHEN x LIKE '十%' THEN 1 ELSE instr('〇一二三四五六七八九', translate(left(x, 1), '零', '〇')) - 1 END * 10 "
        "+ CASE WHEN x LIKE '%十' THEN 0 ELSE instr('〇一二三四五六七八九', translate(right(x, 1), '零', '〇')) - 1 END END AS STRING), x))))"
    )
