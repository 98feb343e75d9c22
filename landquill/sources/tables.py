"""Sources: files of the domain as DataFrames with explicit schemas."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landquill.sources.config import read_mixed_csv as read_mixed_csv
from landquill.sources.config import read_overrides as read_overrides
from landquill.sources.features import SPLIT_BYTES, read_features

#: Names of the code column of a target list.
CODE_NAMES = ("code", "証券コード", "コード")
#: Columns of the two address reference files.
BLOCK_COLUMNS = {"都道府県名": "pref", "市区町村名": "muni", "大字・丁目名": "town", "街区符号・地番": "block", "代表フラグ": "rep_flag", "住居表示フラグ": "addr_flag", "緯度": "lat", "経度": "lon"}
TOWN_COLUMNS = {"都道府県名": "pref", "市区町村名": "muni", "大字町丁目名": "town", "緯度": "lat", "経度": "lon"}
FEATURE = T.StructType().add("geometry", T.StructType().add("type", "string").add("coordinates", T.ArrayType(T.DoubleType()))).add("properties", T.MapType(T.StringType(), T.StringType()))
#: Properties of the second survey by those of the first.
SECOND_SURVEY = {"L01_001": "L02_020", "L01_002": "L02_001", "L01_003": "L02_002", "L01_008": "L02_006", "L01_051": "L02_046"}


def read_csv(spark: SparkSession, path: str, encoding: str = "UTF-8") -> DataFrame:
    """A CSV with header, all text. For cp932 give windows-31j; the session then needs spark.sql.legacy.javaCharsets."""
    if encoding.lower() not in ("utf-8", "utf8"):
        spark.conf.set("spark.sql.legacy.javaCharsets", "true")
    out = spark.read.option("header", True).option("encoding", encoding).csv(path)
    return out.toDF(*[c.lstrip("﻿") for c in out.columns])


def read_targets(spark: SparkSession, path: str) -> DataFrame:
    """code, company_name, market_cap, address_source_urls of a target list, with or without a header."""
    lines = spark.read.option("header", False).csv(path)
    head = spark.read.text(path).first()
    names = [x.strip().lstrip("﻿") for x in (head[0] if head else "").split(",")]
    if any("report_url" in x or "有報URL" in x for x in names):
        raise ValueError("a column of report addresses is no longer read")
    col = lambda i: F.trim(F.col(lines.columns[i])) if i is not None and i < len(lines.columns) else F.lit(None).cast("string")
    place = {n: i for i, n in enumerate(names)}
    code = next((place[n] for n in CODE_NAMES if n in place), None)
    if code is None:
        out = lines.select(col(0).alias("code"), col(1).alias("company_name"), F.lit(None).cast("long").alias("market_cap"), F.array().cast("array<string>").alias("address_source_urls"))
    else:
        urls = F.filter(F.transform(F.split(F.coalesce(col(place.get("address_source_urls")), F.lit("")), r"\|"), lambda x: F.trim(x)), lambda x: x != "")
        cap = F.replace(col(place.get("market_cap")), F.lit(",")).try_cast("long")
        out = lines.select(F.ltrim(col(code)).alias("code"), col(place.get("company_name")).alias("company_name"), cap.alias("market_cap"), urls.alias("address_source_urls")).filter(~F.regexp_replace("code", "﻿", "").isin(*CODE_NAMES))
    return out.filter(F.coalesce("code", F.lit("")) != "")


def read_reference(spark: SparkSession, path: str, columns: dict[str, str], encoding: str = "windows-31j") -> DataFrame:
    """An address reference file under short names; see BLOCK_COLUMNS and TOWN_COLUMNS."""
    raw = read_csv(spark, path, encoding)
    return raw.select(*[F.col(f"`{a}`").alias(b) for a, b in columns.items()])


def read_points(spark: SparkSession, path: str, rename: dict[str, str] | None = None, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """base_id, lat, lon, price, kind, pos of the point features; others and those without properties are left out.

    The id is made of three parts, the last padded to three places. ``rename``
    maps property names of the first survey to those of the file. ``pos`` (file, and byte at which the
    feature begins) orders the features of all files. Large files are read by many tasks.
    """
    rename = rename or {}
    f = read_features(spark, path, FEATURE, split_bytes).filter("f.geometry IS NOT NULL AND f.geometry.type = 'Point' AND f.properties IS NOT NULL AND size(f.geometry.coordinates) >= 2")
    prop = lambda name: F.col("f.properties")[rename.get(name, name)]
    last = F.coalesce(prop("L01_003"), F.lit(""))
    padded = F.when(F.length(last) < 3, F.lpad(last, 3, "0")).otherwise(last)
    return f.select(
        F.concat_ws("-", F.coalesce(prop("L01_001"), F.lit("")), F.coalesce(prop("L01_002"), F.lit("")), padded).alias("base_id"), F.col("f.geometry.coordinates")[1].alias("lat"), F.col("f.geometry.coordinates")[0].alias("lon"),
        F.coalesce(prop("L01_008").try_cast("double"), F.lit(0.0)).alias("price"), F.coalesce(prop("L01_051"), F.lit("")).alias("kind"), "pos",
    )


def override_tables(spark: SparkSession, config: dict[str, dict[str, object]]) -> tuple[DataFrame, DataFrame]:
    """(addr_override, site_split) of a parsed configuration: code to site to an address or a list of splits.

    Raises on an empty list, a split without name, address or area, a negative
    area, and an estimated area without a source.
    """
    plain, splits = [], []
    for code, sites in config.items():
        for site, value in sites.items():
            if isinstance(value, str):
                plain.append((str(code), site, value))
                continue
            if not isinstance(value, list) or not value:
                raise ValueError(f"{code} {site}: an address or a list of splits is needed")
            for pos, part in enumerate(value):
                if not part.get("name") or not part.get("address") or part.get("area_m2") is None:
                    raise ValueError(f"{code} {site}: name, address and area_m2 are needed")
                if part["area_m2"] < 0:
                    raise ValueError(f"{code} {site}: negative area")
                if part.get("area_m2_is_estimated") and not part.get("source"):
                    raise ValueError(f"{code} {site}: an estimated area needs a source")
                book = part.get("book_value_yen")
                splits.append((str(code), site, pos, part["name"], part["address"], float(part["area_m2"]), None if book is None else float(book)))
    return spark.createDataFrame(plain, "code string, site_name string, address string"), spark.createDataFrame(splits, "code string, site_name string, pos int, name string, address string, area double, book double")


def price_override_table(spark: SparkSession, config: dict[str, dict[str, int]]) -> DataFrame:
    rows = [(str(code), site, int(price)) for code, sites in config.items() for site, price in sites.items()]
    return spark.createDataFrame(rows, "code string, site_name string, unit_price long")


def filing_files(spark: SparkSession, path: str) -> DataFrame:
    """code, doc_id, public, path, length, modified, content of filing documents below code/doc_id/ (or code=.../doc_id=.../).

    ``public``: the file is below XBRL/PublicDoc. Where a document has such files, only these count.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.{htm,html,xhtml}").load(path)
    base = path.rstrip("/").rsplit("/", 1)[-1]
    part = lambda k: F.regexp_extract("path", rf"/{re.escape(base)}/(?:[^/=]+=)?([^/]+)/(?:[^/=]+=)?([^/]+)/", k)
    return files.select(part(1).alias("code"), part(2).alias("doc_id"), F.contains("path", F.lit("/XBRL/PublicDoc/")).alias("public"), "path", "length", F.col("modificationTime").alias("modified"), "content")


def read_filings(spark: SparkSession, path: str) -> DataFrame:
    """code, doc_id, seq (by file name), path, length, modified, html of the files of ``filing_files`` that count."""
    own = Window.partitionBy("code", "doc_id")
    rows = filing_files(spark, path).withColumn("html", F.decode("content", "UTF-8")).drop("content")
    rows = rows.withColumn("_any", F.max("public").over(own)).filter(F.col("public") | ~F.col("_any"))
    return rows.withColumn("seq", F.row_number().over(own.orderBy(F.substring_index("path", "/", -1), "path"))).select("code", "doc_id", "seq", "path", "length", "modified", "html")


def company_fingerprints(files: DataFrame) -> DataFrame:
    """code, n_files, fingerprint: a digest of the contents of all of a company's files that count, whatever their names and order.

    files: as from ``filing_files``. A file's md5 is made where it is read. The three parts of those are added up, each
    task for itself first, so neither contents nor lists of digests are shuffled; the fingerprint is the md5 of the count and the sums.
    """
    digest = files.select("code", "doc_id", "public", F.md5("content").alias("d"))
    part = lambda first, n: F.conv(F.substring("d", first, n), 16, 10).cast("decimal(20,0)")
    pieces = {"n_files": F.lit(1).cast("decimal(20,0)"), "a": part(1, 11), "b": part(12, 11), "c": part(23, 10)}
    both = [f(x).alias(f"{name}_{side}") for name, x in pieces.items() for side, f in (("public", lambda x: F.sum(F.when(F.col("public"), x))), ("all", F.sum))]
    documents = digest.groupBy("code", "doc_id").agg(F.bool_or("public").alias("_any"), *both)
    sums = documents.groupBy("code").agg(*[F.sum(F.when(F.col("_any"), F.col(f"{name}_public")).otherwise(F.col(f"{name}_all"))).alias(name) for name in pieces])
    return sums.select("code", F.col("n_files").cast("long").alias("n_files"), F.md5(F.concat_ws(":", *[F.col(c).cast("string") for c in pieces]).cast("binary")).alias("fingerprint"))


def page_texts(pages: DataFrame, sections: DataFrame | None = None) -> DataFrame:
    """url, text: pages as text, and sections of filings under an address of their own."""
    from landquill.functions.filing import html_to_text

    out = pages.select("url", html_to_text(F.col("html")).alias("text"))
    if sections is None:
        return out
    own = sections.select(F.concat(F.lit("filing://"), "code", F.lit("/"), "doc_id", F.lit("/major-facilities")).alias("url"), "text")
    return out.unionByName(own)


def read_memos(spark: SparkSession, path: str) -> DataFrame:
    """code, memo: one file for each company."""
    return spark.read.text(path, wholetext=True).select(F.regexp_extract(F.col("_metadata.file_name"), r"^(.*)\.md$", 1).alias("code"), F.col("value").alias("memo"))
