"""Domain-shaped inputs from the general tables.

Each input is one SELECT that Spark and DuckDB read alike: whole-number
arithmetic, and divisions that are exact. {table} stands for a table.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from landquill.shared import unsent

INPUTS = {
    "companies": "SELECT CAST(c_custkey AS STRING) AS code, CASE WHEN c_custkey % 11 = 0 THEN CAST(c_custkey AS STRING) WHEN c_custkey % 13 = 0 THEN ' ' ELSE c_name END AS company_name, "
    "CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE CAST(c_custkey * 7919 % 90000 + 10000 AS BIGINT) * 1000000 END AS market_cap, c_mktsegment AS segment FROM {customer}",
    "sites": "SELECT CAST(o_custkey AS STRING) AS code, o_orderkey AS seq, CONCAT('S', CAST(o_orderkey % 5 AS STRING), CASE WHEN o_orderkey % 17 = 0 THEN '他' ELSE '' END) AS site_name, "
    "CAST(o_orderkey * 37 % 9000 + 10 AS DOUBLE) AS area, CAST(o_orderkey * 7919 % 90000000 AS DOUBLE) AS book, CAST(o_orderkey * 104729 % 60013 AS DOUBLE) AS x, CAST(o_orderkey * 1299709 % 40009 AS DOUBLE) AS y, "
    "CASE o_orderkey % 6 WHEN 0 THEN '本社事務所' WHEN 1 THEN '第二工場' WHEN 2 THEN '社員寮' WHEN 3 THEN '賃貸マンション' WHEN 4 THEN '研究所' ELSE '物流倉庫' END AS equipment, o_orderkey % 17 = 0 AS has_hoka, "
    "CASE o_orderkey % 4 WHEN 0 THEN 'gaiku' WHEN 1 THEN 'oaza_chome' WHEN 2 THEN 'muni_centroid' ELSE 'override' END AS level FROM {orders}",
    "filed_sites": "SELECT CAST(o_custkey AS STRING) AS code, o_orderkey AS seq, CONCAT('S', CAST(o_orderkey % 5 AS STRING), CASE WHEN o_orderkey % 17 = 0 THEN '他' ELSE '' END) AS site_name, CAST(o_orderkey * 37 % 90000 + 10 AS DOUBLE) AS area, CAST(o_orderkey * 7919 % 90000000 AS DOUBLE) AS book, "
    "CASE o_orderkey % 6 WHEN 0 THEN '本社事務所' WHEN 1 THEN '第二工場' WHEN 2 THEN '社員寮' WHEN 3 THEN '賃貸マンション' WHEN 4 THEN '研究所' ELSE '物流倉庫' END AS equipment, o_orderkey % 17 = 0 AS has_hoka, "
    "CASE o_orderkey % 9 WHEN 0 THEN '大阪府大阪市北区' WHEN 1 THEN '東京都新宿区' WHEN 2 THEN '東京都港区' WHEN 3 THEN '東京都八王子市' ELSE CONCAT('東京都', CASE o_orderkey % 4 WHEN 0 THEN '港区' WHEN 1 THEN '中央区' WHEN 2 THEN '千代田区' ELSE '府中市' END, CASE o_orderkey % 5 WHEN 0 THEN '六本木3丁目5番' WHEN 1 THEN '日本橋2-7-1' WHEN 2 THEN '五番町11番' WHEN 3 THEN '六本木九丁目' ELSE '日本橋' END) END AS location FROM {orders}",
    "price_points": "SELECT CONCAT('13-', CAST(p_partkey AS STRING)) AS point_id, 35 + CAST(p_partkey * 15485863 % 60013 AS DOUBLE) / 65536 AS lat, 139 + CAST(p_partkey * 32452843 % 40009 AS DOUBLE) / 65536 AS lon, "
    "CAST(p_partkey * 31 % 2000 + 50 AS BIGINT) * 1000 AS price, CASE p_size % 6 WHEN 0 THEN '工業' WHEN 1 THEN '商業' WHEN 2 THEN '近商' WHEN 3 THEN '1住居' WHEN 4 THEN '準工' ELSE '' END AS kind FROM {part}",
    "site_urls": "SELECT CAST(o_custkey AS STRING) AS code, o_orderkey AS seq, CONCAT('S', CAST(o_orderkey % 5 AS STRING), CASE WHEN o_orderkey % 17 = 0 THEN '他' ELSE '' END) AS site_name, o_orderkey % 23 = 0 AS has_hoka, CASE o_orderkey % 3 WHEN 0 THEN '東京都港区' WHEN 1 THEN '東京都中央区' ELSE '東京都府中市' END AS location, "
    "CONCAT('p/', CAST(o_custkey AS STRING), ' | p/', CAST(o_orderkey % 700 AS STRING), ' || p/', CAST(o_custkey AS STRING)) AS urls FROM {orders}",
    "address_pages": "SELECT CONCAT('p/', CAST(c_custkey AS STRING)) AS url, CONCAT('<p>S', CAST(c_custkey % 5 AS STRING), '</p>所在地 東京都港区六本木', CAST(c_custkey % 7 + 1 AS STRING), '丁目', CAST(c_custkey % 40 + 1 AS STRING), '番', CAST(c_custkey % 9 + 1 AS STRING), '号 TEL 03-1<br>本店 東京都中央区日本橋', "
    "CAST(c_custkey % 8 + 1 AS STRING), '-', CAST(c_custkey % 30 + 1 AS STRING), '<br/>工場 東京都府中市') AS html FROM {customer}",
    "points": "SELECT CONCAT('13-', CAST(p_partkey AS STRING)) AS point_id, CONCAT('13-', CAST(p_partkey % 700 AS STRING)) AS base_id, p_partkey AS pos, CAST(p_partkey * 15485863 % 60013 AS DOUBLE) AS x, CAST(p_partkey * 32452843 % 40009 AS DOUBLE) AS y, "
    "CAST(p_partkey * 31 % 2000 + 50 AS BIGINT) * 1000 AS price, CASE p_size % 6 WHEN 0 THEN '工業' WHEN 1 THEN '商業' WHEN 2 THEN '近商' WHEN 3 THEN '1住居' WHEN 4 THEN '準工' ELSE '' END AS kind FROM {part}",
    "second_points": "SELECT CONCAT('23-', CAST(s_suppkey AS STRING)) AS point_id, CAST(CASE WHEN s_suppkey % 3 = 0 THEN s_suppkey * 15485863 % 60013 ELSE s_suppkey * 86028121 % 60013 END AS DOUBLE) AS x, "
    "CAST(CASE WHEN s_suppkey % 3 = 0 THEN s_suppkey * 32452843 % 40009 ELSE s_suppkey * 49979687 % 40009 END AS DOUBLE) AS y, CAST(s_suppkey * 17 % 1000 + 50 AS BIGINT) * 1000 AS price, '' AS kind FROM {supplier}",
    "prices": "SELECT CAST(user_id AS STRING) AS code, ts AS date, value AS close, CAST(user_id % 50 + 1 AS BIGINT) * 1000 AS shares FROM {events}",
    "overrides": "SELECT CAST(o_custkey AS STRING) AS code, CONCAT('S', CAST(o_orderkey % 5 AS STRING)) AS site_name, MAX(CONCAT('東京都港区六本木', CAST(o_orderkey % 9 + 1 AS STRING), '-', CAST(o_orderkey % 30 + 1 AS STRING))) AS address FROM {orders} WHERE o_orderstatus = 'P' GROUP BY 1, 2",
    "price_overrides": "SELECT CAST(o_custkey AS STRING) AS code, CONCAT('S', CAST(o_orderkey % 5 AS STRING)) AS site_name, MAX(CAST(o_orderkey % 1000 + 100 AS BIGINT) * 1000) AS unit_price FROM {orders} WHERE o_orderpriority = '5-LOW' GROUP BY 1, 2",
    "splits": "SELECT CAST(o_custkey AS STRING) AS code, CONCAT(CASE WHEN o_orderpriority = '1-URGENT' THEN 'S' ELSE 'T' END, CAST(o_orderkey % 5 AS STRING)) AS site_name, "
    "CAST(ROW_NUMBER() OVER (PARTITION BY o_custkey, o_orderkey % 5, o_orderpriority = '1-URGENT' ORDER BY o_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity) AS INT) AS pos, "
    "CONCAT('P', CAST(o_orderkey AS STRING), '-', CAST(l_linenumber AS STRING), '-', CAST(l_partkey AS STRING)) AS name, CASE WHEN l_linenumber = 7 THEN '大阪府大阪市北区' ELSE CONCAT('東京都港区六本木', CAST(l_linenumber AS STRING), '-', CAST(l_partkey % 13 AS STRING)) END AS address, CAST(l_quantity AS DOUBLE) AS area, "
    "CASE WHEN l_returnflag = 'A' THEN CAST(o_orderkey * 1009 % 30000000 AS DOUBLE) END AS book FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey",
    "addresses": "SELECT o_orderkey AS seq, CONCAT('　東京都', CASE o_orderkey % 5 WHEN 0 THEN '港区' WHEN 1 THEN '中央区' WHEN 2 THEN '千代田区' WHEN 3 THEN '八王子市' ELSE '府中市' END, CASE o_orderkey % 3 WHEN 0 THEN '六本木' WHEN 1 THEN '日本橋' ELSE '五番町' END, "
    "CASE o_orderkey % 7 WHEN 0 THEN '三丁目４番１号' WHEN 1 THEN '3-4-33' WHEN 2 THEN '１１番５号' WHEN 3 THEN '' WHEN 4 THEN '二十三丁目' WHEN 5 THEN '十二番地' ELSE '2－15' END) AS address FROM {orders}",
    "town_reference": "SELECT '東京都' AS pref, CASE p_partkey % 5 WHEN 0 THEN '港区' WHEN 1 THEN '中央区' WHEN 2 THEN '千代田区' WHEN 3 THEN '八王子市' ELSE '府中市' END AS muni, CONCAT(CASE p_partkey % 3 WHEN 0 THEN '六本木' WHEN 1 THEN '日本橋' ELSE '五番町' END, "
    "CASE p_size % 3 WHEN 0 THEN '三丁目' WHEN 1 THEN '二丁目' ELSE '' END) AS town, CAST(35 + CAST(p_partkey % 1000 AS DOUBLE) / 1024 AS STRING) AS lat, CAST(139 + CAST(p_partkey % 777 AS DOUBLE) / 1024 AS STRING) AS lon FROM {part} WHERE p_retailprice > 0",
    "block_reference": "SELECT '東京都' AS pref, CASE p_partkey % 5 WHEN 0 THEN '港区' WHEN 1 THEN '中央区' WHEN 2 THEN '千代田区' ELSE '八王子市' END AS muni, CONCAT(CASE p_partkey % 3 WHEN 0 THEN '六本木' WHEN 1 THEN '日本橋' ELSE '五番町' END, "
    "CASE p_size % 3 WHEN 0 THEN '三丁目' WHEN 1 THEN '二丁目' ELSE '' END) AS town, CAST(p_partkey % 13 AS STRING) AS block, CAST(p_partkey % 2 AS STRING) AS rep_flag, CASE WHEN p_partkey % 5 = 0 THEN 'x' ELSE '1' END AS addr_flag, "
    "CAST(35 + CAST(p_partkey % 500 AS DOUBLE) / 1024 AS STRING) AS lat, CAST(139 + CAST(p_partkey % 333 AS DOUBLE) / 1024 AS STRING) AS lon FROM {part} WHERE p_size > 10",
}

#: A row number in a SELECT, and the first column that it goes by.
_NUMBER = re.compile(r"ROW_NUMBER\(\) OVER \(PARTITION BY (\w+)[^()]*\)")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A domain input over the tables of ``sf_dir``."""
    sql = INPUTS[name]
    tables = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in set(re.findall(r"\{(\w+)\}", sql))}
    if len(tables) > 1:  # joined with each other
        tables = {t: unsent(rows) for t, rows in tables.items()}
    number = _NUMBER.search(sql)
    if not number:
        return spark.sql(sql, **tables)
    # Spark would make the texts before the rows are sent to be numbered; so they are numbered first.
    fields, source = sql.split(" FROM ", 1)
    rows = spark.sql(f"SELECT * FROM {source}", **tables).repartition(number[1])
    rows = spark.sql(f"SELECT *, {number[0]} AS _number FROM {{rows}}", rows=rows)
    return spark.sql(f"{fields.replace(number[0], '_number')} FROM {{rows}}", rows=rows)


def sql(name: str) -> str:
    """The same input as a subquery for other engines."""
    return "(" + re.sub(r"\{(\w+)\}", r"\1", INPUTS[name]) + ")"
