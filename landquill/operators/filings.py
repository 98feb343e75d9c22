"""Facilities from tables of filings: cells in long form, header roles, rows."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from landquill.functions.filing import area_scale, book_multiplier, extract_location, extract_site_name, parse_area_cell, parse_land_cell, parse_number, plain

#: Words that tell a second header row.
SUB_HEADER = "帳簿|面積|百万|千円|建物|土地|その他|合計|規模|竣工"


#: The tagged block that lists facilities, and the tags behind which its text goes on in a new line.
FACILITIES_BLOCK = "majorfacilitiestextblock"
BLOCK_TAGS = ("br", "div", "h1", "h2", "h3", "h4", "h5", "h6", "p", "tr")
_TABLE = ["doc_id", "table_idx"]


class _Filing(HTMLParser):
    """Cells of all tables, those that a span covers null, and the text of tagged blocks; with ``tagged`` only tables inside such blocks."""

    def __init__(self, tagged: bool) -> None:
        super().__init__(convert_charrefs=True)
        self.tagged = tagged
        self.cells: list[tuple[int, int, int, str | None]] = []
        self.blocks: list[list[str]] = []
        self.tags: list[bool] = []  # of the open tagged elements, whether each is a facilities block
        self.table, self.row, self.col, self.depth = -1, -1, 0, 0
        self.taken: set[tuple[int, int]] = set()
        self.text: list[str] | None = None
        self.span = (1, 1)

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag.rpartition(":")[2] == "nonnumeric":
            self.tags.append((dict(attrs).get("name") or "").rpartition(":")[2].lower() == FACILITIES_BLOCK)
            if self.tags[-1]:
                self.blocks.append([])
        if tag == "br":
            self._say("\n")
        if self.tagged and True not in self.tags:
            return
        if tag == "table":
            self.depth += 1
            if self.depth == 1:
                self.table, self.row, self.taken = self.table + 1, -1, set()
        elif tag == "tr" and self.depth == 1:
            self._close()
            self.row, self.col = self.row + 1, 0
        elif tag in ("td", "th") and self.depth == 1:
            self._close()
            own = dict(attrs)
            number = lambda k: max(1, int(own[k])) if (own.get(k) or "").isdigit() else 1
            self.span, self.text = (number("rowspan"), number("colspan")), []
        elif tag in ("br", "p", "div") and self.text:
            self.text.append("\n")

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCK_TAGS and tag != "br":
            self._say("\n")
        if tag in ("td", "th", "tr", "table") and self.depth == 1:
            self._close()
        if tag == "table":
            self.depth = max(0, self.depth - 1)
        if tag.rpartition(":")[2] == "nonnumeric" and self.tags and self.tags.pop():
            self._close()
            self.depth = 0

    def handle_data(self, data: str) -> None:
        self._say(data)
        if self.text is not None:
            self.text.append(data)

    def _say(self, text: str) -> None:
        if True in self.tags:
            self.blocks[-1].append(text)

    def _close(self) -> None:
        if self.text is None:
            return
        while (self.row, self.col) in self.taken:
            self.col += 1
        text, self.text = "\n".join(x.strip() for x in "".join(self.text).split("\n") if x.strip()), None
        for r in range(self.span[0]):
            for c in range(self.span[1]):
                self.taken.add((self.row + r, self.col + c))
                self.cells.append((self.table, self.row + r, self.col + c, text if r == c == 0 else None))
        self.col += self.span[1]


def parsed_filings(docs: DataFrame, id_col: str, html_col: str, tagged: bool = False, partitions: int | None = None) -> DataFrame:
    """doc_id, table_idx, r, c, txt: cells of every table, and the text of each tagged facilities block as a row with table_idx -1.

    txt of a cell is null where a span covers it. ``tagged`` reads only tables
    inside facilities blocks. ``partitions`` deals the documents out first,
    for tables of few files. Null documents have no rows. The only row-wise
    step: everything behind it works on the cells.
    """

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, rows = [], []
            for k, html in enumerate(batch.column("html").to_pylist()):
                parser = _Filing(tagged)
                parser.feed(html or "")
                parser.close()
                parser._close()
                rows += parser.cells + [(-1, n, 0, "".join(block)) for n, block in enumerate(parser.blocks)]
                keys += [k] * (len(rows) - len(keys))
            columns = [pa.array([row[n] for row in rows], kind) for n, kind in enumerate((pa.int32(), pa.int32(), pa.int32(), pa.string()))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(keys, pa.int32())), *columns], names=["doc_id", "table_idx", "r", "c", "txt"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(html_col).alias("html"))
    rows = rows.repartition(partitions) if partitions else rows
    return rows.mapInArrow(parse, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, table_idx int, r int, c int, txt string")


def table_cells(docs: DataFrame, id_col: str, html_col: str, partitions: int | None = None, tagged: bool = False) -> DataFrame:
    """doc_id, table_idx, r, c, txt: the cells of ``parsed_filings`` alone."""
    return parsed_filings(docs, id_col, html_col, tagged, partitions).filter("table_idx >= 0")


def section_texts(parsed: DataFrame) -> DataFrame:
    """doc_id, text: the tidy lines of each document's tagged blocks, with an empty line between blocks."""
    tidy = F.regexp_replace(F.replace("txt", F.lit("\u00a0"), F.lit(" ")), r"[ \t\r\f\x0B]+", " ")
    lines = F.filter(F.transform(F.split(tidy, "\n"), lambda x: F.trim(x)), lambda x: x != "")
    blocks = parsed.filter("table_idx = -1").select("doc_id", "r", plain(F.array_join(lines, "\n")).alias("t")).filter("t <> ''")
    return blocks.groupBy("doc_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("r", "t"))), lambda x: x["t"]), "\n\n").alias("text"))


def with_header_rows(cells: DataFrame) -> DataFrame:
    """cells with header_rows of their table: 2 if a third of the second row is blank or two of its cells hold words of headers, else 1."""
    table, text = Window.partitionBy(*_TABLE), plain(F.col("txt"))
    of_second = lambda rule: F.sum(F.when(F.col("r") == 1, rule.cast("int")).otherwise(0)).over(table)
    width, blank, words = of_second(F.lit(1)), of_second(text == ""), of_second(F.rlike(text, F.lit(SUB_HEADER)))
    two = (width > 0) & ((blank >= F.greatest(F.floor(width / 3), F.lit(1))) | (words >= 2))
    return cells.withColumn("header_rows", F.when(two, 2).otherwise(1))


def merge_continuations(cells: DataFrame) -> DataFrame:
    """Rows behind the header whose first two cells are blank go to the row before, cell by cell with a line feed.

    A blank row right behind the header goes to the header's last row. Cells
    of a table are dealt out together once; every later step on tables keeps
    that partitioning.
    """
    row = Window.partitionBy(*_TABLE, "r")
    own = F.max(F.when((F.col("c") < 2) & (plain(F.col("txt")) != ""), 1).otherwise(0)).over(row)
    first = F.col("c") == F.min("c").over(row)
    marked = with_header_rows(cells).withColumns({"_own": own, "_first": first})
    start = F.when(F.col("_first") & ((F.col("r") < F.col("header_rows")) | (F.col("_own") == 1)), 1).otherwise(0)
    # Peers of a row are summed together, so its cells have one number.
    to = F.greatest(F.sum(start).over(Window.partitionBy(*_TABLE).orderBy("r")) - 1, F.lit(0)).cast("int")
    texts = F.array_sort(F.collect_list(F.when(plain(F.col("txt")) != "", F.struct("r", "txt"))))
    joined = F.nullif(F.array_join(F.transform(texts, lambda x: x["txt"]), "\n"), F.lit(""))
    return marked.withColumn("_to", to).groupBy(*_TABLE, F.col("_to").alias("r"), "c").agg(joined.alias("txt"))


def forward_fill(cells: DataFrame, row: int = 0, out: str = "filled") -> DataFrame:
    """Blank cells of one row take the text of the last one before them."""
    w = Window.partitionBy("doc_id", "table_idx").orderBy("c").rowsBetween(Window.unboundedPreceding, 0)
    text = F.nullif(plain(F.col("txt")), F.lit(""))
    return cells.filter(F.col("r") == row).withColumn(out, F.coalesce(F.last(text, ignorenulls=True).over(w), F.lit("")))


def with_roles(cells: DataFrame) -> DataFrame:
    """cells of tables that list land of sites, with header_rows, the columns by role, book_mult and area_scale of their table."""
    table = Window.partitionBy(*_TABLE)
    bare = F.regexp_replace(plain(F.col("txt")), r"[\s　]+", "")
    along = Window.partitionBy(*_TABLE, "r").orderBy("c").rowsBetween(Window.unboundedPreceding, 0)
    group = F.coalesce(F.last(F.nullif(plain(F.col("txt")), F.lit("")), ignorenulls=True).over(along), F.lit(""))
    below = F.max(F.when(F.col("r") == 1, bare)).over(Window.partitionBy(*_TABLE, "c"))
    out = with_header_rows(cells).withColumns({"_g": F.regexp_replace(group, r"[\s　]+", ""), "_s": below})
    out = out.withColumn("_gs", F.concat("_g", F.when(F.col("header_rows") == 2, F.coalesce("_s", F.lit(""))).otherwise(F.lit(""))))
    has = lambda col, word: F.contains(F.col(col), F.lit(word))
    land, area, money = has("_gs", "土地"), has("_gs", "面積"), has("_gs", "帳簿") | has("_gs", "百万") | has("_gs", "千円")
    first = lambda rule: F.min(F.when((F.col("r") == 0) & rule, F.col("c"))).over(table)
    heads = F.array_sort(F.collect_list(F.when(F.col("r") == 0, F.struct("c", F.col("_gs").alias("gs")))).over(table))
    out = out.withColumns(
        {
            "name_col": first(has("_g", "事業所名") | (has("_g", "名称") & ~has("_g", "会社名"))), "location_col": first(F.col("_g") == "所在地"), "equip_col": first(has("_g", "設備") & has("_g", "内容")),
            "_a": first(land & area & ~money), "_b": first(land & money & ~area), "_c": first(land & area & money), "_heads": heads,
        }
    )
    apart = F.col("_a").isNotNull() & F.col("_b").isNotNull()
    out = out.withColumns({"book_col": F.when(apart, F.col("_b")).otherwise(F.coalesce("_c", "_b")), "area_col": F.when(apart, F.col("_a")), "_all": F.array_join(F.transform("_heads", lambda x: x["gs"]), "")})
    out = out.filter("name_col IS NOT NULL AND book_col IS NOT NULL").withColumns({"book_mult": book_multiplier(F.col("_all")), "area_scale": area_scale(F.col("_all"))})
    return out.drop("_g", "_s", "_gs", "_a", "_b", "_c", "_heads", "_all")


def skips_head_office(text: Column) -> Column:
    """Whether a section says that the head office's land is listed elsewhere."""
    t = F.regexp_replace(plain(text), r"[\s　]+", "")
    both = lambda a, b: F.contains(t, F.lit(a)) & F.contains(t, F.lit(b))
    return both("本社欄に記載の土地", "各所に所在") | both("本社の土地のなかに鉱業用地", "面積千")


def facilities(cells: DataFrame, skip_head: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(sites, rows of Tokyo sites without an area).

    cells: doc_id, table_idx, r, c, txt, continuations merged. skip_head:
    doc_id of documents whose head office row doesn't count. Of sites with
    one name and place the last one counts, at the first one's place (seq).
    """
    keys = _TABLE
    at = lambda role: F.max(F.when(F.col("c") == F.col(role), F.col("txt")))
    rows = with_roles(cells).filter(F.col("r") >= F.col("header_rows")).groupBy(*keys, "r", "location_col", "area_col", "book_mult", "area_scale").agg(at("name_col").alias("name"), at("location_col").alias("place"), at("equip_col").alias("equip"), at("book_col").alias("book"), at("area_col").alias("area"))
    rows = rows.filter((F.coalesce("name", F.lit("")) != "") & ~F.rlike(plain(F.col("name")), F.lit("^[①-⑩]")))
    rows = rows.withColumn("site_name", extract_site_name(F.col("name"))).filter(~F.startswith("site_name", F.lit("計")) & ~F.col("site_name").isin("合計", "小計"))
    if skip_head is not None:
        rows = rows.join(skip_head.select("doc_id", F.lit(True).alias("_skip")).distinct(), "doc_id", "left").filter(~(F.coalesce("_skip", F.lit(False)) & (F.col("site_name") == "本社"))).drop("_skip")
    rows = rows.withColumn("_loc", extract_location(F.when(F.col("location_col").isNotNull(), F.col("place")).otherwise(F.col("name")))).filter("_loc.location <> ''")
    apart = F.col("area_col").isNotNull()
    both = parse_land_cell(F.col("book"))
    rows = rows.withColumns({"_book": F.when(apart, parse_number(F.col("book"))).otherwise(both["book"]), "_area": F.when(apart, parse_area_cell(F.col("area"))).otherwise(both["area"])}).filter("_book IS NOT NULL")
    missing = rows.filter("_area IS NULL AND _loc.location LIKE '東京都%'").select(*keys, "r", "site_name", F.col("_loc.location").alias("location"), F.col("_book").alias("raw_book"))
    good = rows.filter("_area IS NOT NULL").select(
        "doc_id", F.struct("table_idx", "r").alias("seq"), "site_name", F.col("_loc.location").alias("location"), F.col("_loc.has_hoka").alias("has_hoka"), (F.col("_area") * F.col("area_scale")).alias("area"), (F.col("_book") * F.col("book_mult")).alias("book"), plain(F.col("equip")).alias("equipment")
    )
    return last_of_equals(good), missing


def last_of_equals(sites: DataFrame) -> DataFrame:
    rest = [c for c in sites.columns if c not in ("doc_id", "site_name", "location", "seq")]
    out = sites.groupBy("doc_id", "site_name", "location").agg(F.min("seq").alias("seq"), F.max_by(F.struct(*rest), F.col("seq")).alias("_r"))
    return out.select("doc_id", "seq", "site_name", "location", *[f"_r.{c}" for c in rest])
