"""Registered data sources: overrides in YAML and CSVs of several encodings, a partition for each file."""

from __future__ import annotations

import codecs
import csv
import io
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: What a split must have, and the key of each column of a split's notes.
NEEDED = ("name", "address", "area_m2")
NOTES = {"source": "area_m2_source", "source_url": "area_m2_source_url", "note": "area_m2_note"}
_BLOCK = 1 << 20


class FilePartition(InputPartition):
    """One file."""

    def __init__(self, path: str) -> None:
        self.path = path


class FilesReader(DataSourceReader):
    """A partition for each file of the option ``path``, but for files whose names begin with _ or a dot."""

    def __init__(self, options: dict[str, str]) -> None:
        self.options = options

    def partitions(self) -> list[FilePartition]:
        from pyarrow import fs

        system, inner = fs.FileSystem.from_uri(self.options["path"])
        root = self.options["path"][: len(self.options["path"]) - len(inner)] if self.options["path"].endswith(inner) else ""
        found = system.get_file_info(inner)
        files = [found] if found.type == fs.FileType.File else system.get_file_info(fs.FileSelector(inner, recursive=True))
        return [FilePartition(root + f.path) for f in sorted(files, key=lambda f: f.path) if f.type == fs.FileType.File and f.base_name[:1] not in ("_", ".")]

    def opened(self, path: str):
        from pyarrow import fs

        system, inner = fs.FileSystem.from_uri(path)
        return system.open_input_stream(inner)


def entries(stream) -> Iterator[tuple[object, object]]:
    """The keys and values of a YAML file's top-level mapping, one after the other; none where the file holds anything else."""
    import yaml

    loader = yaml.SafeLoader(stream)
    loader.get_event()  # of the stream
    if not loader.check_event(yaml.DocumentStartEvent):
        return
    loader.get_event()
    if not loader.check_event(yaml.MappingStartEvent):
        return
    loader.anchors = {}
    loader.get_event()
    while not loader.check_event(yaml.MappingEndEvent):
        yield tuple(loader.construct_document(loader.compose_node(None, None)) for _ in range(2))


def _text(value: object) -> str | None:
    return str(value or "").strip() or None


def split_row(item: object) -> dict[str, object]:
    """The columns of one split, or only ``reason`` where it breaks a rule."""
    if not isinstance(item, dict):
        return {"reason": "not a mapping"}
    missing = [k for k in NEEDED if k not in item]
    if missing:
        return {"reason": "missing " + ", ".join(missing)}
    try:
        area = float(item["area_m2"])
        book = None if item.get("book_value_yen") is None else float(item["book_value_yen"])
    except (TypeError, ValueError):
        return {"reason": "not a number"}
    notes = {column: _text(item.get(key)) for column, key in NOTES.items()}
    estimated = bool(item.get("area_m2_is_estimated", False))
    if not area >= 0:
        return {"reason": "negative area"}
    if estimated and not notes["source"]:
        return {"reason": "estimated area without a source"}
    return {"name": str(item["name"]), "address": str(item["address"]), "area": area, "book": book, "estimated": estimated, **notes}


class OverrideReader(FilesReader):
    def read(self, partition: FilePartition) -> Iterator[tuple]:
        with self.opened(partition.path) as stream:
            for entry, (code, sites) in enumerate(entries(stream)):
                for site, pos, row in self.rows(sites):
                    own = (row.get(c) for c in ("name", "address", "area", "book", "estimated", *NOTES, "unit_price", "reason"))
                    yield (partition.path, entry, str(code), site, pos, *own)

    def rows(self, sites: object) -> Iterator[tuple[str | None, int | None, dict[str, object]]]:
        """(site, place among its splits, columns) of a company's entry."""
        if not isinstance(sites, dict):
            yield None, None, {"reason": "not a mapping"}
            return
        for site, value in sites.items():
            if self.options.get("kind") == "prices":
                try:
                    yield str(site), None, {"unit_price": int(value)}
                except (TypeError, ValueError):
                    yield str(site), None, {"reason": "not a number"}
            elif not isinstance(value, list):
                yield str(site), None, {"address": str(value)}
            elif not value:
                yield str(site), None, {"reason": "no splits"}
            else:
                for pos, item in enumerate(value):
                    yield str(site), pos, split_row(item)


class OverrideSource(DataSource):
    """``spark.read.format("overrides")``: YAML files of company codes to sites to an address, a list of splits or, with kind=prices, a price."""

    @classmethod
    def name(cls) -> str:
        return "overrides"

    def schema(self) -> str:
        return "path string, entry long, code string, site_name string, pos int, name string, address string, area double, book double, estimated boolean, source string, source_url string, note string, unit_price long, reason string"

    def reader(self, schema: T.StructType) -> OverrideReader:
        return OverrideReader(self.options)


class MixedCsvReader(FilesReader):
    def __init__(self, options: dict[str, str], columns: list[str]) -> None:
        super().__init__(options)
        self.columns = columns

    def encoding(self, path: str) -> str:
        """The first encoding that decodes all of a file."""
        names = self.options["encodings"].split(",")
        for name in names:
            decoder = codecs.getincrementaldecoder(name)()
            try:
                with self.opened(path) as stream:
                    while block := stream.read(_BLOCK):
                        decoder.decode(block)
                decoder.decode(b"", final=True)
            except UnicodeDecodeError:
                continue
            return name
        raise ValueError(f"{path}: none of {names} decodes it")

    def read(self, partition: FilePartition) -> Iterator[tuple]:
        with self.opened(partition.path) as stream, io.TextIOWrapper(stream, self.encoding(partition.path), newline="") as text:
            for row in csv.DictReader(text):
                yield (partition.path, *(row.get(c) for c in self.columns))


class MixedCsvSource(DataSource):
    """``spark.read.format("mixed_csv")``: CSVs with a header of which each may be in another of the option ``encodings``."""

    @classmethod
    def name(cls) -> str:
        return "mixed_csv"

    def reader(self, schema: T.StructType) -> MixedCsvReader:
        return MixedCsvReader(self.options, [c for c in schema.names if c != "path"])


def read_mixed_csv(spark: SparkSession, path: str, columns: list[str], encodings: tuple[str, ...] = ("utf-8-sig", "cp932")) -> DataFrame:
    """CSVs of a folder of which each may have another encoding: the first that decodes a file counts; a row for each line."""
    spark.dataSource.register(MixedCsvSource)
    schema = T.StructType([T.StructField(c, T.StringType()) for c in ["path", *columns]])
    return spark.read.format("mixed_csv").schema(schema).option("encodings", ",".join(encodings)).load(path)


def read_overrides(spark: SparkSession, path: str, kind: str = "addresses") -> DataFrame:
    """Overrides of a YAML file or of all files of a folder; ``kind`` is addresses or prices.

    A row for each address (pos null), split (pos from 0) or price, with its code and site_name; a row with a ``reason`` for each that breaks a rule: a split
    needs name, address and an area of 0 or more, an estimated area a source, and a list at least one split. Where a code is there again, only its last entry
    counts, by file name and place.
    """
    spark.dataSource.register(OverrideSource)
    rows = spark.read.format("overrides").option("kind", kind).load(path)
    last = F.max(F.struct("path", "entry")).over(Window.partitionBy("code"))
    return rows.withColumn("_last", last).filter("_last.path = path AND _last.entry = entry").drop("_last", "path", "entry")


def accepted_overrides(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(addr_override, site_split) of the rows of ``read_overrides`` without a reason."""
    good = rows.filter("reason IS NULL")
    plain, splits = good.filter("pos IS NULL"), good.filter("pos IS NOT NULL")
    return plain.select("code", "site_name", "address"), splits.select("code", "site_name", "pos", "name", "address", "area", "book")
