"""Sheets of Excel workbooks, as rows of text.

A workbook is a zip of XML files: the sheets' cells, texts that several cells share, and
the sheets' names.  A small helper opens the zip; Spark's XML reader takes the parts
apart and joins put them together.  Workbooks are sheets that people fill in, so a
sheet's columns are few; its rows are spread like those of any table.
"""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_PART = re.compile(r"xl/(workbook\.xml|_rels/workbook\.xml\.rels|sharedStrings\.xml|worksheets/[^/]+\.xml)")
#: Attributes have a leading underscore, text beside attributes is ``_VALUE``.
_TEXT = "struct<_VALUE: string, _space: string>"
_RUNS = f"t: {_TEXT}, r: array<struct<t: {_TEXT}>>"
_SHARED = f"si array<struct<{_RUNS}>>"
_CELLS = f"sheetData struct<row: array<struct<_r: int, c: array<struct<_r: string, _t: string, v: string, is: struct<{_RUNS}>>>>>>"
_SHEETS = "sheets struct<sheet: array<struct<_name: string, _id: string>>>"
_RELATIONS = "Relationship array<struct<_Id: string, _Target: string>>"


def _unzip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(part, text) of the XML files that make up the sheets; prefixes of names are taken off."""
    for b in batches:
        for data in b.column(0).to_pylist():
            with zipfile.ZipFile(io.BytesIO(data)) as z:
                names = [n for n in z.namelist() if _PART.fullmatch(n)]
                texts = [re.sub(r'(?<=[\s</])(?:x|r|xml):(?=[A-Za-z]+[\s=>/])', "", z.read(n).decode("utf-8-sig")) for n in names]
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(texts, pa.string())], names=["part", "text"])


def _flat(t: Column, r: Column) -> Column:
    """A text, or the runs it is made of."""
    return F.coalesce(t["_VALUE"], F.array_join(F.transform(r, lambda x: F.coalesce(x["t"]["_VALUE"], F.lit(""))), ""))


def cells(spark: SparkSession, path: str, sheet: str | int = 0) -> DataFrame:
    """(row, col, value): the cells of a sheet, by name or place, that hold something; rows and columns from 1."""
    options = {"ignoreNamespace": "true", "ignoreSurroundingSpaces": "false"}
    parts = spark.read.format("binaryFile").load(path).select("content").mapInArrow(_unzip, "part string, text string")
    of = lambda part, schema: parts.where(F.col("part") == part).select(F.from_xml("text", schema, options).alias("x"))
    sheets = of("xl/workbook.xml", _SHEETS).select(F.posexplode("x.sheets.sheet").alias("at", "s"))
    wanted = sheets.where(F.col("at") == sheet if isinstance(sheet, int) else F.col("s._name") == sheet).select(F.col("s._id").alias("id"))
    targets = of("xl/_rels/workbook.xml.rels", _RELATIONS).select(F.explode("x.Relationship").alias("r")).select(F.col("r._Id").alias("id"), F.regexp_replace("r._Target", "^(/?xl/)?", "xl/").alias("part"))
    found = targets.join(wanted, "id").select("part")
    if not found.head(1):
        raise ValueError(f"{path} has no sheet {sheet}")
    rows = parts.join(found, "part").select(F.from_xml("text", _CELLS, options).alias("x")).select(F.explode("x.sheetData.row").alias("row")).select(F.col("row._r").alias("row"), F.explode("row.c").alias("c"))
    letters = F.regexp_extract("c._r", "^([A-Z]+)", 1)
    col = F.aggregate(F.split(letters, ""), F.lit(0), lambda acc, x: acc * 26 + F.ascii(x) - 64)
    rows = rows.select("row", col.alias("col"), F.col("c._t").alias("kind"), F.col("c.v").alias("v"), F.when(F.col("c.is").isNotNull(), _flat(F.col("c.is.t"), F.col("c.is.r"))).alias("own"))
    shared = of("xl/sharedStrings.xml", _SHARED).select(F.posexplode("x.si").alias("at", "si")).select("at", _flat(F.col("si.t"), F.col("si.r")).alias("text"))
    number = F.when(F.col("kind") == "s", F.col("v").try_cast("int"))
    full = rows.join(shared, number == F.col("at"), "left")
    plain = F.when(F.col("kind") == "b", F.when(F.col("v") == "1", "True").otherwise("False")).otherwise(F.col("v"))
    value = F.when(F.col("kind") == "s", F.col("text")).when(F.col("kind") == "inlineStr", F.col("own")).otherwise(plain)
    return full.select("row", "col", value.alias("value")).where("value is not null and value <> ''")


def read_sheet(spark: SparkSession, path: str, sheet: str | int = 0, header: int | None = 1, full: int | None = None) -> DataFrame:
    """A sheet as text columns, with the names in row ``header``; cells that hold nothing are null.

    Without ``header``, it is the first row with something in column ``full``.  Rows
    after it that hold nothing in a named column are left out.
    """
    got = cells(spark, path, sheet)
    if header is None:
        header = got.where(F.col("col") == full).agg(F.min("row")).first()[0]
    names = {r["col"]: r["value"] for r in got.where(F.col("row") == header).collect()}  # the sheet's columns
    if not names:
        raise ValueError(f"{path} has no header in row {header}")
    order = sorted(names)
    below = got.where((F.col("row") > header) & F.col("col").isin(order))
    out = below.groupBy("row").pivot("col", order).agg(F.first("value")).orderBy("row")
    return out.select(*[F.col(f"`{c}`").alias(names[c]) for c in order])
