"""Readers of delimited files, captures, nested extractions and labelled fixtures."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree
from xml.sax.saxutils import escape

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ---- fixed values: kinds of documents by content type and extension ----
KINDS = {
    "csv": ("text/csv", "application/csv", ".csv"),
    "xlsx": ("application/vnd.openxmlformats-officedocument.spreadsheetml.sheet", "application/vnd.ms-excel", ".xlsx", ".xls"),
    "pdf": ("application/pdf", ".pdf"),
}
DELIMITERS = [",", ";", "\t", "|"]
# ---- end of fixed values ----

_PAIR = T.ArrayType(T.StructType([T.StructField("name", T.StringType()), T.StructField("value", T.StringType())]))
#: An extraction: the assets read from one page.
EXTRACTION = T.StructType(
    [
        T.StructField(
            "assets",
            T.ArrayType(
                T.StructType(
                    [T.StructField(n, T.StringType()) for n in ("preferred_name",)]
                    + [T.StructField("synonyms", T.ArrayType(T.StringType()))]
                    + [T.StructField(n, T.StringType()) for n in ("modality_verbatim", "target_verbatim", "mechanism_verbatim", "originator_verbatim")]
                    + [
                        T.StructField("partners", T.ArrayType(T.StructType([T.StructField(n, T.StringType()) for n in ("name", "role", "territory")]))),
                        T.StructField(
                            "programs",
                            T.ArrayType(T.StructType([*[T.StructField(n, T.StringType()) for n in ("indication_verbatim", "phase_verbatim", "status")], T.StructField("additional_fields", _PAIR)])),
                        ),
                        T.StructField("additional_fields", _PAIR),
                    ]
                )
            ),
        ),
        T.StructField("page_notes", T.StringType()),
    ]
)


def document_kind(content_type: Column, extension: Column) -> Column:
    """csv, xlsx or pdf by content type (parameters ignored), else by extension; null if neither tells."""
    kind = F.lit(None).cast("string")
    base = F.trim(F.lower(F.split(F.coalesce(content_type, F.lit("")), ";")[0]))
    for token in (F.lower(extension), base):
        for name, tokens in KINDS.items():
            kind = F.when(token.isin(*tokens), name).otherwise(kind)
    return kind


def sniffed_delimiter(text: str) -> str:
    """The delimiter that stands most often, and equally often in each line, of the first 4096 characters."""
    lines = [line for line in text[:4096].lstrip("﻿").splitlines() if line.strip()][:20]
    best = max(DELIMITERS, key=lambda c: (min((line.count(c) for line in lines), default=0), sum(line.count(c) for line in lines), -DELIMITERS.index(c)))
    return best if lines and any(best in line for line in lines) else ","


def read_delimited(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    """A delimited file or folder; the delimiter is taken from the first file's beginning, a byte order mark is skipped."""
    start = spark.read.text(path).limit(20).collect()
    delimiter = sniffed_delimiter("\n".join(r[0] for r in start))
    df = spark.read.csv(path, sep=delimiter, header=header, multiLine=True, encoding="UTF-8")
    return df.toDF(*[c.lstrip("﻿") for c in df.columns])


def parsed_extractions(raw: DataFrame, column: str = "raw_json") -> DataFrame:
    """``raw`` with ``extraction`` (null where the text doesn't parse) and ``ok``: bad items fail alone."""
    parsed = F.from_json(F.col(column), EXTRACTION)
    return raw.withColumn("extraction", parsed).withColumn("ok", F.col("extraction.assets").isNotNull())


def exploded_assets(parsed: DataFrame, *keep: str) -> DataFrame:
    """One row per asset of the extractions that parsed, with its place ``ordinal``."""
    return parsed.where("ok").select(*keep, F.posexplode("extraction.assets").alias("ordinal", "a")).select(*keep, "ordinal", "a.*")


def read_captures(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    """JSON captures, one a file or (without ``multiline``) one a line: {captured, period, assets: [...]}, in order of ``captured``."""
    asset = "array<struct<asset_id:string,name:string,phase_code:string,partners:array<string>>>"
    rows = spark.read.schema(f"captured string, period string, assets {asset}").json(path, multiLine=multiline)
    return (
        rows.select(F.col("captured").cast("timestamp_ntz").alias("captured_at"), "period", F.explode_outer("assets").alias("a"))
        .select("captured_at", "period", "a.*").orderBy("captured_at", "asset_id")
    )


def read_golden(spark: SparkSession, folder: str) -> DataFrame:
    """Labelled fixtures: folders with meta.json whose labeled is true and an expected.json."""
    name = F.regexp_extract(F.input_file_name(), "([^/]+)/[^/]+$", 1)
    meta = spark.read.json(f"{folder}/*/meta.json", multiLine=True).withColumn("slug", name)
    expected = spark.read.schema(EXTRACTION).json(f"{folder}/*/expected.json", multiLine=True).withColumn("slug", name)
    return meta.where(F.col("labeled").eqNullSafe(True)).join(expected, "slug")


def write_golden(labels: DataFrame, folder: str) -> None:
    """Labels as JSON, one folder per slug, replacing those of the slugs given."""
    labels.repartition("slug").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("slug").json(folder)


_SHEET = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"


def xlsx_rows(content: bytes) -> list[tuple[str, int, list[str]]]:
    """sheet, row, cells as stripped text of every sheet of a workbook; blank rows are left out."""
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        names = set(book.namelist())
        shared: list[str] = []
        if "xl/sharedStrings.xml" in names:
            shared = ["".join(t.text or "" for t in si.iter(f"{_SHEET}t")) for si in ElementTree.fromstring(book.read("xl/sharedStrings.xml")).iter(f"{_SHEET}si")]
        titles = [s.get("name", "") for s in ElementTree.fromstring(book.read("xl/workbook.xml")).iter(f"{_SHEET}sheet")]
        sheets = sorted((n for n in names if re.fullmatch(r"xl/worksheets/sheet\d+\.xml", n)), key=lambda n: int(re.findall(r"\d+", n)[0]))
        out = []
        for title, part in zip(titles, sheets, strict=False):
            for number, row in enumerate(ElementTree.fromstring(book.read(part)).iter(f"{_SHEET}row")):
                cells: list[str] = []
                for c in row.iter(f"{_SHEET}c"):
                    letters = re.match("[A-Z]*", c.get("r", "")).group()
                    at = sum((ord(x) - 64) * 26**i for i, x in enumerate(reversed(letters))) - 1 if letters else len(cells)
                    cells += [""] * (at - len(cells))
                    value = c.find(f"{_SHEET}v")
                    said = "".join(t.text or "" for t in c.iter(f"{_SHEET}t")) if c.get("t") == "inlineStr" else (value.text or "") if value is not None else ""
                    cells.append((shared[int(said)] if c.get("t") == "s" and said else said).strip())
                if any(cells):
                    out.append((title, number, cells))
        return out


def read_xlsx(spark: SparkSession, path: str) -> DataFrame:
    """path, sheet, row, cells, error of every workbook of a folder; one that can't be read is a row with its error."""

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows: list[tuple] = []
            for where, content in zip(batch["path"], batch["content"], strict=True):
                try:
                    rows += [(where, sheet, n, cells, None) for sheet, n, cells in xlsx_rows(content)]
                except (zipfile.BadZipFile, KeyError, ElementTree.ParseError, ValueError, IndexError) as e:
                    rows.append((where, None, None, None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(rows, columns=["path", "sheet", "row", "cells", "error"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(parse, "path string, sheet string, row int, cells array<string>, error string")


def xlsx_bytes(sheets: dict[str, list[list[str]]]) -> bytes:
    """A workbook of text cells."""
    held = io.BytesIO()
    with zipfile.ZipFile(held, "w") as book:
        listed = "".join(f'<sheet name="{escape(n)}" sheetId="{i}"/>' for i, n in enumerate(sheets, 1))
        book.writestr("xl/workbook.xml", f'<workbook xmlns="{_SHEET[1:-1]}"><sheets>{listed}</sheets></workbook>')
        for i, rows in enumerate(sheets.values(), 1):
            body = "".join("<row>" + "".join(f'<c t="inlineStr"><is><t>{escape(c)}</t></is></c>' for c in row) + "</row>" for row in rows)
            book.writestr(f"xl/worksheets/sheet{i}.xml", f'<worksheet xmlns="{_SHEET[1:-1]}"><sheetData>{body}</sheetData></worksheet>')
    return held.getvalue()
