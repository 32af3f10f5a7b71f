"""Spreadsheet workbooks (.xlsx) as a source.

Spark has no xlsx reader. Two routes, with one streaming parser from the standard library (an xlsx
file is a zip of XML parts; rows are dropped as they go out, a sheet is never a list):

* ``WorkbookSource``, a Python Data Source: one task per workbook, opened in place; its writer
  streams rows into workbooks and commits or aborts them as a whole;
* ``read_workbooks``: Spark's own ``binaryFile`` source, on any file system that Spark reads. One
  workbook is one row of bytes, bounded by the format's row limit.

Every cell is read as a string (numbers keep their digits, so long ids stay
exact), the first row is the header, blank cells are null, and by default the
NA-like words become null as a spreadsheet reader does.
"""

from __future__ import annotations

import io
import json
import re
import uuid
import zipfile
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass
from itertools import islice
from xml.etree import ElementTree as ET
from xml.sax.saxutils import escape

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage
from pyspark.sql.types import StringType, StructField, StructType

from lexgrid.functions.clean import NA_TOKENS, null_tokens

NS = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main",
      "r": "http://schemas.openxmlformats.org/officeDocument/2006/relationships",
      "p": "http://schemas.openxmlformats.org/package/2006/relationships"}
_CELL_REF = re.compile(r"([A-Z]+)(\d+)")


def _col_index(letters: str) -> int:
    n = 0
    for ch in letters:
        n = n * 26 + (ord(ch) - 64)
    return n - 1


def _col_letters(i: int) -> str:
    s = ""
    i += 1
    while i:
        i, r = divmod(i - 1, 26)
        s = chr(65 + r) + s
    return s


def _number_text(v: str) -> str:
    """Numbers as written by a spreadsheet: integral values without '.0' or exponent."""
    try:
        f = float(v)
    except ValueError:
        return v
    if f.is_integer() and ("e" in v.lower() or "." in v):
        return str(int(f))
    return v


def _first_sheet(z: zipfile.ZipFile) -> str:
    try:
        wb = ET.fromstring(z.read("xl/workbook.xml"))
        sheet = wb.find("m:sheets/m:sheet", NS)
        rid = sheet.get(f"{{{NS['r']}}}id")
        rels = ET.fromstring(z.read("xl/_rels/workbook.xml.rels"))
        for rel in rels.findall("p:Relationship", NS):
            if rel.get("Id") == rid:
                target = rel.get("Target").lstrip("/")
                return target if target.startswith("xl/") else "xl/" + target
    except (KeyError, AttributeError):
        pass
    return "xl/worksheets/sheet1.xml"


def _shared_strings(z: zipfile.ZipFile) -> list[str]:
    if "xl/sharedStrings.xml" not in z.namelist():
        return []
    sst = ET.fromstring(z.read("xl/sharedStrings.xml"))
    return ["".join(t.text or "" for t in si.iter(f"{{{NS['m']}}}t")) for si in sst.findall("m:si", NS)]


def sheet_rows(file) -> Iterator[list[str | None]]:
    """Rows of the first sheet, the header first, every cell as text (None if blank), as they are parsed."""
    with zipfile.ZipFile(file) as z:
        shared = _shared_strings(z)
        with z.open(_first_sheet(z)) as part:
            yield from _cells(part, shared)


def picked_rows(file, where: str, columns: Sequence[str], optional: Sequence[str] = (),
                aliases: Mapping[str, str] | None = None) -> Iterator[list[str | None]]:
    """The cells of ``columns``, by header name, of every data row; ``where`` names the file in errors."""
    rows = sheet_rows(file)
    header = next(rows, None)
    if header is None:
        return
    named = [h if h is not None else f"column{i}" for i, h in enumerate(header)]
    place = {(aliases or {}).get(h, h): i for i, h in enumerate(named)}
    missing = [c for c in columns if c not in place and c not in optional]
    if missing:
        raise ValueError(f"{where} has no column {', '.join(missing)}; its header is {', '.join(named)}")
    at = [place.get(c, -1) for c in columns]
    for row in rows:
        yield [row[i] if 0 <= i < len(row) else None for i in at]


def _rows(part) -> Iterator[ET.Element]:
    """Row elements of a sheet as they are parsed; each is dropped once it is used."""
    for _, element in ET.iterparse(part):
        if element.tag == f"{{{NS['m']}}}row":
            yield element
            element.clear()


def _cells(part, shared: list[str]) -> Iterator[list[str | None]]:
    for row in _rows(part):
        cells: dict[int, str | None] = {}
        for pos, c in enumerate(row.findall("m:c", NS)):
            ref = c.get("r")
            idx = _col_index(_CELL_REF.match(ref).group(1)) if ref else pos
            kind = c.get("t")
            if kind == "inlineStr":
                val = "".join(t.text or "" for t in c.iter(f"{{{NS['m']}}}t"))
            else:
                v = c.find("m:v", NS)
                text = v.text if v is not None else None
                if text is None:
                    val = None
                elif kind == "s":
                    val = shared[int(text)]
                elif kind == "b":
                    val = "True" if text == "1" else "False"
                elif kind in ("str", "e"):
                    val = text
                else:
                    val = _number_text(text)
            cells[idx] = val if val != "" else None
        width = max(cells) + 1 if cells else 0
        yield [cells.get(i) for i in range(width)]


_PARTS = {
    "[Content_Types].xml": (
        '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
        '<Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types">'
        '<Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/>'
        '<Default Extension="xml" ContentType="application/xml"/>'
        '<Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/>'
        '<Override PartName="/xl/worksheets/sheet1.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>'
        "</Types>"),
    "_rels/.rels": (
        '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
        f'<Relationships xmlns="{NS["p"]}"><Relationship Id="rId1" '
        'Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/officeDocument" '
        'Target="xl/workbook.xml"/></Relationships>'),
    "xl/workbook.xml": (
        '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
        f'<workbook xmlns="{NS["m"]}" xmlns:r="{NS["r"]}"><sheets>'
        '<sheet name="Sheet1" sheetId="1" r:id="rId1"/></sheets></workbook>'),
    "xl/_rels/workbook.xml.rels": (
        '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
        f'<Relationships xmlns="{NS["p"]}"><Relationship Id="rId1" '
        'Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/worksheet" '
        'Target="worksheets/sheet1.xml"/></Relationships>'),
}


class SheetWriter:
    """Writes one workbook row by row: a single sheet with inline strings (blank for None or '')."""

    def __init__(self, file, header: Sequence[str]):
        self.zip = zipfile.ZipFile(file, "w", zipfile.ZIP_DEFLATED)
        for name, text in _PARTS.items():
            self.zip.writestr(name, text)
        self.sheet = self.zip.open("xl/worksheets/sheet1.xml", "w")
        self.sheet.write(('<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
                          f'<worksheet xmlns="{NS["m"]}"><sheetData>').encode())
        self.rows = 0
        self.add(header)

    def add(self, row: Sequence[str | None]) -> None:
        self.rows += 1
        cells = "".join(
            f'<c r="{_col_letters(i)}{self.rows}" t="inlineStr"><is><t xml:space="preserve">{escape(str(v))}</t></is></c>'
            for i, v in enumerate(row) if v is not None and v != "")
        self.sheet.write(f'<row r="{self.rows}">{cells}</row>'.encode())

    def close(self) -> None:
        self.sheet.write(b"</sheetData></worksheet>")
        self.sheet.close()
        self.zip.close()


def parse_workbooks(files: DataFrame, columns: Sequence[str], path: str = "path",
                    content: str = "content", source_col: str | None = "source_file",
                    optional: Sequence[str] = (), aliases: Mapping[str, str] | None = None) -> DataFrame:
    """One output row per data row of every workbook; ``columns`` picked by header name.

    ``aliases`` maps other header names to a column's. A column that a header lacks is an
    error, or null where it is named in ``optional``. An empty workbook has no rows.
    """
    cols = list(columns)
    schema = StructType([StructField(c, StringType(), True) for c in [*cols, *([source_col] if source_col else [])]])

    def explode_books(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = pa.schema([(f.name, pa.string()) for f in schema.fields])
        for b in batches:
            for i in range(b.num_rows):
                where = b.column(0)[i].as_py()
                rows = picked_rows(io.BytesIO(b.column(1)[i].as_py()), where, cols, optional, aliases)
                yield from _in_batches((r + [where] if source_col else r for r in rows), out)

    return files.select(path, content).mapInArrow(explode_books, schema)


def _in_batches(rows: Iterator[list], schema: pa.Schema, size: int = 1000) -> Iterator[pa.RecordBatch]:
    while part := list(islice(rows, size)):
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*part), schema.types)], schema=schema)


def read_workbooks(spark: SparkSession, path: str, columns: Sequence[str],
                   na_tokens: Sequence[str] | None = NA_TOKENS,
                   source_col: str | None = "source_file", optional: Sequence[str] = (),
                   aliases: Mapping[str, str] | None = None) -> DataFrame:
    """S3: every ``*.xlsx`` under ``path``; all cells as strings, NA words to null."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.xlsx") \
        .option("recursiveFileLookup", "true").load(path)
    df = parse_workbooks(files, columns, source_col=source_col, optional=optional, aliases=aliases)
    return null_tokens(df, list(columns), na_tokens) if na_tokens is not None else df


MAX_SHEET_ROWS = 100_000


@dataclass
class WorkbookFile(InputPartition):
    path: str


@dataclass
class WrittenFiles(WriterCommitMessage):
    paths: list[str]


class WorkbookSource(DataSource):
    """``spark.read.format("workbook").schema(...).load(path)`` and ``df.write.format("workbook").save(path)``.

    Columns are strings, found by header name. Options: ``optional`` and ``aliases`` (JSON) as in ``parse_workbooks``;
    ``maxRows``, the rows of a workbook that is written. Paths are those that ``pyarrow.fs`` opens; ``read_workbooks``
    reads from any file system that Spark reads.
    """

    @classmethod
    def name(cls) -> str:
        return "workbook"

    def reader(self, schema: StructType) -> "WorkbookReader":
        return WorkbookReader(schema, dict(self.options))      # option names arrive in lower case

    def writer(self, schema: StructType, overwrite: bool) -> "WorkbookWriter":
        return WorkbookWriter(schema, dict(self.options), overwrite)


def _file_system(path: str):
    from pyarrow import fs
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def _string_columns(schema: StructType) -> list[str]:
    other = [f.name for f in schema.fields if not isinstance(f.dataType, StringType)]
    if other:
        raise ValueError(f"workbook columns are strings; cast {', '.join(other)}")
    return [f.name for f in schema.fields]


class WorkbookReader(DataSourceReader):
    """One task per workbook; rows go out as they are parsed."""

    def __init__(self, schema: StructType, options: dict):
        self.columns, self.path = _string_columns(schema), options["path"]
        self.optional, self.aliases = json.loads(options.get("optional", "[]")), json.loads(options.get("aliases", "{}"))

    def partitions(self) -> list[InputPartition]:
        from pyarrow import fs
        system, base = _file_system(self.path)
        found = system.get_file_info(fs.FileSelector(base, recursive=True))
        hidden = lambda f: any(part.startswith(("_", ".")) for part in f.path[len(base):].split("/"))
        return [WorkbookFile(f.path) for f in sorted(found, key=lambda f: f.path) if f.path.endswith(".xlsx") and not hidden(f)] or [WorkbookFile("")]

    def read(self, partition: WorkbookFile) -> Iterator[pa.RecordBatch]:
        if partition.path:
            system, _ = _file_system(self.path)
            with system.open_input_file(partition.path) as file:
                yield from _in_batches(picked_rows(file, partition.path, self.columns, self.optional, self.aliases),
                                       pa.schema([(c, pa.string()) for c in self.columns]))


class WorkbookWriter(DataSourceWriter):
    """Tasks write below ``_temporary``; the commit moves their files into place, an abort takes them away."""

    def __init__(self, schema: StructType, options: dict, overwrite: bool):
        self.columns, self.path, self.overwrite = _string_columns(schema), options["path"].rstrip("/"), overwrite
        self.rows = int(options.get("maxrows", MAX_SHEET_ROWS))
        self.job = uuid.uuid4().hex

    def write(self, iterator: Iterator) -> WrittenFiles:
        system, base = _file_system(self.path)
        system.create_dir(f"{base}/_temporary/{self.job}")
        paths: list[str] = []
        rows = iter(iterator)
        while (first := next(rows, None)) is not None:
            paths.append(f"{base}/_temporary/{self.job}/part-{uuid.uuid4().hex}.xlsx")
            with system.open_output_stream(paths[-1]) as file:
                sheet = SheetWriter(file, self.columns)
                sheet.add(list(first))
                for row in islice(rows, self.rows - 1):
                    sheet.add(list(row))
                sheet.close()
        return WrittenFiles(paths)

    def commit(self, messages: list[WrittenFiles | None]) -> None:
        from pyarrow import fs
        system, base = _file_system(self.path)
        if self.overwrite:
            for f in system.get_file_info(fs.FileSelector(base, allow_not_found=True)):
                if f.path.endswith(".xlsx"):
                    system.delete_file(f.path)
        for path in (p for m in messages if m is not None for p in m.paths):
            system.move(path, f"{base}/{path.rsplit('/', 1)[1]}")
        self._tidy(system, base)

    def abort(self, messages: list[WrittenFiles | None]) -> None:
        self._tidy(*_file_system(self.path))

    def _tidy(self, system, base: str) -> None:
        from pyarrow import fs
        if system.get_file_info(f"{base}/_temporary/{self.job}").type != fs.FileType.NotFound:
            system.delete_dir(f"{base}/_temporary/{self.job}")


def register_workbooks(spark: SparkSession) -> None:
    """Make the format ``workbook`` known to the session; the classes travel with it, so no worker has to have the package."""
    import sys

    from pyspark import cloudpickle
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    try:
        spark.dataSource.register(WorkbookSource)
    finally:
        cloudpickle.unregister_pickle_by_value(sys.modules[__name__])


def write_workbook_file(path: str, header: Sequence[str], rows: Sequence[Sequence[str | None]]) -> None:
    """Local helper (tests, fixtures): write one workbook file."""
    with open(path, "wb") as f:
        sheet = SheetWriter(f, header)
        for row in rows:
            sheet.add(row)
        sheet.close()
