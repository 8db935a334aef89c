"""Documents: file scan and parsing into typed elements."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import files

# Folders of a pattern are dealt to so many tasks for each core, and to more where one would get more than so many.
TASKS_PER_CORE = 8
FOLDERS_PER_TASK = 32
# Files read at a time: until they have so many bytes, or are so many.
BATCH_BYTES = 4 << 20
BATCH_ROWS = 1000

ELEMENTS = "array<struct<id int, type string, content string>>"

# Element type of each HTML tag, and tags whose text is never content.
_TYPE_OF_TAG = {
    "title": "title",
    "h1": "title",
    "h2": "section_header",
    "h3": "section_header",
    "h4": "section_header",
    "h5": "section_header",
    "h6": "section_header",
    "p": "text",
    "li": "text",
    "caption": "caption",
    "figcaption": "caption",
    "table": "table",
}
_MARGIN = {"nav": "page_header", "header": "page_header", "footer": "page_footer"}
_UNSEEN = {"script", "style", "noscript", "template"}
# A header in one of these heads content, not the page.
_CONTENT = {"article", "section", "main"}
_BLOCKS = {"article", "section", "main", "div", "ul", "ol", "body", "blockquote", "pre", "hr"}


class _ElementReader(HTMLParser):
    """Collects (type, text) of one page; unclosed paragraphs end where the next block starts."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.elements: list[tuple[str, str]] = []
        self._parts: list[str] = []
        self._type = "text"
        self._margins: list[str] = []
        self._unseen = 0
        self._inner = 0
        self._tables = 0

    def _flush(self, next_type: str = "text") -> None:
        content = " ".join("".join(self._parts).split())
        if content:
            kind = _MARGIN[self._margins[-1]] if self._margins else self._type
            self.elements.append((kind, content))
        self._parts = []
        self._type = next_type

    def handle_starttag(self, tag: str, attrs) -> None:
        if tag in _CONTENT:
            # Content ends whatever was left open before it, outside of a footer's own sections.
            if "footer" not in self._margins:
                self._flush()
                self._margins.clear()
            self._unseen = 0
            self._inner += 1
        if tag in _UNSEEN:
            self._unseen += 1
        elif tag in _MARGIN and not (tag == "header" and self._inner):
            self._flush()
            self._margins.append(tag)
        elif self._tables and tag not in ("table", "caption"):
            self._parts.append(" ")
        elif tag in _TYPE_OF_TAG:
            self._flush(_TYPE_OF_TAG[tag])
            self._tables += tag == "table"
        elif tag in _BLOCKS:
            self._flush()
        elif tag == "br":
            self._parts.append(" ")

    def handle_endtag(self, tag: str) -> None:
        if tag in _CONTENT:
            self._inner = max(0, self._inner - 1)
        if tag in _UNSEEN:
            self._unseen = max(0, self._unseen - 1)
        elif tag in _MARGIN:
            self._flush()
            if tag in self._margins:
                del self._margins[self._margins.index(tag):]
        elif tag == "table":
            self._flush()
            self._tables = max(0, self._tables - 1)
        elif tag == "caption" and self._tables:
            self._flush("table")
        elif not self._tables and (tag in _TYPE_OF_TAG or tag in _BLOCKS):
            self._flush()

    def handle_data(self, data: str) -> None:
        if not self._unseen:
            self._parts.append(data)

    def read(self, html: str) -> list[dict]:
        self.feed(html)
        self.close()
        self._flush()
        return [
            {"id": position, "type": kind, "content": content}
            for position, (kind, content) in enumerate(self.elements)
        ]


def _read_pages(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        elements = [[] if html is None else _ElementReader().read(html) for html in batch["html"]]
        yield pd.DataFrame({"path": batch["path"], "elements": elements})


def _scan_folders(spark: SparkSession, folders: list[str], names: str, content: bool) -> DataFrame:
    """The same of many folders, each listed and read by a task; the driver sees none of their files."""
    wanted = re.compile(spark.sparkContext._jvm.org.apache.hadoop.fs.GlobPattern(names).compiled().pattern(), re.DOTALL)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number in batch.column("id").to_pylist():
                folder = folders[number]
                store, root = files.opened(folder)
                rows, held = [], 0
                for info in store.get_file_info(fs.FileSelector(root)):
                    # As Spark lists a folder: no hidden files, and none of no bytes.
                    if not info.is_file or not info.size or files.hidden(info.base_name) or not wanted.fullmatch(info.base_name):
                        continue
                    row = {"path": f"{folder}/{info.base_name}", "length": info.size}
                    if content:
                        with store.open_input_stream(info.path, compression=None) as file:
                            row["content"] = file.read()
                        held += info.size
                    rows.append(row)
                    if held >= BATCH_BYTES or len(rows) == BATCH_ROWS:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    schema = pa.schema([("path", pa.string()), *[("content", pa.binary())] * content, ("length", pa.int64())])
    tasks = min(len(folders), max(TASKS_PER_CORE * spark.sparkContext.defaultParallelism, -(-len(folders) // FOLDERS_PER_TASK)))
    dealt = spark.range(0, len(folders), numPartitions=tasks)
    return dealt.mapInArrow(scan, "path string, content binary, length long" if content else "path string, length long")


def scan_documents(spark: SparkSession, folder: str, names: str = "*", content: bool = True) -> DataFrame:
    """Every file of a folder whose name matches the glob ``names``, as (path, content).

    ``folder`` may be a pattern of folders. Those are listed and read by tasks, in stores that a task can open, without
    folders below them; else Spark keeps the status of every file in the driver. Without ``content`` the files are only
    listed, as (path, length).
    """
    columns = ["path", "content" if content else "length"]
    folders = files.folders_of(spark, folder)
    if folders:
        return _scan_folders(spark, folders, names, content).select(columns)
    return spark.read.format("binaryFile").option("pathGlobFilter", names).load(folder).select(columns)


def _as_document(elements: Column) -> Column:
    return F.to_variant_object(F.struct(F.struct(elements.alias("elements")).alias("document")))


def parse_html(pages: DataFrame) -> DataFrame:
    """(path, html) to (path, parsed), a variant with ``document.elements[]`` of id, type, content.

    Pages are parsed in Python, whole and independently of each other. A variant holds up to 128 MiB;
    a NULL page gives a document without elements.
    """
    parsed = pages.select("path", "html").mapInPandas(_read_pages, f"path string, elements {ELEMENTS}")
    return parsed.select("path", _as_document(F.col("elements")).alias("parsed"))


def parse_json_documents(documents: DataFrame) -> DataFrame:
    """(path, content as JSON text) to (path, parsed); bad JSON gives a NULL variant."""
    return documents.select("path", F.try_parse_json(F.col("content").cast("string")).alias("parsed"))


_KINDS = {"html": "html", "htm": "html", "json": "json"}


def _kind(path: Column) -> Column:
    """'html', 'json' or NULL, by the extension in any case."""
    extension = F.lower(F.regexp_extract(path, r"\.([^./]*)$", 1))
    return F.coalesce(*[F.when(extension == name, kind) for name, kind in _KINDS.items()])


def parse_documents(spark: SparkSession, folder: str) -> DataFrame:
    """(path, parsed) of the HTML pages and parsed JSON documents of a folder, extensions in any case.

    Each file is read once. ``rejected_documents`` accounts for the files that give nothing.
    """
    pages = scan_documents(spark, folder, "*.{[hH][tT][mM][lL],[hH][tT][mM]}")
    parsed = parse_html(pages.select("path", F.col("content").cast("string").alias("html")))
    return parsed.unionByName(parse_json_documents(scan_documents(spark, folder, "*.[jJ][sS][oO][nN]")))


def rejected_documents(scanned: DataFrame, parsed: DataFrame) -> DataFrame:
    """(path, length, reason) of every scanned document that gives no element.

    ``scanned`` has path and content or length, ``parsed`` is the result of parsing it. Accepted and rejected
    documents add up to the scanned ones. Spark does not list files of no bytes.
    """
    kind = _kind(F.col("path"))
    elements = F.try_variant_get("parsed", "$.document.elements", "array<variant>")
    outcome = parsed.select("path", F.col("parsed").isNull().alias("_broken"), F.size(elements).alias("_elements"))
    reason = (
        F.when(kind.isNull(), "unknown file type")
        .when(F.coalesce("_broken", F.lit(True)), "not read as JSON: broken, or above a limit of the parser")
        .when(F.col("_elements").isNull(), "no list of elements")
        .when(F.col("_elements") == 0, "no elements")
    )
    length = F.octet_length("content").cast("long") if "content" in scanned.columns else F.col("length")
    sized = scanned.select("path", length.alias("length"))
    return sized.join(outcome, "path", "left").select("path", "length", reason.alias("reason")).filter("reason IS NOT NULL")
