"""Landed JSON answers as a data source, `spark.read.format("lutrin_pages")`.

The same records as `json_pages.read_pages`, with the number of their page. Lost pages stop the
read instead of taking jobs of their own: numbers that are missing or repeated are found in the
listing before a task starts, short pages by the task that reads them.

Options: `path` (a folder, or several with commas; subfolders belong to it), `record` (schema of one
record as JSON; or give `schema(…)` with the columns of a record and those of `PLACE`), `wrapper` (name of the array in an answer), `page_size` (judge the pages, as
`json_pages.incomplete_pages` does), `page_pattern`, `task_bytes` (files are read together up to
so many bytes; no file is split), `first` and `last` (only pages of these numbers are opened, files
without a number are not; short pages among the others are not noticed, gaps are). Conditions of a query
are left to Spark on purpose: Spark 4.1 keeps the reader that a condition was pushed into, and the next query
without one on the same DataFrame would read only what that reader left.

Tasks open files through Arrow's file systems, as Spark lends its own to no Python task: local
paths, `hdfs`, `s3`, `s3a` and `gs`. Other stores keep to `read_pages`.
"""

import json
import posixpath
import re
from collections import defaultdict

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import datasource as D
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from lutrin.sources.json_pages import MISSING, PAGE_PATTERN, REPEATED, SHORT

NAME = "lutrin_pages"
PLACE = T.StructType().add("dossier", T.StringType()).add("fichier", T.StringType()).add("page", T.LongType())
TASK_BYTES = 32 << 20
ROWS = 10_000  # of a batch


class LostPages(Exception):
    """Pages of a folder are missing, repeated or cut short."""


class Number(str):
    """A number as it is written in the answer."""


def text_of(value):
    """A JSON value as text: strings as they are, numbers as they were written, others without blanks between their parts."""
    if isinstance(value, str):
        return str(value)
    return _json(value)


def _json(value):
    if isinstance(value, Number):
        return str(value)
    if isinstance(value, dict):
        return "{" + ",".join(f"{json.dumps(k, ensure_ascii=False)}:{_json(v)}" for k, v in value.items()) + "}"
    if isinstance(value, list):
        return "[" + ",".join(map(_json, value)) + "]"
    return json.dumps(value, ensure_ascii=False)


def shaped(value, kind):
    """A JSON value in the type of its column; one of another type is an error. Missing ones are null."""
    if value is None:
        return None
    if isinstance(kind, T.StringType):
        return text_of(value)
    if isinstance(kind, T.StructType) and isinstance(value, dict):
        return {f.name: shaped(value.get(f.name), f.dataType) for f in kind.fields}
    if isinstance(kind, T.ArrayType) and isinstance(value, list):
        return [shaped(v, kind.elementType) for v in value]
    if isinstance(kind, T.BooleanType) and isinstance(value, bool):
        return value
    if isinstance(kind, T.IntegralType) and isinstance(value, Number):
        return int(value)
    if isinstance(kind, T.FractionalType) and not isinstance(kind, T.DecimalType) and isinstance(value, Number):
        return float(value)
    raise ValueError(f"a value is no {kind.simpleString()}")


def records_of(answer, fields, wrapper):
    """The records of an answer: an array of them, one alone, or an array under `wrapper`."""
    for item in answer if isinstance(answer, list) else [answer]:
        if not isinstance(item, dict):
            raise ValueError("a record is no object")
        if wrapper and item.get(wrapper) is not None:
            yield from item[wrapper]
        elif not wrapper or any(item.get(f) is not None for f in fields):
            yield item


def _open(path):
    """(file system, path in it)"""
    path = re.sub(r"^s3a:", "s3:", path)
    if re.match(r"[A-Za-z][A-Za-z0-9+.-]*:", path):
        return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path))
    return fs.LocalFileSystem(), path


class Group(D.InputPartition):
    """Files that one task reads: (root, path, dossier, fichier, page, whether short is fine)."""

    def __init__(self, files):
        super().__init__(None)
        self.files = files


class PageReader(D.DataSourceReader):
    def __init__(self, schema, options):
        names = {f.name for f in PLACE.fields}
        self.record = T.StructType([f for f in schema.fields if f.name not in names])
        self.schema = schema
        self.roots = [p.strip() for p in options["path"].split(",")]
        self.wrapper = options.get("wrapper")
        self.page_size = int(options.get("page_size", 0))
        self.page_pattern = options.get("page_pattern", PAGE_PATTERN)
        self.task_bytes = int(options.get("task_bytes", TASK_BYTES))
        self.first, self.last = (int(options[k]) if k in options else None for k in ("first", "last"))

    def wanted(self, page):
        if self.first is None and self.last is None:
            return True
        return page is not None and (self.first or page) <= page <= (self.last or page)

    def listed(self):
        """All landed files, in the order of their pages: (root, path, size, place)."""
        found = []
        for root in self.roots:
            files, inner = _open(root)
            chosen = files.get_file_info(inner)
            if chosen.type == fs.FileType.NotFound:
                raise FileNotFoundError(root)
            infos = [chosen] if chosen.is_file else files.get_file_info(fs.FileSelector(inner, recursive=True))
            below = inner.rstrip("/") + "/"
            for info in infos:
                parts = info.path.removeprefix(below).split("/") if not chosen.is_file else [info.base_name]
                if info.is_file and not any(p.startswith(("_", ".")) for p in parts):
                    number = re.search(self.page_pattern, info.base_name)
                    folder = "/" + posixpath.dirname(info.path).lstrip("/")
                    place = {"dossier": folder, "fichier": info.base_name, "page": int(number[1]) if number else None}
                    found.append((root, info.path, info.size, place))
        return sorted(found, key=lambda x: (x[3]["dossier"], x[3]["page"] is None, x[3]["page"] or 0, x[3]["fichier"]))

    def partitions(self):
        listed = self.listed()
        pages = defaultdict(list)
        for *_, place in listed:
            pages[place["dossier"]] += [place["page"]] if place["page"] is not None else []
        if self.page_size:
            problems = [p for folder, numbers in pages.items() for p in gaps(folder, numbers)]
            if problems:
                raise LostPages(f"{len(problems)} problem(s), the first: {problems[0]}")
        groups, size = [[]], 0
        for root, path, n, place in listed:
            if not self.wanted(place["page"]):
                continue
            if groups[-1] and size + n > self.task_bytes:
                groups.append([])
                size = 0
            numbers = pages[place["dossier"]]
            groups[-1].append((root, path, *place.values(), not numbers or place["page"] == numbers[-1]))
            size += n
        return [Group(files) for files in groups]

    def read(self, partition):
        kinds = to_arrow_schema(self.schema)
        fields = [f.name for f in self.record.fields]
        for root, path, dossier, fichier, page, may_be_short in partition.files:
            files, _ = _open(root)
            with files.open_input_stream(path, compression="detect") as stream:
                text = stream.read()
            try:
                answer = json.loads(text.decode("utf-8-sig"), parse_int=Number, parse_float=Number)
                rows = [shaped(r, self.record) for r in records_of(answer, fields, self.wrapper)]
            except (ValueError, TypeError) as error:  # the message names no content
                raise ValueError(f"MALFORMED answer in {dossier}/{fichier}: {type(error).__name__}") from None
            if len(rows) < self.page_size and not may_be_short:
                raise LostPages(f"{dossier}/{fichier}: {SHORT}, {len(rows)} of {self.page_size} records")
            place = {"dossier": dossier, "fichier": fichier, "page": page}
            for start in range(0, len(rows), ROWS):
                yield pa.RecordBatch.from_pylist([{**(r or {}), **place} for r in rows[start : start + ROWS]], kinds)


def gaps(folder, numbers):
    """Page numbers of a folder, in order, that are missing between 1 and the last one, or repeated."""
    before = 0
    for page in numbers:
        if page > before + 1:
            yield f"{folder}: {MISSING}, {before + 1} - {page - 1}"
        elif page == before:
            yield f"{folder}: {REPEATED}, {page}"
        before = page


class PageSource(D.DataSource):
    @classmethod
    def name(cls):
        return NAME

    def schema(self):
        record = T.StructType.fromJson(json.loads(self.options["record"]))
        clash = {f.name.lower() for f in record.fields} & {f.name for f in PLACE.fields}
        if clash:
            raise ValueError(f"names of a record that are taken: {sorted(clash)}")
        return T.StructType(record.fields + PLACE.fields)

    def reader(self, schema):
        return PageReader(schema, self.options)


def load_pages(spark, path, record, wrapper=None, page_size=None, **options):
    """Records of landed answers with dossier, fichier and page; `page_size` makes lost pages an error.

    `record` is the schema of one record. Further options are those of the format.
    """
    spark.dataSource.register(PageSource)
    record = T.StructType.fromDDL(record) if isinstance(record, str) else record
    chosen = options | {"record": record.json(), "wrapper": wrapper, "page_size": page_size}
    return spark.read.format(NAME).options(**{k: str(v) for k, v in chosen.items() if v is not None}).load(path)
