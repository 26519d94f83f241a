"""Package files (DTSX): executables at any depth, with the SQL that belongs to each. Names match whatever the namespace."""

from __future__ import annotations

import xml.etree.ElementTree as ET

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomline.functions.scalars import path_stem

_OUT = "file string, package string, ord int, task string, task_type string, sql array<string>, connections array<string>, error string"


def _local(tag: str) -> str:
    return tag.rsplit("}", 1)[-1]


def _attributes(e: ET.Element) -> dict[str, str]:
    return {_local(k).lower(): v for k, v in e.attrib.items()}


def _properties(e: ET.Element) -> dict[str, str]:
    """Attributes and direct Property children, by lower-case name."""
    out = _attributes(e)
    for child in e:
        if _local(child.tag).lower() == "property":
            name = _attributes(child).get("name")
            if name:
                out.setdefault(name.lower(), (child.text or "").strip())
    return out


def _own(e: ET.Element):
    """Descendants that belong to no executable further down."""
    for child in e:
        if _local(child.tag) != "Executable":
            yield child
            yield from _own(child)


def parse_package(content: str, stem: str) -> tuple[str, list[tuple[str, str, list[str], list[str]]]]:
    """Package name and (task, type, SQL texts, connection strings) in document order."""
    root = ET.fromstring(content)
    top = _properties(root)
    tasks = []
    for e in root.iter():
        if _local(e.tag) != "Executable" or e is root and not any(_local(c.tag) == "ObjectData" for c in e):
            continue
        props = _properties(e)
        kind = (props.get("executabletype") or props.get("creationname") or "SSIS_EXECUTABLE").rsplit(".", 1)[-1]
        sql, links = [], []
        for x in _own(e):
            tag, attrs = _local(x.tag).lower(), _attributes(x)
            for text in (x.text if tag.endswith("sqlstatementsource") else None, attrs.get("sqlstatementsource"), x.text if tag == "property" and (attrs.get("name") or "").lower() == "sqlcommand" else None):
                if text and text.strip():
                    sql.append(text.strip())
            if attrs.get("connectionstring"):
                links.append(attrs["connectionstring"])
        tasks.append((props.get("objectname") or props.get("name") or "ssis_task", kind, sql, links))
    return top.get("packagename") or top.get("objectname") or stem, tasks


def read_packages(files: DataFrame) -> DataFrame:
    """file, package, ord, task, task_type, sql, connections, error for files (file, content); a bad file is one row."""
    names = [c.split()[0] for c in _OUT.split(", ")]
    types = [pa.string(), pa.string(), pa.int32(), pa.string(), pa.string(), pa.list_(pa.string()), pa.list_(pa.string()), pa.string()]

    def run(batches):
        for b in batches:
            rows = []
            for file, stem, content in zip(*(b[c].to_pylist() for c in ("file", "stem", "content")), strict=True):
                try:
                    package, tasks = parse_package(content or "", stem)
                    rows += [(file, package, i, *task, None) for i, task in enumerate(tasks)]
                except ET.ParseError as e:
                    rows.append((file, stem, None, None, None, [], [], str(e)))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*rows, strict=True)) or [[]] * len(names), types, strict=True)], names)

    return files.select("file", path_stem(F.col("file")).alias("stem"), "content").mapInArrow(run, _OUT)
