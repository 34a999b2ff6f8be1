"""Report definitions in the shipped YAML form (S3, L3): the ``reports`` list of a definitions file as the reports table.

The subset that such files use: nested mappings and lists by indentation, plain and quoted scalars, ``|`` and ``>`` blocks (for
inline SQL), comments. Anything else (tabs as indentation, anchors, tags, flow collections, several documents) raises with its line.
Values stay text, also where YAML would read a number, a date or a boolean: definitions are text throughout.
"""

from __future__ import annotations

import json
import re
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from reportflow.sources.reports import Report, reports_frame

_KEY = re.compile(r"""(?P<key>"[^"]*"|'[^']*'|[^\s#:'"\[\]{},&*!|>%@`-][^:#]*?|-[^\s:][^:]*?)\s*:(?:\s+(?P<rest>.*))?$""")
_BLOCK = re.compile(r"(?P<kind>[|>])(?P<chomp>[+-]?)$")
_NULLS = ("", "~", "null", "Null", "NULL")


class DefinitionError(ValueError):
    def __init__(self, line: int, problem: str):
        super().__init__(f"line {line}: {problem}")


def _without_comment(text: str) -> str:
    """The text before a ``#`` that stands outside quotes at the start or after a space."""
    quote, k = None, 0
    while k < len(text):
        c = text[k]
        if quote:
            if c == "\\" and quote == '"' or c == quote == "'" and text[k + 1:k + 2] == "'":
                k += 1   # an escaped character
            elif c == quote:
                quote = None
        elif c in "'\"" and (k == 0 or text[k - 1] in " :-"):
            quote = c
        elif c == "#" and (k == 0 or text[k - 1].isspace()):
            return text[:k].rstrip()
        k += 1
    return text.rstrip()


def _scalar(text: str, line: int) -> str | None:
    if text[:1] == '"':
        try:
            return json.loads(text)
        except ValueError:
            raise DefinitionError(line, f"not a quoted text: {text}") from None
    if text[:1] == "'":
        if len(text) < 2 or text[-1] != "'" or re.search(r"(?<!')'(?:'')*(?!')", text[1:-1]):
            raise DefinitionError(line, f"not a quoted text: {text}")
        return text[1:-1].replace("''", "'")
    if text[:1] in tuple("[]{}&*!%@`|>"):
        raise DefinitionError(line, f"only plain and quoted texts are read, not {text!r}")
    return None if text in _NULLS else text


class _Lines:
    """The lines that hold something, as (number, indentation, text), and the raw ones for blocks."""

    def __init__(self, content: str):
        self.raw = content.split("\n")
        self.rows: list[tuple[int, int, str]] = []
        for number, raw in enumerate(self.raw, 1):
            body = raw.lstrip(" ")
            if body.strip() and not body.startswith("#"):
                self.rows.append((number, len(raw) - len(body), body.rstrip("\r")))
        self.at = 0

    def peek(self) -> tuple[int, int, str] | None:
        if self.at == len(self.rows):
            return None
        number, indent, body = self.rows[self.at]
        if body[:1] == "\t":
            raise DefinitionError(number, "a tab as indentation")
        return number, indent, _without_comment(body)

    def block(self, number: int, indent: int, kind: str, chomp: str) -> str:
        """The indented lines after line ``number``, as they are (``|``) or folded (``>``)."""
        lines, k = [], number
        while k < len(self.raw) and (not self.raw[k].strip() or len(self.raw[k]) - len(self.raw[k].lstrip(" ")) > indent):
            lines.append(self.raw[k].rstrip("\r"))
            k += 1
        while self.at < len(self.rows) and self.rows[self.at][0] <= k:
            self.at += 1
        inner = min((len(x) - len(x.lstrip(" ")) for x in lines if x.strip()), default=0)
        text = "\n".join(x[inner:] if x.strip() else "" for x in lines)
        if kind == ">":
            text = re.sub(r"(?<!\n)\n(?!\n)", " ", text.rstrip("\n"))
        return text.rstrip("\n") + ("" if chomp == "-" or not text.strip() else "\n")


def _value(lines: _Lines, number: int, indent: int, rest: str) -> Any:
    if (block := _BLOCK.match(rest)) is not None:
        return lines.block(number, indent, block["kind"], block["chomp"])
    if rest:
        return _scalar(rest, number)
    following = lines.peek()
    # A list may stand at its key's own indentation.
    if following and (following[1] > indent or following[1] == indent and following[2].startswith("- ")):
        return _node(lines, following[1])
    return None


def _node(lines: _Lines, indent: int) -> Any:
    number, _, text = lines.peek()
    return _list(lines, indent) if text == "-" or text.startswith("- ") else _mapping(lines, indent)


def _list(lines: _Lines, indent: int) -> list[Any]:
    out = []
    while (row := lines.peek()) is not None and row[1] == indent and (row[2] == "-" or row[2].startswith("- ")):
        number, _, text = row
        body = text[1:].lstrip(" ")
        if not body:
            lines.at += 1
            out.append(_value(lines, number, indent, ""))
        elif _KEY.match(body):
            # The item's mapping starts on the dash's line: go on as if the dash were a space.
            inner = indent + len(text) - len(body)
            lines.rows[lines.at] = (number, inner, lines.rows[lines.at][2][len(text) - len(body):])
            out.append(_mapping(lines, inner))
        else:
            lines.at += 1
            out.append(_scalar(body, number))
    _ended(lines, indent)
    return out


def _mapping(lines: _Lines, indent: int) -> dict[str, Any]:
    out: dict[str, Any] = {}
    while (row := lines.peek()) is not None and row[1] == indent and not row[2].startswith("- "):
        number, _, text = row
        m = _KEY.match(text)
        if m is None:
            raise DefinitionError(number, f"expected 'key: value', found {text!r}")
        key = _scalar(m["key"], number) or ""
        if key in out:
            raise DefinitionError(number, f"{key!r} is given twice")
        lines.at += 1
        out[key] = _value(lines, number, indent, m["rest"] or "")
    _ended(lines, indent)
    return out


def _ended(lines: _Lines, indent: int) -> None:
    row = lines.peek()
    if row is not None and row[1] > indent:
        raise DefinitionError(row[0], f"unexpected indentation of {row[2]!r}")


def parse_definitions(content: str) -> Any:
    """The file's content as dicts, lists, texts and None."""
    lines = _Lines(content.removeprefix("﻿"))
    row = lines.peek()
    if row is None:
        return None
    if row[2] == "---":
        lines.at += 1
        row = lines.peek()
        if row is None:
            return None
    out = _node(lines, row[1])
    if (left := lines.peek()) is not None:
        raise DefinitionError(left[0], f"unexpected {left[2]!r}")
    return out


# The fields of a definition.
REPORT_FIELDS = {"id", "name", "description", "dataSet", "sql", "sqlFile", "parameters", "groupBy", "dataValueMappings"}
GROUP_FIELDS = {"dataSet", "period", "orgUnit"}
MAPPING_FIELDS = {"name", "dataElement", "valueColumn", "categoryOptionCombo", "filter"}


def _checked(value: Any, fields: set[str], where: str) -> dict[str, Any]:
    if not isinstance(value, dict) or not set(value) <= fields:
        unknown = sorted(set(value) - fields) if isinstance(value, dict) else value
        raise ValueError(f"{where}: not a mapping with the fields {sorted(fields)}: {unknown}")
    return value


def parse_reports(content: str) -> list[Report]:
    """The reports of a definitions file; what is not a list of definitions raises, it never reads as no reports."""
    doc = parse_definitions(content)
    if not isinstance(doc, dict) or not isinstance(doc.get("reports"), list):
        raise ValueError("no list of reports in the definitions file")
    out = []
    for n, r in enumerate(doc["reports"], 1):
        where = f"report {n}"
        r = _checked(r, REPORT_FIELDS, where)
        if r.get("groupBy") is not None:
            _checked(r["groupBy"], GROUP_FIELDS, f"{where}, groupBy")
        for m in r.get("dataValueMappings") or []:
            _checked(m, MAPPING_FIELDS, f"{where}, mapping")
        out.append(Report.from_dict({"id": None, **r}))
    return out


def read_reports_yaml(spark: SparkSession, path: str) -> DataFrame:
    """The definitions file at ``path`` (any store that Spark reads) as the reports table, ``pos`` keeping the order.

    Files named by ``sqlFile`` are relative to the folder that a run gets as ``base_dir``, as usual.
    """
    files = spark.read.text(path, wholetext=True).collect()   # one configuration file
    if len(files) != 1:
        raise ValueError(f"{path} is {len(files)} files, not one definitions file")
    return reports_frame(spark, parse_reports(files[0][0]))
