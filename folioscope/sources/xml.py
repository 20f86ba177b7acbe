"""Structured documents: sections, metadata and plain text of XML, with Arrow batches of the standard parser.

Mixed text needs document order, so the parser runs in Python; everything after it is native.
"""

from __future__ import annotations

import re
import xml.etree.ElementTree as ET
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema

from ..functions.text import BOILERPLATE

_DC = "{%s}" % "/".join(("http:", "", "purl.org", "dc", "elements", "1.1", ""))  # Dublin Core
PARSED = (
    "doc_key string, ok boolean, full_text string, hash_text string, bill_stage string, legis_num string, official_title string, congress_text string, dc_title string, date string, "
    "sections array<struct<enum: string, header: string, body_text: string, sub_texts: array<string>>>"
)


_TAG = re.compile("<[^>]+>")
_SPACES = re.compile(r"\s+")
_BEFORE_MARK = re.compile(r" (?=[.,;:)])")


def clean(text: str) -> str:
    """White space collapsed, none before ``. , ; : )``, none at the ends."""
    return _BEFORE_MARK.sub("", _SPACES.sub(" ", text)).strip()


def joined(node: ET.Element) -> str:
    """All text of an element in document order, pieces joined by a space."""
    out: list[str] = []
    stack: list[ET.Element | str] = [node]
    while stack:
        x = stack.pop()
        if isinstance(x, str):
            out.append(x)
            continue
        if x.text:
            out.append(x.text)
        for child in reversed(x):
            if child.tail:
                stack.append(child.tail)
            stack.append(child)
    return " ".join(out)


def hash_text(root: ET.Element) -> str:
    """Stripped texts in pre-order, each element's tail before its children; attributes do not count."""
    parts = (t.strip() for node in root.iter() for t in (node.text, node.tail) if t)
    return " ".join(t for t in parts if t)


def section_body(section: ET.Element) -> str:
    """The children's text without number and header, whose tails stay; the element's own leading text is not used."""
    out = []
    for child in section:
        if child.tag not in ("enum", "header"):
            out.append(joined(child))
        if child.tail:
            out.append(child.tail)
    return clean(" ".join(out))


def sections(root: ET.Element) -> list[dict]:
    """All sections at any depth, but for boilerplate and empty ones; subsections only where there are several."""
    out = []
    for node in root.iter("section"):
        number, title = node.find("enum"), node.find("header")
        header = clean(joined(title)) if title is not None else ""
        body = section_body(node)
        if header.lower() in BOILERPLATE or not body:
            continue
        subs = [clean(joined(s)) for s in node.iter("subsection")]
        enum = clean(number.text) if number is not None and number.text else ""
        several = [s for s in subs if s] if len(subs) > 1 else []
        out.append(dict(zip(("enum", "header", "body_text", "sub_texts"), (enum, header, body, several))))
    return out


def metadata(root: ET.Element) -> dict[str, str | None]:
    def text(path: str, whole: bool = False) -> str | None:
        node = root.find(path)
        if node is None:
            return None
        return clean(joined(node)) if whole else clean(node.text) if node.text else None

    return {
        "bill_stage": root.get("bill-stage", ""), "legis_num": text(".//form/legis-num"), "official_title": text(".//form/official-title", True),
        "congress_text": text(".//form/congress"), "dc_title": text(f".//{_DC}title"), "date": text(f".//{_DC}date"),
    }


def parse(content: bytes) -> dict:
    """Everything of one file; ok is false, and the rest empty, where the XML is malformed."""
    try:
        root = ET.fromstring(content)
    except ET.ParseError:
        stripped = _SPACES.sub(" ", _TAG.sub(" ", str(content, "utf-8", "replace"))).strip()
        return {"ok": False, "hash_text": stripped}
    return {"ok": True, "full_text": clean(joined(root)), "hash_text": hash_text(root), "sections": sections(root), **metadata(root)}


def parsed(df: DataFrame, key: str, content: str) -> DataFrame:
    """One row per document; malformed ones have ok = false and text for change detection only."""
    arrow = to_arrow_schema(df.sparkSession.createDataFrame([], PARSED).schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [{"doc_key": k, **parse(c or b"")} for k, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
            yield pa.RecordBatch.from_pylist(rows, schema=arrow)

    return df.selectExpr(f"cast({key} as string) doc_key", f"cast({content} as binary) content").mapInArrow(run, PARSED)
