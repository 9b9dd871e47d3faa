"""Word documents (.docx) as text pages, from their XML."""

from __future__ import annotations

import io
import zipfile
from xml.etree import ElementTree


def _tag(node) -> str:
    return node.tag.rpartition("}")[2]


def _attribute(node, name: str) -> str | None:
    return next((v for k, v in node.attrib.items() if k.rpartition("}")[2] == name), None)


def _texts(paragraph) -> list[str]:
    """The paragraph's text, cut at page breaks."""
    parts = [""]
    for node in paragraph.iter():
        kind = _tag(node)
        if kind == "t":
            parts[-1] += node.text or ""
        elif kind == "tab":
            parts[-1] += "\t"
        elif kind == "lastRenderedPageBreak" or kind == "br" and _attribute(node, "type") == "page":
            parts.append("")
        elif kind in ("br", "cr"):
            parts[-1] += "\n"
    return parts


def _table(node) -> str:
    rows = []
    for row in (r for r in node.iter() if _tag(r) == "tr"):
        cells = [" ".join(filter(None, (" ".join(_texts(p)).strip() for p in c.iter() if _tag(p) == "p"))) for c in row if _tag(c) == "tc"]
        rows.append(f"| {' | '.join(cells)} |")
        if len(rows) == 1:
            rows.append(f"| {' | '.join('---' for _ in cells)} |")
    return "\n".join(rows)


class DocxReader:
    """Pages are cut at page breaks, those written by hand and those that the last rendering left; tables become
    Markdown. The older .doc format is an error."""

    def pages(self, content: bytes, path: str) -> list[tuple[str, dict[str, str], bytes | None]]:
        if not content.startswith(b"PK"):
            raise ValueError("not a .docx document; the older .doc format can't be read")
        root = ElementTree.fromstring(zipfile.ZipFile(io.BytesIO(content)).read("word/document.xml"))
        body = next(n for n in root if _tag(n) == "body")
        pages: list[list[str]] = [[]]
        for node in body:
            if _tag(node) == "tbl":
                pages[-1].append(_table(node))
            elif _tag(node) == "p":
                first, *more = _texts(node)
                pages[-1].append(first)
                pages += [[part] for part in more]
        return [("\n".join(lines).strip("\n"), {"page_label": str(i + 1)}, None) for i, lines in enumerate(pages)]
