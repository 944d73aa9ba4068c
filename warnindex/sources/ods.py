"""S3: rows of OpenDocument spreadsheets (read in tasks by ``sources.decode``).

The standard library streams the XML of the first sheet.  Repeated cells and rows
(``number-columns-repeated`` / ``number-rows-repeated``) are expanded; a run
of empty cells costs nothing until a filled one follows.  Date cells give
their ISO value, numbers their value text, text cells their own paragraphs
(not those of a comment).
"""

from __future__ import annotations

import io
import zipfile
from xml.etree import ElementTree as ET

NS = {
    "office": "urn:oasis:names:tc:opendocument:xmlns:office:1.0",
    "table": "urn:oasis:names:tc:opendocument:xmlns:table:1.0",
    "text": "urn:oasis:names:tc:opendocument:xmlns:text:1.0",
}
_T = "{%s}" % NS["table"]
_O = "{%s}" % NS["office"]
_X = "{%s}" % NS["text"]


def _para_text(el) -> str:
    """Text of a paragraph: <text:s text:c="n"/> is n spaces, <text:tab/> a
    tab, <text:line-break/> a newline; spans are read through."""
    out = [el.text or ""]
    for ch in el:
        if ch.tag == _X + "s":
            out.append(" " * int(ch.get(_X + "c", "1")))
        elif ch.tag == _X + "tab":
            out.append("\t")
        elif ch.tag == _X + "line-break":
            out.append("\n")
        else:
            out.append(_para_text(ch))
        out.append(ch.tail or "")
    return "".join(out)


def _cell_value(cell) -> str | None:
    vt = cell.get(_O + "value-type")
    if vt == "date":
        return cell.get(_O + "date-value")
    if vt == "time":
        return cell.get(_O + "time-value")
    if vt in ("float", "percentage", "currency"):
        return cell.get(_O + "value")
    if vt == "boolean":
        return cell.get(_O + "boolean-value")
    parts = [_para_text(p) for p in cell if p.tag == _X + "p"]
    return "\n".join(parts) if parts else None


def iter_sheet_rows(source):
    """Rows (lists of str|None) of the first sheet of a file (bytes or an open
    binary file), repeats expanded, fully empty rows skipped.  A table inside a
    cell is not part of the sheet."""
    with zipfile.ZipFile(io.BytesIO(source) if isinstance(source, bytes) else source) as z, z.open("content.xml") as fh:
        depth, sheet = 0, None
        for event, el in ET.iterparse(fh, events=("start", "end")):
            if el.tag == _T + "table":
                depth += 1 if event == "start" else -1
                sheet = el if event == "start" and depth == 1 else sheet
                if depth == 0:
                    return  # first sheet done
                continue
            if event != "end" or el.tag != _T + "table-row" or depth != 1:
                continue
            row: list[str | None] = []
            empty = 0  # cells not written yet
            for cell in el:
                if cell.tag not in (_T + "table-cell", _T + "covered-table-cell"):
                    continue
                rep = int(cell.get(_T + "number-columns-repeated", "1"))
                v = _cell_value(cell)
                if v is None:
                    empty += rep
                else:
                    row.extend([None] * empty)
                    empty = 0
                    row.extend([v] * rep)
            rrep = int(el.get(_T + "number-rows-repeated", "1"))
            el.clear()
            if sheet is not None:
                sheet.clear()  # rows done are no longer its children
            if not row:
                continue
            for _ in range(rrep):
                yield row


# ---- writer (fixtures and exports) -------------------------------------------

_MANIFEST = """<?xml version="1.0" encoding="UTF-8"?>
<manifest:manifest xmlns:manifest="urn:oasis:names:tc:opendocument:xmlns:manifest:1.0" manifest:version="1.2">
 <manifest:file-entry manifest:full-path="/" manifest:media-type="application/vnd.oasis.opendocument.spreadsheet"/>
 <manifest:file-entry manifest:full-path="content.xml" manifest:media-type="text/xml"/>
</manifest:manifest>"""


def _esc(s: str) -> str:
    return s.replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;").replace('"', "&quot;")


def encode_ods(header: list[str], rows, date_columns=()) -> bytes:
    """A one-sheet spreadsheet; values in ``date_columns`` become date cells
    (ISO text), others string cells; equal neighbours are written as one
    repeated cell."""
    out = [
        '<?xml version="1.0" encoding="UTF-8"?>',
        f'<office:document-content xmlns:office="{NS["office"]}" xmlns:table="{NS["table"]}" '
        f'xmlns:text="{NS["text"]}" office:version="1.2"><office:body><office:spreadsheet>'
        '<table:table table:name="Sheet1">',
    ]

    def cells(values, kinds):
        i, parts = 0, []
        while i < len(values):
            j = i
            while j + 1 < len(values) and values[j + 1] == values[i] and kinds[j + 1] == kinds[i]:
                j += 1
            rep = f' table:number-columns-repeated="{j - i + 1}"' if j > i else ""
            v, k = values[i], kinds[i]
            if v is None:
                parts.append(f"<table:table-cell{rep}/>")
            elif k == "date":
                parts.append(f'<table:table-cell{rep} office:value-type="date" office:date-value="{_esc(v)}"/>')
            else:
                parts.append(f'<table:table-cell{rep} office:value-type="string"><text:p>{_esc(v)}</text:p></table:table-cell>')
            i = j + 1
        return "".join(parts)

    out.append("<table:table-row>" + cells(list(header), ["s"] * len(header)) + "</table:table-row>")
    kinds = ["date" if h in date_columns else "s" for h in header]
    for r in rows:
        out.append("<table:table-row>" + cells([None if v is None else str(v) for v in r], kinds) + "</table:table-row>")
    # trailing filler like real spreadsheets
    out.append('<table:table-row table:number-rows-repeated="1000"><table:table-cell table:number-columns-repeated="1024"/></table:table-row>')
    out.append("</table:table></office:spreadsheet></office:body></office:document-content>")
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr(zipfile.ZipInfo("mimetype"), "application/vnd.oasis.opendocument.spreadsheet")
        z.writestr("META-INF/manifest.xml", _MANIFEST)
        z.writestr("content.xml", "\n".join(out))
    return buf.getvalue()
