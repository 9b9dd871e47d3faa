"""Image files as one scanned page; size and resolution from their headers."""

from __future__ import annotations

import struct

# Fixed values.
DEFAULT_DPI = 150.0
INCH, CENTIMETRES = 0.0254, 2.54


def header(content: bytes) -> tuple[int | None, int | None, float | None]:
    """(width, height, dots per inch) of a PNG or JPEG; None for what the header doesn't say."""
    width = height = dpi = None
    if content.startswith(b"\x89PNG\r\n\x1a\n"):
        at = 8
        while at + 8 <= len(content):
            size, kind = struct.unpack(">I4s", content[at : at + 8])
            part = content[at + 8 : at + 8 + size]
            if kind == b"IHDR":
                width, height = struct.unpack(">II", part[:8])
            elif kind == b"pHYs":
                across, _, unit = struct.unpack(">IIB", part)
                dpi = round(across * INCH, 2) if unit == 1 else None
            elif kind in (b"IDAT", b"IEND"):
                break
            at += size + 12
    elif content.startswith(b"\xff\xd8"):
        at = 2
        while at + 4 <= len(content) and content[at] == 0xFF:
            kind, size = content[at + 1], struct.unpack(">H", content[at + 2 : at + 4])[0]
            part = content[at + 4 : at + 2 + size]
            if kind == 0xE0 and part.startswith(b"JFIF\0"):
                unit, across = part[7], struct.unpack(">H", part[8:10])[0]
                dpi = {1: float(across), 2: across * CENTIMETRES}.get(unit)
            elif 0xC0 <= kind <= 0xCF and kind not in (0xC4, 0xC8, 0xCC):
                height, width = struct.unpack(">HH", part[1:5])
                break
            at += 2 + size
    return width, height, dpi or None


class ImageReader:
    def pages(self, content: bytes, path: str) -> list[tuple[str, dict[str, str], bytes | None]]:
        width, height, dpi = header(content)
        told = {"dpi": dpi if dpi and dpi > 0 else DEFAULT_DPI, "width": width, "height": height}
        return [("", {k: str(v) for k, v in told.items() if v is not None}, content)]
