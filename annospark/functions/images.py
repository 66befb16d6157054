"""What image payloads hold, told from their bytes: format, size, colour mode, and why they can't be read.

A whole decoder is the JVM's, for files (``operators.payloads.verified_files``). For payloads that lie in rows an
Arrow-batched helper walks the containers of the common formats and checks what these say about themselves:
checksums and the length of the packed pixels of PNG, segments and the end of JPEG, sizes of BMP and WebP.
"""

from __future__ import annotations

import struct
import zlib

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

SHAPE = "format string, width int, height int, mode string, reason string"
#: Colour types of PNG with their channels; components of JPEG; modes that count as colour or as one channel.
PNG_MODES = {0: ("L", 1), 2: ("RGB", 3), 3: ("P", 1), 4: ("LA", 2), 6: ("RGBA", 4)}
JPEG_MODES = {1: "L", 3: "RGB", 4: "CMYK"}
COLOUR, SINGLE = ["RGB", "RGBA", "CMYK", "YCBCR"], ["L", "P", "1"]


class _Unreadable(Exception):
    pass


def _png(data: bytes) -> tuple[int, int, str]:
    at, head, pixels, ended = 8, None, [], False
    while not ended:
        if at + 12 > len(data):
            raise _Unreadable("truncated")
        size, name = struct.unpack_from(">I4s", data, at)
        body, check = data[at + 8 : at + 8 + size], data[at + 8 + size : at + 12 + size]
        if len(check) < 4:
            raise _Unreadable("truncated")
        if zlib.crc32(name + body) != struct.unpack(">I", check)[0]:
            raise _Unreadable("bad_checksum")
        if name == b"IHDR":
            head = struct.unpack(">IIBBBBB", body)
        elif name == b"IDAT":
            pixels.append(body)
        ended, at = name == b"IEND", at + 12 + size
    if head is None or head[3] not in PNG_MODES:
        raise _Unreadable("bad_header")
    width, height, depth, colour, *_, interlaced = head
    mode, channels = PNG_MODES[colour]
    try:
        n = len(zlib.decompress(b"".join(pixels)))
    except zlib.error:
        raise _Unreadable("bad_pixels") from None
    if not interlaced and n < height * (1 + -(-width * channels * depth // 8)):
        raise _Unreadable("truncated")
    return width, height, "1" if (mode, depth) == ("L", 1) else mode


def _jpeg(data: bytes) -> tuple[int, int, str]:
    at, frame = 2, None
    while at + 4 <= len(data):
        if data[at] != 0xFF:
            raise _Unreadable("bad_segment")
        kind = data[at + 1]
        if kind == 0xFF:
            at += 1
            continue
        size = struct.unpack_from(">H", data, at + 2)[0]
        if 0xC0 <= kind <= 0xCF and kind not in (0xC4, 0xC8, 0xCC):
            if at + 10 > len(data):
                break
            height, width, n = struct.unpack_from(">HHB", data, at + 5)
            frame = width, height, JPEG_MODES.get(n, "other")
        if kind == 0xDA:
            if frame is None:
                raise _Unreadable("no_frame")
            if data.rfind(b"\xff\xd9") < at + 2 + size:
                raise _Unreadable("truncated")
            return frame
        at += 2 + size
    raise _Unreadable("truncated")


def _bmp(data: bytes) -> tuple[int, int, str]:
    if len(data) < 30:
        raise _Unreadable("truncated")
    begin, _, width, height, _, bits = struct.unpack_from("<IIiiHH", data, 10)
    if bits >= 24 and len(data) < begin + -(-width * bits // 32) * 4 * abs(height):
        raise _Unreadable("truncated")
    return width, abs(height), "RGBA" if bits == 32 else "RGB" if bits == 24 else "P"


def _webp(data: bytes) -> tuple[int, int, str]:
    if len(data) < 30 or len(data) < 8 + struct.unpack_from("<I", data, 4)[0]:
        raise _Unreadable("truncated")
    kind = data[12:16]
    if kind == b"VP8X":
        width, height = (1 + int.from_bytes(data[i : i + 3], "little") for i in (24, 27))
        return width, height, "RGBA" if data[20] & 0x10 else "RGB"
    if kind == b"VP8L":
        bits = struct.unpack_from("<I", data, 21)[0]
        return 1 + (bits & 0x3FFF), 1 + (bits >> 14 & 0x3FFF), "RGBA" if bits >> 28 & 1 else "RGB"
    if kind == b"VP8 ":
        width, height = struct.unpack_from("<HH", data, 26)
        return width & 0x3FFF, height & 0x3FFF, "RGB"
    raise _Unreadable("bad_header")


def _inspected(data: bytes | None) -> tuple:
    if not data:
        return None, None, None, None, "empty"
    for name, fits, walk in (
        ("png", data[:8] == b"\x89PNG\r\n\x1a\n", _png),
        ("jpeg", data[:2] == b"\xff\xd8", _jpeg),
        ("bmp", data[:2] == b"BM", _bmp),
        ("webp", data[:4] == b"RIFF" and data[8:12] == b"WEBP", _webp),
    ):
        if fits:
            try:
                width, height, mode = walk(data)
            except (_Unreadable, struct.error, IndexError) as e:
                return name, None, None, None, str(e) if isinstance(e, _Unreadable) else "truncated"
            return name, width, height, mode, None if width > 0 and height > 0 else "non_positive_dimensions"
    return None, None, None, None, "unknown_format"


def _batch(content: pd.Series) -> pd.DataFrame:
    rows = pd.DataFrame([_inspected(x) for x in content], columns=["format", "width", "height", "mode", "reason"], dtype=object)
    return rows.astype({"width": "Int32", "height": "Int32"})


def inspect(content: Column) -> Column:
    """A struct of ``SHAPE`` of a binary column; reason is null for a payload that can be read. Null counts as empty."""
    return pandas_udf(_batch, SHAPE)(content)


def mode_of_channels(mode: Column) -> Column:
    """The colour mode of an image that the image source decoded, from its number of type."""
    return F.when(mode == 0, "L").when(mode == 16, "RGB").when(mode == 24, "RGBA").when(mode >= 0, "other")
