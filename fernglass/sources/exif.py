"""What a camera wrote into a JPEG file's header: time, maker, model, place and size."""

from __future__ import annotations

import struct

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Tags of the Exif format, and the bytes of its number types.
DATE, MAKE, MODEL, EXIF_PART, GPS_PART, ORIGINAL, WIDTH, HEIGHT = 0x0132, 0x010F, 0x0110, 0x8769, 0x8825, 0x9003, 0xA002, 0xA003
LAT_REF, LAT, LON_REF, LON = 1, 2, 3, 4
SIZES = {1: 1, 2: 1, 3: 2, 4: 4, 5: 8, 7: 1, 9: 4, 10: 8}
#: Entries that a directory may claim to have.
MOST_ENTRIES = 512

FIELDS = T.StructType([T.StructField("taken", T.TimestampNTZType()), T.StructField("make", T.StringType()), T.StructField("model", T.StringType()), T.StructField("lat", T.DoubleType()), T.StructField("lon", T.DoubleType()), T.StructField("width", T.IntegerType()), T.StructField("height", T.IntegerType())])


def _directory(block: bytes, at: int, order: str) -> dict[int, object]:
    """The values of one directory of tags; what lies outside the block is left out."""
    found: dict[int, object] = {}
    if not 0 < at <= len(block) - 2:
        return found
    (n,) = struct.unpack_from(order + "H", block, at)
    for k in range(min(n, MOST_ENTRIES)):
        entry = at + 2 + 12 * k
        if entry + 12 > len(block):
            break
        tag, kind, count = struct.unpack_from(order + "HHI", block, entry)
        size = SIZES.get(kind, 0) * count
        if not size or size > len(block):
            continue
        start = entry + 8 if size <= 4 else struct.unpack_from(order + "I", block, entry + 8)[0]
        raw = block[start : start + size]
        if len(raw) < size:
            continue
        if kind == 2:
            found[tag] = raw.split(b"\0")[0].decode("utf-8", "replace").strip()
        elif kind in (3, 4):
            found[tag] = struct.unpack(order + ("H" if kind == 3 else "I") * count, raw)[0]
        elif kind == 5:
            pairs = struct.unpack(f"{order}{2 * count}I", raw)
            found[tag] = [a / b if b else None for a, b in zip(pairs[::2], pairs[1::2])]
    return found


def _degrees(parts: object, ref: object, negative: str) -> float | None:
    if not isinstance(parts, list) or len(parts) != 3 or None in parts:
        return None
    value = parts[0] + parts[1] / 60 + parts[2] / 3600
    return -value if isinstance(ref, str) and ref.upper().startswith(negative) else value


def read(content: bytes) -> tuple:
    """taken, make, model, lat, lon, width, height; None for what is missing or can't be read. Only segments before the picture are read."""
    block, width, height, at = b"", None, None, 2
    if content[:2] != b"\xff\xd8":
        return (None,) * 7
    while at + 4 <= len(content) and content[at] == 0xFF and content[at + 1] not in (0xD9, 0xDA):
        marker, size = content[at + 1], struct.unpack_from(">H", content, at + 2)[0]
        part = content[at + 4 : at + 2 + size]
        if marker == 0xE1 and part[:6] == b"Exif\0\0" and not block:
            block = part[6:]
        elif 0xC0 <= marker <= 0xCF and marker not in (0xC4, 0xC8, 0xCC) and len(part) >= 5:
            height, width = struct.unpack_from(">HH", part, 1)
        at += 2 + max(size, 2)
    order = {b"II": "<", b"MM": ">"}.get(block[:2])
    if order is None or len(block) < 8:
        return None, None, None, None, None, width, height
    top = _directory(block, struct.unpack_from(order + "I", block, 4)[0], order)
    own = _directory(block, top[EXIF_PART], order) if isinstance(top.get(EXIF_PART), int) else {}
    gps = _directory(block, top[GPS_PART], order) if isinstance(top.get(GPS_PART), int) else {}
    taken = pd.to_datetime(own.get(ORIGINAL) or top.get(DATE) or None, format="%Y:%m:%d %H:%M:%S", errors="coerce")
    lat, lon = _degrees(gps.get(LAT), gps.get(LAT_REF), "S"), _degrees(gps.get(LON), gps.get(LON_REF), "W")
    if lat is None or lon is None or (lat, lon) == (0.0, 0.0) or abs(lat) > 90 or abs(lon) > 180:
        lat = lon = None  # a camera without a fix writes zeros
    text = lambda tag: top.get(tag) if isinstance(top.get(tag), str) and top.get(tag) else None
    return None if taken is pd.NaT or taken is None else taken, text(MAKE), text(MODEL), lat, lon, width or own.get(WIDTH), height or own.get(HEIGHT)


@F.pandas_udf(FIELDS)
def exif(content: pd.Series) -> pd.DataFrame:
    """Struct of FIELDS of each file's first bytes; the head of a file is enough."""
    rows = pd.DataFrame([read(bytes(b) if b is not None else b"") for b in content], columns=FIELDS.names)
    return rows.astype({"width": "Int32", "height": "Int32", "lat": "float64", "lon": "float64"}).assign(taken=pd.to_datetime(rows["taken"]))


def write(taken: str, make: str, model: str, lat: float, lon: float, width: int, height: int, order: str = "<") -> bytes:
    """The head of a JPEG file that says this: for tests and examples."""

    def rational(value: float) -> bytes:
        d = int(value)
        m = int((value - d) * 60)
        return struct.pack(order + "6I", d, 1, m, 1, round(((value - d) * 60 - m) * 60 * 10_000), 10_000)

    def directory(entries: list[tuple[int, int, int, bytes]], at: int) -> bytes:
        head, data = struct.pack(order + "H", len(entries)), b""
        room = at + 2 + 12 * len(entries) + 4
        for tag, kind, count, raw in entries:
            head += struct.pack(order + "HHI", tag, kind, count)
            if len(raw) <= 4:
                head += raw.ljust(4, b"\0")
            else:
                head += struct.pack(order + "I", room + len(data))
                data += raw
        return head + struct.pack(order + "I", 0) + data

    words = lambda s: s.encode() + b"\0"
    long = lambda n: struct.pack(order + "I", n)
    gps = [(LAT_REF, 2, 2, b"S\0" if lat < 0 else b"N\0"), (LAT, 5, 3, rational(abs(lat))), (LON_REF, 2, 2, b"W\0" if lon < 0 else b"E\0"), (LON, 5, 3, rational(abs(lon)))]
    own = [(ORIGINAL, 2, len(taken) + 1, words(taken))]
    top = lambda a, b: directory([(MAKE, 2, len(words(make)), words(make)), (MODEL, 2, len(words(model)), words(model)), (EXIF_PART, 4, 1, long(a)), (GPS_PART, 4, 1, long(b))], 8)
    first = 8 + len(top(0, 0))
    second = first + len(directory(own, first))
    block = (b"II" if order == "<" else b"MM") + struct.pack(order + "HI", 42, 8) + top(first, second) + directory(own, first) + directory(gps, second)
    body = b"Exif\0\0" + block
    frame = b"\x08" + struct.pack(">HH", height, width) + b"\x01\x01\x11\x00"
    return b"\xff\xd8\xff\xe1" + struct.pack(">H", len(body) + 2) + body + b"\xff\xc0" + struct.pack(">H", len(frame) + 2) + frame + b"\xff\xda"
