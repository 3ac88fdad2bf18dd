"""Features of a vector tile (protocol buffers) with the standard library alone."""

from __future__ import annotations

import gzip
import struct
from collections.abc import Iterator


def _varint(b: bytes, at: int) -> tuple[int, int]:
    n = shift = 0
    while True:
        c = b[at]
        n |= (c & 0x7F) << shift
        at += 1
        if c < 0x80:
            return n, at
        shift += 7


def _fields(b: bytes) -> Iterator[tuple[int, int | bytes]]:
    at = 0
    while at < len(b):
        key, at = _varint(b, at)
        kind = key & 7
        if kind == 0:
            v, at = _varint(b, at)
        elif kind == 2:
            n, at = _varint(b, at)
            v, at = b[at : at + n], at + n
        elif kind in (1, 5):
            n = 8 if kind == 1 else 4
            v, at = b[at : at + n], at + n
        else:
            raise ValueError("not a vector tile")
        yield key >> 3, v


def _value(b: bytes) -> str:
    for k, v in _fields(b):
        if k == 1:
            return v.decode("utf-8", "replace")
        if k == 2:
            return f"{struct.unpack('<f', v)[0]:g}"
        if k == 3:
            return f"{struct.unpack('<d', v)[0]:g}"
        if k in (4, 5):
            return str(v - (1 << 64) if v >= 1 << 63 else v)
        if k == 6:
            return str((v >> 1) ^ -(v & 1))
        if k == 7:
            return "sí" if v else "no"
    return ""


def features(raw: bytes) -> list[tuple[str, str | None, dict[str, str]]]:
    """(layer, id, properties) of each feature; nothing for bytes that are no tile."""
    if raw[:2] == b"\x1f\x8b":
        raw = gzip.decompress(raw)
    out = []
    try:
        for k, layer in _fields(raw):
            if k != 3:
                continue
            name, keys, values, found = "", [], [], []
            for f, v in _fields(layer):
                if f == 1:
                    name = v.decode("utf-8", "replace")
                elif f == 2:
                    found.append(v)
                elif f == 3:
                    keys.append(v.decode("utf-8", "replace"))
                elif f == 4:
                    values.append(_value(v))
            for b in found:
                fid, tags = None, []
                for f, v in _fields(b):
                    if f == 1:
                        fid = str(v)
                    elif f == 2:
                        at = 0
                        while at < len(v):
                            n, at = _varint(v, at)
                            tags.append(n)
                out.append((name, fid, {keys[a]: values[c] for a, c in zip(tags[::2], tags[1::2])}))
    except (IndexError, ValueError, struct.error, AttributeError, TypeError):
        return []
    return out


def tile_document(raw: bytes) -> tuple[str, dict[str, str]]:
    """The features of a tile as record lines under their layer; those that say the same once."""
    lines: list[str] = []
    layers: list[str] = []
    n = 0
    for layer, _, props in features(raw):
        n += 1
        if layer not in layers:
            layers.append(layer)
            lines.append(f"capa: {layer}")
        line = " | ".join(f"{k}: {v}" for k, v in props.items() if v.strip())
        if line and line not in lines:
            lines.append(line)
    return "\n".join(lines), {"capas": "; ".join(layers), "num_features": str(n)}
