"""The rules in plain Python, pixel by pixel, for small inputs."""

import struct
import zlib
from collections import defaultdict


def merge(rows):
    """rows of (gx, gy, bands, priority) -> {(gx, gy): (bands, priority)}, pixels with data only."""
    best = defaultdict(dict)
    for gx, gy, bands, priority in rows:
        for i, v in enumerate(bands):
            if v:
                best[gx, gy][i] = max(best[gx, gy].get(i, (float("-inf"), 0)), (priority, v))
    return {
        key: (tuple(tops[i][1] if i in tops else 0 for i in range(3)), max(p for p, _ in tops.values())) for key, tops in best.items()
    }


def halve(level):
    groups = defaultdict(list)
    for (gx, gy), pixel in level.items():
        groups[gx // 2, gy // 2].append(pixel)
    rows = []
    for (gx, gy), pixels in groups.items():
        bands = []
        for i in range(3):
            data = [p[0][i] for p in pixels if p[0][i]]
            bands.append((2 * sum(data) + len(data)) // (2 * len(data)) if data else 0)
        rows.append((gx, gy, tuple(bands), max(p[1] for p in pixels)))
    return rows


def pyramid(inputs, min_zoom=1):
    """{zoom: rows} -> {zoom: level}"""
    levels, carried = {}, []
    for zoom in range(max(inputs), min_zoom - 1, -1):
        levels[zoom] = merge(carried + inputs.get(zoom, []))
        carried = halve(levels[zoom])
    return levels


def read_png(data):
    """-> (width, height, {(x, y): (r, g, b, a)})"""
    assert data[:8] == b"\x89PNG\r\n\x1a\n"
    at, body, size = 8, b"", None
    while at < len(data):
        n, kind = struct.unpack(">I4s", data[at : at + 8])
        part = data[at + 8 : at + 8 + n]
        assert struct.unpack(">I", data[at + 8 + n : at + 12 + n])[0] == zlib.crc32(kind + part)
        if kind == b"IHDR":
            size = struct.unpack(">IIBBBBB", part)
            assert size[2:4] == (8, 6)
        if kind == b"IDAT":
            body += part
        at += 12 + n
    width, height = size[:2]
    raw = zlib.decompress(body)
    line = 1 + width * 4
    assert all(raw[y * line] == 0 for y in range(height))
    return width, height, {
        (x, y): tuple(raw[y * line + 1 + x * 4 : y * line + 5 + x * 4]) for y in range(height) for x in range(width)
    }
