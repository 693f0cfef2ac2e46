"""What a task does to one packed tile or one bounded group of them (numpy on Arrow batches).

A packed tile is ``zoom, col, row, bands`` with one binary of ``dim * dim`` bytes per band, rows
first. Its rank on top of others is either one ``priority`` or, where merged inputs share the tile, a
``palette`` of priorities and ``orders``: a binary of small numbers per pixel that point into the palette (one
byte each up to 256 priorities, two up to 65,536, else four), one shared by all bands or one per band.

In memory a tile is one 64-bit number per band and pixel, ``priority * 256 + value``, so that
merging is a plain maximum: any order, any grouping, the same result.
"""

import struct
import sys
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle

EMPTY = np.iinfo(np.int64).min
NOTHING = EMPTY >> 8  # the priority of a pixel nothing was drawn on
BATCH_TILES = 32
ASSEMBLED_BYTES = 1 << 22  # of tiles drawn at once; one tile may be larger

BANDS_TYPE = pa.list_(pa.binary())
MERGED = pa.schema(
    [
        ("zoom", pa.int32()),
        ("col", pa.int32()),
        ("row", pa.int32()),
        ("priority", pa.int64()),
        ("bands", BANDS_TYPE),
        ("palette", pa.list_(pa.int64())),
        ("orders", BANDS_TYPE),
    ]
)


def rows(batches):
    for batch in batches:
        yield from batch.to_pylist()


def in_batches(records, schema, size=BATCH_TILES):
    held = []
    for record in records:
        held.append(record)
        if len(held) == size:
            yield pa.RecordBatch.from_pylist(held, schema)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def joined(batches, least=10_000):
    """Small batches as fewer ones of at least so many rows, the last aside."""
    held, count = [], 0
    for batch in batches:
        held.append(batch)
        count += batch.num_rows
        if count >= least:
            yield pa.concat_batches(held)
            held, count = [], 0
    if held:
        yield pa.concat_batches(held)


def band_values(bands):
    return np.stack([np.frombuffer(b, np.uint8) for b in bands])


def packed(values):
    return [np.ascontiguousarray(v, dtype=np.uint8).tobytes() for v in values]


def ranked(tile):
    values = band_values(tile["bands"]).astype(np.int64)
    if tile["orders"] is None:
        if tile["priority"] is None and values.any():
            raise ValueError(f"the tile {key_of(tile)} has data but no priority")
        order = np.int64(tile["priority"] or 0)
    else:
        order = priorities(tile)
    return np.where(values != 0, (order << 8) | values, EMPTY)


def pointer_type(count):
    """The smallest number that points into so many priorities."""
    return np.uint8 if count <= 1 << 8 else np.uint16 if count <= 1 << 16 else np.uint32


def priorities(tile):
    """The priorities of a tile's pixels, a row for each of its orders."""
    palette = np.asarray(tile["palette"], np.int64)
    return np.stack([palette[np.frombuffer(o, pointer_type(len(palette)))] for o in tile["orders"]])


TABLE = 1 << 20  # priorities this close together are told apart by a table, others by sorting


def pointed(priority):
    """Priorities as a palette and pointers into it."""
    drawn = priority > NOTHING
    low, high = int(priority[drawn].min()), int(priority.max())
    if high - low < TABLE:
        seen = np.zeros(high - low + 2, bool)
        at = np.where(drawn, priority - (low - 1), 0)
        seen[at] = True
        palette = np.flatnonzero(seen) + (low - 1)
        if seen[0]:
            palette[0] = NOTHING
        pointers = (np.cumsum(seen) - 1)[at]
    else:
        palette, pointers = np.unique(priority, return_inverse=True)
    pointers = pointers.reshape(priority.shape).astype(pointer_type(len(palette)))
    return palette.tolist(), [p.tobytes() for p in pointers]


def key_of(tile):
    return tile["zoom"], tile["col"], tile["row"]


def merged_tile(key, canvas, per_band=False):
    """Packs a tile; where one input drew all of it, its priority stands for the whole tile."""
    priority = canvas >> 8
    if not per_band:
        priority = priority.max(axis=0, keepdims=True)
    drawn = priority[priority > NOTHING]
    one = drawn.size == 0 or drawn.min() == drawn.max()
    zoom, col, row = key
    palette, orders = (None, None) if one else pointed(priority)
    return {
        "zoom": zoom,
        "col": col,
        "row": row,
        "priority": int(drawn[0]) if one and drawn.size else None,
        "bands": packed(canvas & 255),
        "palette": palette,
        "orders": orders,
    }


def without_orders(tile):
    """A finished tile that nothing will be merged with."""
    return tile | {"priority": None, "palette": None, "orders": None}


def larger(a, b):
    """The maximum of two canvases; tiles of different band counts or sizes do not mix."""
    if a.shape != b.shape:
        raise ValueError(f"tiles of one key differ in bands or size: {a.shape} and {b.shape}")
    return np.maximum(a, b, out=a)


def merge_into(canvases, key, canvas):
    canvases[key] = larger(canvases[key], canvas) if key in canvases else canvas


def merge_quarter(canvases, key, quarter, dim):
    """Draws a halved tile, still under its own key, on its parent."""
    zoom, col, row = key
    parent = zoom - 1, col >> 1, row >> 1
    if parent not in canvases:
        canvases[parent] = np.full((quarter.shape[0], dim * dim), EMPTY)
    half = dim // 2
    top, left = (row & 1) * half, (col & 1) * half
    part = canvases[parent].reshape(-1, dim, dim)[:, top : top + half, left : left + half]
    larger(part, quarter.reshape(-1, half, half))


def halved(canvas, dim):
    """The quarter of its parent that a tile fills, ``dim / 2`` pixels wide."""
    half = dim // 2
    blocks = (canvas & 255).reshape(-1, half, 2, half, 2)
    total = blocks.sum(axis=(2, 4))
    count = (blocks != 0).sum(axis=(2, 4))
    mean = (2 * total + count) // np.maximum(2 * count, 1)
    order = (canvas >> 8).max(axis=0).reshape(half, 2, half, 2).max(axis=(1, 3))
    return np.where(mean != 0, (order << 8) | mean, EMPTY).reshape(canvas.shape[0], -1)


def merge_group(per_band):
    """Tiles of one key to one: with a priority per band if it will be merged again, else finished."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tiles = rows(batches)
        first, second = next(tiles), next(tiles, None)
        if second is None:
            out = {name: first[name] for name in MERGED.names}
            if first["orders"] is not None and not per_band:
                out = merged_tile(key_of(first), ranked(first))
        else:
            canvas = larger(ranked(first), ranked(second))
            for tile in tiles:
                larger(canvas, ranked(tile))
            out = merged_tile(key_of(first), canvas, per_band)
        yield pa.RecordBatch.from_pylist([out], MERGED)

    return run


def combine_each(held):
    """Merges tiles of one key that a task meets while it holds the ``held`` latest keys; others pass as they are."""

    def combined(batches):
        latest = {}  # key -> [tile as it came, canvas once a second one was met], the latest last
        for tile in rows(batches):
            key = key_of(tile)
            entry = latest.pop(key, None)
            if entry is None:
                entry = [tile, None]
            else:
                first = ranked(entry[0]) if entry[1] is None else entry[1]
                entry = [None, larger(first, ranked(tile))]
            latest[key] = entry
            if len(latest) > held:
                yield out(*pop_oldest(latest))
        for key, entry in latest.items():
            yield out(key, entry)

    def pop_oldest(latest):
        key = next(iter(latest))
        return key, latest.pop(key)

    def out(key, entry):
        tile, canvas = entry
        return {name: tile[name] for name in MERGED.names} if canvas is None else merged_tile(key, canvas, per_band=True)

    def run(batches):
        yield from in_batches(combined(batches), MERGED)

    return run


def fold_group(hi, lo, dim, orders=True, carry=False):
    """All tiles under one ancestor at ``lo``, and halved ones of the level below ``hi``: finishes every level from ``hi`` up.

    Without ``orders`` the finished tiles have none. With ``carry`` the tiles of level ``lo`` also come halved, their
    zoom negative, for the levels above.
    """

    def levels(batches):
        canvases = {}
        for tile in rows(batches):
            key = key_of(tile)
            if key[0] > hi:
                merge_quarter(canvases, key, ranked(tile), dim)
            elif key not in canvases or any_data(tile["bands"]):
                merge_into(canvases, key, ranked(tile))
        for zoom in range(hi, lo - 1, -1):
            for key in sorted(k for k in canvases if k[0] == zoom):
                canvas = canvases.pop(key)
                tile = merged_tile(key, canvas)
                yield tile if orders else without_orders(tile)
                if zoom > lo:
                    merge_quarter(canvases, key, halved(canvas, dim), dim)
                elif carry:
                    yield merged_tile((-zoom, key[1], key[2]), halved(canvas, dim))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from in_batches(levels(batches), MERGED)

    return run


def halve_each(dim):
    """Merged tiles to the quarters of their parents, under their own keys."""

    def run(batches):
        yield from in_batches((merged_tile(key_of(t), halved(ranked(t), dim)) for t in rows(batches)), MERGED)

    return run


def quarters_group(dim):
    """The up to four quarters of one parent to the parent."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        canvases = {}
        for tile in rows(batches):
            merge_quarter(canvases, key_of(tile), ranked(tile), dim)
        yield pa.RecordBatch.from_pylist([merged_tile(key, canvas) for key, canvas in canvases.items()], MERGED)

    return run


def split_each(across, schema):
    """Big tiles to ``across * across`` small ones, other columns copied."""
    deeper = int(across).bit_length() - 1

    def pieces(tile):
        values = band_values(tile["bands"])
        side = int(round(values.shape[1] ** 0.5)) // across
        cut = values.reshape(-1, across, side, across, side).transpose(1, 3, 0, 2, 4)
        for r in range(across):
            for c in range(across):
                yield {
                    **tile,
                    "zoom": tile["zoom"] + deeper,
                    "col": tile["col"] * across + c,
                    "row": tile["row"] * across + r,
                    "bands": packed(cut[r, c]),
                }

    def run(batches):
        yield from in_batches((p for t in rows(batches) for p in pieces(t)), schema)

    return run


def explode_each(dim, names, schema):
    """Packed tiles to one row per pixel that holds data."""

    def pixels(tiles):
        for tile in tiles:
            values = band_values(tile["bands"])
            at = np.flatnonzero(values.any(axis=0))
            n = len(at)
            if tile.get("orders") is not None:
                priority = priorities(tile)[0, at]
            else:
                priority = np.full(n, tile["priority"] or 0, np.int64)
            columns = {
                "priority": priority,
                "gx": int32(tile["col"] * dim + at % dim),
                "gy": int32(tile["row"] * dim + at // dim),
                **{name: values[i, at].astype(np.int32) for i, name in enumerate(names)},
            }
            yield with_copies(tile, columns, n, schema)

    def run(batches):
        yield from joined(pixels(rows(batches)))

    return run


def int32(values):
    if values.size and values.max() > np.iinfo(np.int32).max:
        raise OverflowError("pixels of this zoom have no place in 32 bits: keep them in tiles")
    return values.astype(np.int32)


def piece_pixels_each(names, schema):
    """Image pieces to one row per pixel that holds data."""

    def run(batches):
        for piece in rows(batches):
            values = band_values(piece["bands"])
            at = np.flatnonzero(values.any(axis=0))
            columns = {
                "x": (piece["x0"] + at % piece["width"]).astype(np.int32),
                "y": (piece["y0"] + at // piece["width"]).astype(np.int32),
                **{name: values[i, at].astype(np.int32) for i, name in enumerate(names)},
            }
            yield with_copies(piece, columns, len(at), schema)

    return run


def with_copies(record, columns, n, schema):
    """A batch of computed columns, the others repeated from the record."""
    arrays = [pa.array(columns[f.name], f.type) if f.name in columns else pa.array([record[f.name]] * n, f.type) for f in schema]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def assemble_runs(dim, names, keep, schema):
    """Pixels sorted by tile to packed tiles, many at a time; repeated pixels take the larger value."""
    cells = dim * dim
    most = max(1, ASSEMBLED_BYTES // (cells * len(names)))

    def out(keys, canvas):
        bands = pa.array([[band.tobytes() for band in tile] for tile in canvas], schema.field("bands").type)
        return pa.RecordBatch.from_arrays([*(keys.column(k) for k in keep), bands], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the last tile may go on in the next batch
        for batch in batches:
            if not batch.num_rows:
                continue
            new = np.zeros(batch.num_rows, bool)
            new[0] = True
            for key in keep:
                code = batch.column(key).dictionary_encode(null_encoding="encode").indices.to_numpy()
                new[1:] |= code[1:] != code[:-1]
            begin, tile = np.flatnonzero(new), np.cumsum(new) - 1
            at = batch["y"].to_numpy().astype(np.int64) * dim + batch["x"].to_numpy()
            values = [batch[name].to_numpy().astype(np.uint8) for name in names]
            for lo in range(0, len(begin), most):
                firsts = batch.select(keep).take(pa.array(begin[lo : lo + most]))
                count = firsts.num_rows
                part = slice(begin[lo], begin[lo + count] if lo + count < len(begin) else batch.num_rows)
                canvas = np.zeros((count, len(names), cells), np.uint8)
                for i, value in enumerate(values):
                    np.maximum.at(canvas.reshape(-1), ((tile[part] - lo) * len(names) + i) * cells + at[part], value[part])
                if held and held[0].equals(firsts.slice(0, 1)):
                    np.maximum(canvas[0], held[1][0], out=canvas[0])
                elif held:
                    yield out(*held)
                if count > 1:
                    yield out(firsts.slice(0, count - 1), canvas[:-1])
                held = firsts.slice(count - 1), canvas[-1:].copy()
        if held:
            yield out(*held)

    return run


def any_data(bands):
    return any(b.count(0) != len(b) for b in bands)


def sample_each(dim, world, schema):
    """Image pieces in metres to the non-empty tiles they fall on, nearest neighbour."""
    half = world / 2

    def pieces(piece):
        zoom, res, left, top = piece["zoom"], piece["res"], piece["left"], piece["top"]
        target = world / (2.0**zoom * dim)
        width, height = piece["width"], piece["height"]
        x0, y0 = piece.get("x0") or 0, piece.get("y0") or 0
        # cells are counted from the image's corner, so windows of one image never claim a pixel twice
        gx, sx = hits(left + half, x0, width, res, target, lambda g: (g + 0.5) * target - half - left)
        gy, sy = hits(half - top, y0, height, res, target, lambda g: top - (half - (g + 0.5) * target))
        inside = 2**zoom * dim
        gx, sx = gx[gx < inside], sx[gx < inside]
        gy, sy = gy[gy < inside], sy[gy < inside]
        source = band_values(piece["bands"]).reshape(-1, height, width)
        for row in np.unique(gy // dim):
            for col in np.unique(gx // dim):
                ys, xs = gy // dim == row, gx // dim == col
                tile = np.zeros((source.shape[0], dim, dim), np.uint8)
                tile[:, gy[ys][:, None] % dim, gx[xs][None, :] % dim] = source[:, sy[ys][:, None], sx[xs][None, :]]
                if tile.any():
                    yield {
                        **{k: piece[k] for k in schema.names if k in piece},
                        "zoom": zoom,
                        "col": int(col),
                        "row": int(row),
                        "bands": packed(tile.reshape(source.shape[0], -1)),
                    }

    def hits(corner, first, cells, res, target, offset):
        start = corner + first * res
        g = np.arange(max(int(start / target) - 1, 0), int((start + cells * res) / target) + 2)
        s = np.floor(offset(g) / res).astype(np.int64) - first
        ok = (s >= 0) & (s < cells)
        return g[ok], s[ok]

    def run(batches):
        yield from in_batches((p for t in rows(batches) for p in pieces(t)), schema, size=8)

    return run


def warp_each(radius, schema):
    """Blocks in degrees to blocks in metres, nearest neighbour, with an alpha band added.

    Target pixels of one block have their centre inside it, so blocks never overlap on the target.
    Blocks that are in metres already (no ``deg``) pass as they are.
    """

    def warp(block):
        if block["deg"] is None:
            yield block
            return
        deg, res, lon0, lat0 = block["deg"], block["res"], block["lon0"], block["lat0"]
        left, top = radius * np.radians(lon0), north(lat0)
        west, east = (radius * np.radians(lon0 + x * deg) for x in (block["x0"], block["x0"] + block["width"]))
        upper, lower = (north(lat0 - y * deg) for y in (block["y0"], block["y0"] + block["height"]))
        tx = np.arange(max(int((west - left) / res) - 1, 0), int((east - left) / res) + 2)
        ty = np.arange(max(int((top - upper) / res) - 1, 0), int((top - lower) / res) + 2)
        sx = np.floor((np.degrees((left + (tx + 0.5) * res) / radius) - lon0) / deg).astype(np.int64) - block["x0"]
        sy = np.floor((lat0 - latitude(top - (ty + 0.5) * res)) / deg).astype(np.int64) - block["y0"]
        xs, ys = (sx >= 0) & (sx < block["width"]), (sy >= 0) & (sy < block["height"])
        if xs.any() and ys.any():
            source = band_values(block["bands"]).reshape(-1, block["height"], block["width"])
            drawn = source[:, sy[ys][:, None], sx[xs][None, :]]
            with_alpha = np.concatenate([drawn, np.full((1, *drawn.shape[1:]), 255, np.uint8)])
            yield {
                **block,
                "x0": int(tx[xs][0]),
                "y0": int(ty[ys][0]),
                "width": int(xs.sum()),
                "height": int(ys.sum()),
                "bands": packed(with_alpha.reshape(len(with_alpha), -1)),
            }

    def north(lat):
        return radius * np.log(np.tan(np.pi / 4 + np.radians(lat) / 2))

    def latitude(y):
        return np.degrees(np.arctan(np.sinh(y / radius)))

    def run(batches):
        yield from in_batches(({k: b[k] for k in schema.names} for t in rows(batches) for b in warp(t)), schema, size=8)

    return run


def warp_fragments(radius, window, warped, schema):
    """Both steps on one trip through the worker."""
    warp, fragment = warp_each(radius, warped), fragment_each(window, schema)

    def run(batches):
        yield from fragment(warp(batches))

    return run


def fragment_each(window, schema):
    """Blocks of an image to the parts of each window they cover."""

    def parts(block):
        x0, y0, w, h = block["x0"], block["y0"], block["width"], block["height"]
        values = band_values(block["bands"]).reshape(-1, h, w)
        for r in range(y0 // window, (y0 + h - 1) // window + 1):
            for c in range(x0 // window, (x0 + w - 1) // window + 1):
                left, right = max(x0, c * window), min(x0 + w, (c + 1) * window)
                top, bottom = max(y0, r * window), min(y0 + h, (r + 1) * window)
                part = values[:, top - y0 : bottom - y0, left - x0 : right - x0]
                yield {
                    **{k: block[k] for k in schema.names if k in block},
                    "piece_col": c,
                    "piece_row": r,
                    "x0": left,
                    "y0": top,
                    "width": right - left,
                    "height": bottom - top,
                    "bands": packed(part.reshape(part.shape[0], -1)),
                }

    def run(batches):
        yield from in_batches((p for t in rows(batches) for p in parts(t)), schema, size=8)

    return run


def paste_runs(window, keep, schema):
    """Parts sorted by window, at most ``window * window`` pixels of each, to one piece a window."""

    def piece(first, canvas, right, bottom):
        return {
            **{k: first[k] for k in keep},
            "x0": first["piece_col"] * window,
            "y0": first["piece_row"] * window,
            "width": right,
            "height": bottom,
            "bands": packed(canvas[:, :bottom, :right].reshape(canvas.shape[0], -1)),
        }

    def pieces(parts):
        first = None
        for part in parts:
            values = band_values(part["bands"]).reshape(-1, part["height"], part["width"])
            if first is None or any(part[k] != first[k] for k in keep):
                if first is not None:
                    yield piece(first, canvas, right, bottom)
                first, right, bottom = part, 0, 0
                canvas = np.zeros((values.shape[0], window, window), np.uint8)
            x, y = part["x0"] % window, part["y0"] % window
            right, bottom = max(right, x + part["width"]), max(bottom, y + part["height"])
            canvas[:, y : y + part["height"], x : x + part["width"]] = values
        if first is not None:
            yield piece(first, canvas, right, bottom)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        few = (batch.slice(at, BATCH_TILES) for batch in batches for at in range(0, batch.num_rows, BATCH_TILES))
        yield from in_batches(pieces(rows(few)), schema, size=8)

    return run


def png_bytes(bands, dim):
    """8-bit RGBA; a pixel with all three colours 0 is transparent."""
    rgb = band_values(bands[:3]).reshape(3, dim, dim)
    alpha = np.where(rgb.any(axis=0), 255, 0).astype(np.uint8)
    lines = np.concatenate([rgb, alpha[None]]).transpose(1, 2, 0).reshape(dim, dim * 4)
    unfiltered = np.concatenate([np.zeros((dim, 1), np.uint8), lines], axis=1)

    def chunk(kind, body):
        return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))

    header = struct.pack(">IIBBBBB", dim, dim, 8, 6, 0, 0, 0)
    data = zlib.compress(unfiltered.tobytes())
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", header) + chunk(b"IDAT", data) + chunk(b"IEND", b"")


def encode_each(dim, skip_blank, schema):
    def run(batches):
        tiles = (t for t in rows(batches) if not skip_blank or any_data(t["bands"][:3]))
        yield from in_batches(
            ({"zoom": t["zoom"], "col": t["col"], "row": t["row"], "png": png_bytes(t["bands"], dim)} for t in tiles), schema
        )

    return run


# Executors get these functions with the task, so they need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
