"""DuckDB queries over the test tables, written from the rules, not from the Spark plans."""

from __future__ import annotations

T = 8  # tile size of the fixture

IMAGES = """
images AS (
  SELECT s_suppkey AS image_id, s_suppkey AS ord, (count(*) OVER ()) - 1 - s_suppkey AS priority,
         CAST(10 + s_nationkey % 3 AS INT) AS zoom,
         CAST((512 + s_suppkey % 16) * (CASE s_nationkey % 3 WHEN 0 THEN 1 WHEN 1 THEN 2 ELSE 4 END) AS INT) AS col_min,
         CAST((384 + (s_suppkey * 5) % 16) * (CASE s_nationkey % 3 WHEN 0 THEN 1 WHEN 1 THEN 2 ELSE 4 END) AS INT) AS row_min,
         CAST(1 + s_suppkey % 3 AS INT) AS ncols, CAST(1 + s_suppkey % 2 AS INT) AS nrows
  FROM supplier)"""

RECTS = """
rects AS (
  SELECT image_id, 'job-' || (image_id // 50) AS job_id, ord, priority, zoom, col_min, row_min,
         CAST(col_min + ncols - 1 AS INT) AS col_max, CAST(row_min + nrows - 1 AS INT) AS row_max,
         's3://imagery/scene-' || image_id || '.tif' AS source_uri, 's3://workspace/scene-' || image_id AS folder
  FROM images)"""

COVER = """
cover AS (
  SELECT image_id, zoom, col, row, folder || '/' || zoom || '/' || col || '/' || row || '.tif' AS path
  FROM (SELECT *, CAST(unnest(range(row_min, row_max + 1)) AS INT) AS row
        FROM (SELECT *, CAST(unnest(range(col_min, col_max + 1)) AS INT) AS col FROM rects)))"""

PIXELS = """
pixels AS MATERIALIZED (
  SELECT i.image_id, i.priority, i.zoom,
         CAST(i.col_min * 8 + l_partkey % (i.ncols * 8) AS INT) AS gx,
         CAST(i.row_min * 8 + l_orderkey % (i.nrows * 8) AS INT) AS gy,
         max(CAST((CAST(l_quantity AS INT) * 7) % 11 * 25 AS INT)) AS r,
         max(CAST((l_linenumber * 37 + l_partkey) % 256 AS INT)) AS g,
         max(CAST(l_orderkey % 5 * 50 AS INT)) AS b
  FROM lineitem JOIN images i ON l_suppkey = i.image_id GROUP BY 1, 2, 3, 4, 5)"""

LOCAL = """
local AS (
  SELECT p.*, i.col_min, i.row_min, i.ncols, i.nrows, p.gx - i.col_min * 8 AS sx, p.gy - i.row_min * 8 AS sy
  FROM pixels p JOIN images i USING (image_id))"""

CHUNK_PIXELS = """
chunk_pixels AS (SELECT *, gx // 8 AS col, gy // 8 AS row FROM pixels)"""


def top(band: str) -> str:
    return f"CAST(coalesce(arg_max({band}, priority) FILTER (WHERE {band} <> 0), 0) AS INT) AS {band}"


def merged(source: str) -> str:
    return f"""SELECT zoom, gx, gy, {top("r")}, {top("g")}, {top("b")},
      max(CASE WHEN r + g + b > 0 THEN priority END) AS priority FROM {source} GROUP BY zoom, gx, gy"""


def mean(band: str) -> str:
    total, count = f"sum({band}) FILTER (WHERE {band} <> 0)", f"count(*) FILTER (WHERE {band} <> 0)"
    return f"CAST(coalesce((2 * {total} + {count}) // nullif(2 * {count}, 0), 0) AS INT) AS {band}"


def halved(source: str) -> str:
    return f"""SELECT CAST(zoom - 1 AS INT) AS zoom, CAST(gx // 2 AS INT) AS gx, CAST(gy // 2 AS INT) AS gy,
      {mean("r")}, {mean("g")}, {mean("b")}, max(CASE WHEN r + g + b > 0 THEN priority END) AS priority
      FROM {source} GROUP BY 1, 2, 3"""


def levels(deepest: int = 12, top_zoom: int = 1) -> list[str]:
    """One CTE per zoom: inputs of that zoom together with the level below, halved; then merged."""
    columns = "zoom, gx, gy, r, g, b, priority"
    ctes = [f"level{deepest} AS MATERIALIZED ({merged(f'(SELECT {columns} FROM pixels WHERE zoom = {deepest})')})"]
    for z in range(deepest - 1, top_zoom - 1, -1):
        both = f"(SELECT {columns} FROM pixels WHERE zoom = {z} UNION ALL SELECT * FROM ({halved(f'level{z + 1}')}))"
        ctes.append(f"level{z} AS MATERIALIZED ({merged(both)})")
    return ctes


def with_(body: str, *ctes: str) -> str:
    return "WITH " + ", ".join(c.strip() for c in ctes) + "\n" + body


RASTER = (IMAGES, PIXELS)
GRID = (IMAGES, RECTS, COVER)
HAS_DATA = "r + g + b > 0"


def lon(c: str, z: str) -> str:
    return f"({c} / pow(2.0, {z}) * 360.0 - 180.0)"


def lat(r: str, z: str) -> str:
    return f"degrees(atan(sinh(pi() * (1 - 2 * {r} / pow(2.0, {z})))))"


def merc_x(v: str) -> str:
    return f"(6378137.0 * radians({v}))"


def merc_y(v: str) -> str:
    return f"(6378137.0 * ln(tan(pi() / 4 + radians({v}) / 2)))"


def inv_x(v: str) -> str:
    return f"degrees(({v}) / 6378137.0)"


def inv_y(v: str) -> str:
    return f"degrees(atan(sinh(({v}) / 6378137.0)))"


def at_col(v: str, z: str) -> str:
    return f"CAST(floor(({v} + 180.0) / 360.0 * pow(2.0, {z})) AS INT)"


def at_row(v: str, z: str) -> str:
    return f"CAST(floor((1 - ln(tan(radians({v})) + 1 / cos(radians({v}))) / pi()) / 2 * pow(2.0, {z})) AS INT)"


def zoom_of(res: str, dim: int) -> str:
    exact = f"(ln(2 * pi() * 6378137 / ({res} * {dim})) / ln(2))"
    return f"CAST(CASE WHEN {exact} - trunc({exact}) > 0.20 THEN trunc({exact}) + 1 ELSE trunc({exact}) END AS INT)"


POINTS = """
points AS (SELECT event_id, (event_id * 7919 % 36000) / 100.0 - 180.0 AS lon, (event_id * 104729 % 17000) / 100.0 - 85.0 AS lat
           FROM events)"""

RES = """
resolutions AS (SELECT p_partkey, p_retailprice / 1000.0 AS res FROM part)"""

BYTES = """
bytes AS (SELECT vec_id, unnest(range(64)) AS pos,
          CAST(floor((CAST(unnest(embedding) AS DOUBLE) + 1.0) * 127.5) AS INT) AS value FROM embeddings)"""

PATHS = """
paths AS (
  SELECT image_id, zoom AS image_zoom, path FROM cover
  UNION ALL
  SELECT DISTINCT image_id, r.zoom, folder || '/' || (r.zoom - 1) || '/' || (c.col // 2) || '/' || (c.row // 2) || '.tif'
  FROM cover c JOIN rects r USING (image_id)
  UNION ALL SELECT image_id, zoom, folder || '/' FROM rects)"""


def indexed(where: str) -> str:
    pattern = r".*/(\d+)/(\d+)/(\d+)\.\w+$"
    part = lambda i: f"CAST(regexp_extract(path, '{pattern}', {i}) AS INT)"
    return f"""SELECT image_id, {part(1)} AS zoom, {part(2)} AS col, {part(3)} AS row, path FROM paths
      WHERE regexp_matches(path, '{pattern}') AND CAST(nullif(regexp_extract(path, '{pattern}', 1), '') AS INT) = {where}"""


NAME = r"""
names AS (
  SELECT page_id,
    regexp_replace(regexp_extract(url, '^[a-z]+://([^/?#]*)', 1) || '/' ||
                   substr(regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1), 2),
                   '(^|/)(\.*[^/.][^/]*)\.[^/.]*$', '\1\2') AS name
  FROM pages)"""

EXTENT = f"""round({lon("col_min", "zoom")}, 6) AS xmin, round({lat("(row_max + 1)", "zoom")}, 6) AS ymin,
  round({lon("(col_max + 1)", "zoom")}, 6) AS xmax, round({lat("row_min", "zoom")}, 6) AS ymax"""

# Nearest neighbour from the target's side: every target pixel near an image looks its source pixel up.
METRIC = """
metric AS (
  SELECT *, 2 * pi() * 6378137 / (pow(2.0, zoom) * 8) AS target, 2 * pi() * 6378137 / 2 AS half,
         2 * pi() * 6378137 / (pow(2.0, zoom) * 8) * 1.25 AS res,
         (col_min * 8 + 0.3) * (2 * pi() * 6378137 / (pow(2.0, zoom) * 8)) - 2 * pi() * 6378137 / 2 AS lft,
         2 * pi() * 6378137 / 2 - (row_min * 8 + 0.3) * (2 * pi() * 6378137 / (pow(2.0, zoom) * 8)) AS top
  FROM images),
targets AS (
  SELECT *, unnest(range(row_min * 8 - 2, row_min * 8 + nrows * 10 + 4)) AS gy
  FROM (SELECT *, unnest(range(col_min * 8 - 2, col_min * 8 + ncols * 10 + 4)) AS gx FROM metric)),
looked AS (
  SELECT image_id, zoom, gx, gy, floor(((gx + 0.5) * target - half - lft) / res) AS sx,
         floor((top - (half - (gy + 0.5) * target)) / res) AS sy FROM targets)"""

SAMPLED = """SELECT k.image_id, k.zoom, CAST(k.gx AS INT) AS gx, CAST(k.gy AS INT) AS gy, r, g, b
  FROM looked k JOIN local l ON k.image_id = l.image_id AND k.sx = l.sx AND k.sy = l.sy"""

DEGREES = f"""
placed AS (
  SELECT *, {lon("col_min", "zoom")} AS lon0, {lat("row_min", "zoom")} AS lat0,
         360.0 / pow(2.0, zoom) / 8 * 1.1 AS deg, 2 * pi() * 6378137 / (pow(2.0, zoom) * 8) AS res FROM images),
warp_targets AS (
  SELECT *, unnest(range(0, nrows * 13 + 4)) AS ty FROM (SELECT *, unnest(range(0, ncols * 10 + 4)) AS tx FROM placed)),
warped AS (
  SELECT image_id, tx, ty, floor(({inv_x(merc_x("lon0") + " + (tx + 0.5) * res")} - lon0) / deg) AS sx,
         floor((lat0 - {inv_y(merc_y("lat0") + " - (ty + 0.5) * res")}) / deg) AS sy FROM warp_targets)"""

WARPED = """SELECT k.image_id, CAST(tx AS INT) AS tx, CAST(ty AS INT) AS ty, r, g, b, 255 AS alpha
  FROM warped k JOIN local l ON k.image_id = l.image_id AND k.sx = l.sx AND k.sy = l.sy"""

LOWERED = """
lowered AS (
  SELECT CAST(z AS INT) AS zoom, col_min // d AS c0, row_min // d AS r0, col_max // d AS c1, row_max // d AS r1
  FROM (SELECT *, CAST(pow(2, zoom - z) AS BIGINT) AS d FROM (SELECT *, unnest(range(2, zoom + 1)) AS z FROM rects)))"""

SCALE = "CAST(pow(2, abs(image_id % 5 - 2)) AS BIGINT)"

ORACLE: dict[str, str] = {
    "request_images": with_(
        """SELECT job_id, 's3://tiles/' || job_id AS target, 's3://workspace/' || job_id AS workspace,
           CAST(image_id % 50 AS INT) AS ord, source_uri FROM rects""",
        IMAGES,
        RECTS,
    ),
    "manifest_inputs": with_(
        f"""SELECT 'job' AS job_id, 's3://tiles/out' AS target, 8 AS tile_size, ord AS position, priority, source_uri, zoom,
            col_min, row_min, col_max, row_max, {EXTENT}, folder AS tiles FROM rects""",
        IMAGES,
        RECTS,
    ),
    "manifest_json": with_(
        """SELECT job_id, row_number() OVER (PARTITION BY job_id ORDER BY ord) - 1 AS position, count(*) OVER (PARTITION BY job_id) AS total,
           source_uri, zoom, folder AS tiles FROM rects""",
        IMAGES,
        RECTS,
    ),
    "tile_index": with_(indexed("11"), *GRID, PATHS),
    "zoom_filter": with_(indexed("image_zoom"), *GRID, PATHS),
    "no_directories": with_("SELECT image_id, image_zoom, path FROM paths WHERE path NOT LIKE '%/'", *GRID, PATHS),
    "tile_scan": with_(f"SELECT image_id, zoom, priority, gx, gy, r, g, b FROM pixels WHERE zoom = 11 AND {HAS_DATA}", *RASTER),
    "region_scan": with_(
        f"""SELECT image_id, zoom, priority, gx, gy, r, g, b FROM pixels
            WHERE zoom = 11 AND gx // {T} BETWEEN 1024 AND 1040 AND gy // {T} BETWEEN 768 AND 799 AND {HAS_DATA}""",
        *RASTER,
    ),
    "natural_zoom": with_(f"SELECT p_partkey, {zoom_of('res', 1024)} AS zoom FROM resolutions", RES),
    "pixel_resolution": with_(
        "SELECT p_partkey, round(CASE WHEN p_partkey % 2 = 0 THEN res * 1.5 ELSE res END, 6) AS resolution FROM resolutions", RES
    ),
    "lonlat_to_tile": with_(f"SELECT event_id, {at_col('lon', '12')} AS col, {at_row('lat', '12')} AS row FROM points", POINTS),
    "tile_upper_left": with_(
        f"SELECT image_id, round({lon('col_min', 'zoom')}, 6) AS lon, round({lat('row_min', 'zoom')}, 6) AS lat FROM images", IMAGES
    ),
    "tile_extent": with_(
        f"""SELECT image_id, round({lon("col_min", "zoom")}, 6) AS xmin, round({lat("(row_min + 1)", "zoom")}, 6) AS ymin,
            round({lon("(col_min + 1)", "zoom")}, 6) AS xmax, round({lat("row_min", "zoom")}, 6) AS ymax FROM images""",
        IMAGES,
    ),
    "lonlat_to_mercator": with_(f"SELECT event_id, round({merc_x('lon')}, 3) AS x, round({merc_y('lat')}, 3) AS y FROM points", POINTS),
    "tile_affine": with_(
        f"""SELECT image_id, round(({merc_x(lon("(col_min + 1)", "zoom"))} - {merc_x(lon("col_min", "zoom"))}) / 256, 4) AS a,
            0.0::DOUBLE AS b, round({merc_x(lon("col_min", "zoom"))}, 4) AS c, 0.0::DOUBLE AS d,
            round(({merc_y(lat("(row_min + 1)", "zoom"))} - {merc_y(lat("row_min", "zoom"))}) / 256, 4) AS e,
            round({merc_y(lat("row_min", "zoom"))}, 4) AS f FROM images""",
        IMAGES,
    ),
    "image_grid_bounds": with_(
        f"""SELECT event_id, {at_col("lon", "10")} AS col_min, {at_row("lat", "10")} AS row_min,
            {at_col("(lon + 0.5)", "10")} AS col_max, {at_row("(lat - 0.5)", "10")} AS row_max FROM points""",
        POINTS,
    ),
    "parent_key": with_("SELECT image_id, col, row, CAST(col // 2 AS INT) AS parent_col, CAST(row // 2 AS INT) AS parent_row FROM cover", *GRID),
    "morton_key": with_(
        """SELECT image_id, CAST(col AS INT) AS col, CAST(row AS INT) AS row,
                  CAST(list_sum(list_transform(range(31), lambda i: ((col >> i) & 1) * (CAST(1 AS BIGINT) << (2 * i)) + ((row >> i) & 1) * (CAST(1 AS BIGINT) << (2 * i + 1)))) AS BIGINT) AS key
           FROM (SELECT image_id, CAST(col AS BIGINT) AS col, CAST(row AS BIGINT) AS row FROM cover)""",
        *GRID,
    ),
    "child_quadrant": with_("SELECT image_id, col, row, CAST(col % 2 AS INT) AS right, CAST(row % 2 AS INT) AS lower FROM cover", *GRID),
    "zoom_offset": with_(
        """SELECT image_id, CAST(256 * (CASE image_id % 4 WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 4 ELSE 8 END) AS INT) AS tile_size,
           CAST(image_id % 4 AS INT) AS "offset" FROM images""",
        IMAGES,
    ),
    "scaled_grid_bounds": with_(
        f"""SELECT image_id, CAST(image_id % 5 - 2 AS INT) AS levels,
            CAST(CASE WHEN image_id % 5 >= 2 THEN col_min * {SCALE} ELSE col_min // {SCALE} END AS INT) AS col_min,
            CAST(CASE WHEN image_id % 5 >= 2 THEN row_min * {SCALE} ELSE row_min // {SCALE} END AS INT) AS row_min,
            CAST(CASE WHEN image_id % 5 >= 2 THEN (col_max + 1) * {SCALE} - 1 ELSE col_max // {SCALE} END AS INT) AS col_max,
            CAST(CASE WHEN image_id % 5 >= 2 THEN (row_max + 1) * {SCALE} - 1 ELSE row_max // {SCALE} END AS INT) AS row_max
            FROM rects""",
        IMAGES,
        RECTS,
    ),
    "byte_normalize": with_("SELECT image_id, gx, gy, CAST(CASE WHEN (gx + gy) % 7 = 0 THEN 128 ELSE r END AS INT) AS value FROM pixels", *RASTER),
    "rgba_pack": with_(
        f"""SELECT zoom, gx, gy, CASE WHEN r = 0 AND g = 0 AND b = 0 THEN 0::BIGINT
            ELSE r::BIGINT * 16777216 + g::BIGINT * 65536 + b::BIGINT * 256 + 255 END AS rgba FROM ({merged("pixels")})""",
        *RASTER,
    ),
    "tile_path": with_("SELECT image_id, 'out/' || zoom || '/' || col || '/' || row || '.png' AS path FROM cover", *GRID),
    "uri_parts": with_(
        r"""SELECT page_id, name, regexp_extract(name, '([^/]*)$', 1) AS base,
            name || '/' || regexp_extract(name, '([^/]*)$', 1) || '_' || (page_id % 3) || '_' || (page_id % 5) AS piece FROM names""",
        NAME,
    ),
    "remote_read_path": r"""SELECT page_id, CASE page_id % 3
          WHEN 0 THEN '/vsicurl/http://' || regexp_extract(url, '^https?://([^/?#]*)', 1) || '.s3.amazonaws.com'
                      || regexp_extract(url, '^https?://[^/?#]*([^?#]*)', 1)
          WHEN 1 THEN '/data/' || regexp_replace(url, '^https?://', '')
          ELSE '/vsicurl/' || url END AS path FROM pages""",
    "grid_size": with_("SELECT image_id, ncols::BIGINT * nrows AS tiles FROM images", IMAGES),
    "nonempty_chunks": with_(
        "SELECT image_id, zoom, CAST(col AS INT) AS col, CAST(row AS INT) AS row FROM chunk_pixels GROUP BY ALL HAVING max(greatest(r, g, b)) > 0",
        *RASTER,
        CHUNK_PIXELS,
    ),
    "world_clip": with_(
        """SELECT image_id, e AS col_min, e AS row_min, CAST(least(e + ncols - 1, pow(2, zoom) - 1) AS INT) AS col_max,
           CAST(least(e + nrows - 1, pow(2, zoom) - 1) AS INT) AS row_max
           FROM (SELECT *, CAST(pow(2, zoom) - 1 - image_id % 3 AS INT) AS e FROM images)""",
        IMAGES,
    ),
    "extent_intersects": with_(
        """SELECT c.image_id, c.col, c.row,
           c.col <= (r.col_min // 2) * 2 + 2 AND c.col + 1 >= (r.col_min // 2) * 2
           AND c.row <= (r.row_min // 2) * 2 + 2 AND c.row + 1 >= (r.row_min // 2) * 2 AS touches
           FROM cover c JOIN rects r USING (image_id)""",
        *GRID,
    ),
    "valid_sources": with_(
        f"SELECT image_id, source_uri FROM rects WHERE EXISTS (SELECT 1 FROM pixels p WHERE p.image_id = rects.image_id AND {HAS_DATA})",
        *RASTER,
        RECTS,
    ),
    "chunk_sample": with_(SAMPLED, *RASTER, LOCAL, METRIC),
    "chunk_sample_tiles": with_(SAMPLED + f" WHERE {HAS_DATA}", *RASTER, LOCAL, METRIC),
    "reproject_image": with_(WARPED, *RASTER, LOCAL, DEGREES),
    "reproject_tiles": with_(WARPED + f" WHERE {HAS_DATA}", *RASTER, LOCAL, DEGREES),
    "describe_image": with_(
        f"""SELECT event_id, round(w, 6) AS xmin, round(s, 6) AS ymin, round(e, 6) AS xmax, round(n, 6) AS ymax, round(res, 6) AS resolution,
            zoom, {at_col("w", "zoom")} AS col_min, {at_row("n", "zoom")} AS row_min,
            {at_col("e", "zoom")} AS col_max, {at_row("s", "zoom")} AS row_max
            FROM (SELECT *, {zoom_of("greatest((rgt - lft) / width, (top - btm) / height)", 1024)} AS zoom,
                  {inv_x("lft")} AS w, {inv_y("btm")} AS s, {inv_x("rgt")} AS e, {inv_y("top")} AS n
            FROM (SELECT *, lft + width * res AS rgt, top - height * res AS btm
            FROM (SELECT event_id, {merc_x("lon")} AS lft, {merc_y("lat")} AS top, 1000 + event_id % 1000 AS width,
                  800 + event_id % 900 AS height, 0.5 + event_id % 400 / 4.0 AS res FROM points)))""",
        POINTS,
    ),
    "tile_cover": with_(
        f"""SELECT image_id, zoom, col, row, path, round({merc_x(lon("col", "zoom"))}, 3) AS "left",
            round({merc_y(lat("row", "zoom"))}, 3) AS top FROM cover""",
        *GRID,
    ),
    "retile": with_(
        """SELECT image_id, CAST(sx // 10 AS INT) AS piece_col, CAST(sy // 10 AS INT) AS piece_row, CAST(sx % 10 AS INT) AS x,
           CAST(sy % 10 AS INT) AS y, r, g, b,
           'imagery/scene-' || image_id || '/scene-' || image_id || '_' || (sy // 10) || '_' || (sx // 10) AS piece FROM local""",
        *RASTER,
        LOCAL,
    ),
    "retile_tiles": with_(
        f"""SELECT image_id, CAST(sx // 10 AS INT) AS piece_col, CAST(sy // 10 AS INT) AS piece_row, CAST(sx AS INT) AS x,
            CAST(sy AS INT) AS y, r, g, b FROM local WHERE {HAS_DATA}""",
        *RASTER,
        LOCAL,
    ),
    "tile_explode": with_(
        """SELECT vec_id AS image_id, CAST(vec_id % 4096 * 8 + pos % 8 AS INT) AS gx, CAST(vec_id // 4096 * 8 + pos // 8 AS INT) AS gy,
           value FROM bytes WHERE value <> 0""",
        BYTES,
    ),
    "tile_assemble": with_(
        """SELECT vec_id AS image_id, CAST(vec_id % 4096 AS INT) AS col, CAST(vec_id // 4096 AS INT) AS row,
           string_agg(lower(printf('%02x', value)), '' ORDER BY pos) AS bytes FROM bytes GROUP BY vec_id""",
        BYTES,
    ),
    "mosaic_merge": with_(merged("pixels"), *RASTER),
    "mosaic_merge_tiles": with_(f"SELECT * FROM ({merged('pixels')}) WHERE {HAS_DATA}", *RASTER),
    "zoom_up": with_(halved(f"({merged('pixels')})"), *RASTER),
    "zoom_up_tiles": with_(f"SELECT * FROM ({halved(f'({merged("pixels")})')}) WHERE {HAS_DATA}", *RASTER),
    "order_down": with_(f"SELECT zoom, gx, gy, priority FROM ({halved(f'({merged("pixels")})')})", *RASTER),
    "pyramid": with_(" UNION ALL ".join(f"SELECT * FROM level{z}" for z in range(12, 0, -1)), *RASTER, *levels()),
    "pyramid_tiles": with_(
        " UNION ALL ".join(f"SELECT * FROM level{z} WHERE {HAS_DATA}" for z in range(12, 0, -1)), *RASTER, *levels()
    ),
    "tile_counts_unmerged": with_(
        "SELECT zoom, CAST(sum((c1 - c0 + 1) * (r1 - r0 + 1)) AS BIGINT) AS tiles FROM lowered GROUP BY zoom", IMAGES, RECTS, LOWERED
    ),
    "tile_counts_merged": with_(
        """SELECT zoom, count(*) AS tiles FROM (SELECT DISTINCT zoom, c, unnest(range(r0, r1 + 1)) AS r
           FROM (SELECT *, unnest(range(c0, c1 + 1)) AS c FROM lowered)) GROUP BY zoom""",
        IMAGES,
        RECTS,
        LOWERED,
    ),
    "chunk_stats": with_("SELECT image_id, count(*) AS chunks FROM cover GROUP BY image_id", *GRID),
    "collect_image_sources": with_(
        "SELECT image_id, source_uri, CAST(col_max - col_min + 1 AS BIGINT) AS pieces, col_min, row_min, col_max, row_max FROM rects",
        IMAGES,
        RECTS,
    ),
    "group_by_zoom": with_(
        "SELECT zoom, count(*) AS inputs, CAST(sum(ncols * nrows) AS BIGINT) AS tiles FROM images GROUP BY zoom", IMAGES
    ),
    "distinct_sources": with_("SELECT DISTINCT 's3://imagery/scene-' || image_id || '.tif' AS source_uri FROM pixels", *RASTER),
    "max_zoom": with_("SELECT max(zoom) AS zoom FROM images", IMAGES),
    "zoom_plan": with_(
        "SELECT zoom AS z1, lead(zoom, 1, 1) OVER (ORDER BY zoom DESC) AS z2 FROM (SELECT DISTINCT zoom FROM images)", IMAGES
    ),
    "order_inputs": with_("SELECT job_id, ord, source_uri FROM rects ORDER BY job_id, ord", IMAGES, RECTS),
    "priority_rank": with_(
        """SELECT job_id, ord, row_number() OVER (PARTITION BY job_id ORDER BY ord) - 1 AS position,
           row_number() OVER (PARTITION BY job_id ORDER BY ord DESC) - 1 AS priority FROM rects""",
        IMAGES,
        RECTS,
    ),
    "carried_rank": with_(
        """SELECT image_id, col, row, (row % 97) * 2147483648 + col % 89 AS piece_index,
                  (16777215 - ord) * 1073741824 + (32767 - row % 97) * 32768 + 32767 - col % 89 AS rank
           FROM cover JOIN images USING (image_id)""",
        *GRID,
    ),
    "union_inputs": with_(
        f"""SELECT zoom, gx, gy, r, g, b, priority FROM pixels
            UNION ALL SELECT * FROM ({halved(f"({merged('pixels')})")})""",
        *RASTER,
    ),
    "distinct_tiles": with_("SELECT DISTINCT zoom, col, row FROM cover", *GRID),
    "distinct_bounds": with_(
        """SELECT zoom, CAST(min(col) AS INT) AS col_min, row_min, CAST(max(col) AS INT) AS col_max, row_max
           FROM (SELECT *, col - row_number() OVER (PARTITION BY zoom, row_min, row_max ORDER BY col) AS run
                 FROM (SELECT zoom, col, CAST(min(row) AS INT) AS row_min, CAST(max(row) AS INT) AS row_max
                       FROM (SELECT zoom, col, row, row - row_number() OVER (PARTITION BY zoom, col ORDER BY row) AS island
                             FROM (SELECT DISTINCT zoom, col, row FROM cover)) GROUP BY zoom, col, island))
           GROUP BY zoom, row_min, row_max, run""",
        *GRID,
    ),
    "job_status": """SELECT job_id, stage, arg_max(status, moment) AS status, max(moment)['event_id'] AS event_id, count(*) AS updates
      FROM (SELECT user_id AS job_id, CASE WHEN event_id % 2 = 0 THEN 'chunk' ELSE 'mosaic' END AS stage,
            CASE event_type WHEN 'error' THEN 'FAILED' WHEN 'purchase' THEN 'FINISHED' ELSE 'STARTED' END AS status,
            {'ts': ts, 'event_id': event_id} AS moment FROM events) GROUP BY job_id, stage""",
}

ORACLE["nonempty_tiles"] = ORACLE["nonempty_chunks"]
ORACLE["split_tiles"] = with_(
    """SELECT image_id, CAST(zoom + 1 AS INT) AS zoom, CAST(gx // 4 AS INT) AS col, CAST(gy // 4 AS INT) AS row,
       CAST(gx % 4 AS INT) AS x, CAST(gy % 4 AS INT) AS y, r, g, b FROM pixels""",
    *RASTER,
)
ORACLE["split_tiles_packed"] = ORACLE["split_tiles"] + f" WHERE {HAS_DATA}"
