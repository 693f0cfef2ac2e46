"""Shapes of the documents a job reads and writes. The field names are fixed by their format."""

GRID_BOUNDS = "struct<colMin: int, rowMin: int, colMax: int, rowMax: int>"
EXTENT = "struct<xmin: double, ymin: double, xmax: double, ymax: double>"

REQUEST_FIELDS = "jobId: string, target: string, images: array<string>, workspace: string"

MANIFEST_ENTRY = f"struct<sourceUri: string, extent: {EXTENT}, zoom: int, gridBounds: {GRID_BOUNDS}, tiles: string>"
MANIFEST_FIELDS = f"jobId: string, target: string, tileSize: int, input: array<{MANIFEST_ENTRY}>"
# One input of a job as a record of its own.
MANIFEST_LINE = f"jobId string, target string, tileSize int, position bigint, totalInputs bigint, input {MANIFEST_ENTRY}"

JOB_STATUS = "jobId string, stage string, status string, at timestamp_ntz, error string, stack string, target string"
