"""Explicit schemas of every table and file format read or written."""

HEADERS = (
    "identifier STRING, datestamp TIMESTAMP, setSpec ARRAY<STRING>, _status STRING"
)
SETS = "setSpec STRING, setName STRING"
RESUMPTION_TOKEN = (
    "_VALUE STRING, _completeListSize BIGINT, _cursor BIGINT, "
    "_expirationDate TIMESTAMP"
)
# One whole response document, for pages kept as text in a table.
_HEADER_STRUCT = (
    "STRUCT<identifier: STRING, datestamp: TIMESTAMP, "
    "setSpec: ARRAY<STRING>, _status: STRING>"
)
LISTING_PAGE = (
    "ListIdentifiers STRUCT<"
    f"header: ARRAY<{_HEADER_STRUCT}>, "
    "resumptionToken: STRUCT<_VALUE: STRING, _completeListSize: BIGINT, "
    "_cursor: BIGINT>>, "
    "ListRecords STRUCT<"
    f"record: ARRAY<STRUCT<header: {_HEADER_STRUCT}>>, "
    "resumptionToken: STRUCT<_VALUE: STRING, _completeListSize: BIGINT, "
    "_cursor: BIGINT>>, "
    "ListSets STRUCT<set: ARRAY<STRUCT<setSpec: STRING, setName: STRING>>>"
)

# ``xs_any`` takes every other child of <file>, whatever its name, so that the
# exactly-one-child rule can count them all. The corrupt-record field is last:
# a leading one shifts the parsed fields.
MANIFEST = (
    "fileSec STRUCT<fileGrp: ARRAY<STRUCT<_ID: STRING, _USE: STRING, "
    "file: ARRAY<STRUCT<_SEQ: STRING, _GROUPID: STRING, "
    "FLocat: ARRAY<STRUCT<_LOCTYPE: STRING, _href: STRING>>, "
    "xs_any: ARRAY<STRING>>>>>>, "
    "_corrupt_record STRING"
)

BINDING_LIST = (
    "set_id STRING, kind STRING, list_date DATE, dc_identifier STRING, run_id STRING"
)
LIST_MARKERS = (
    "set_id STRING, kind STRING, list_date DATE, run_id STRING, n_rows BIGINT"
)
SUBSET_SPLIT = "set_id STRING, priority INT, prefix STRING"
RUNS = "set_id STRING, run_id STRING, state STRING, execution_date TIMESTAMP"
PUBLISHED = (
    "set_id STRING, subset_id STRING, run_id STRING, attempt STRING, seq BIGINT, "
    "location STRING, removed STRING, whole BOOLEAN, published_at TIMESTAMP"
)
# A bit for each row of a data file, in buckets of equal numbers of rows.
REMOVED = (
    "run_id STRING, target STRING, kind STRING, file STRING, bucket BIGINT, rows BINARY"
)
VERSIONS = (
    "version_id STRING, created_at TIMESTAMP, set_id STRING, seq BIGINT, number BIGINT"
)
# ``run_id``, ``target`` and ``kind`` are folders; the others are in the files.
ARCHIVE = (
    "set_id STRING, subset_id STRING, binding_id STRING, page_number INT, "
    "path STRING, size BIGINT, content BINARY, "
    "run_id STRING, target STRING, kind STRING"
)
