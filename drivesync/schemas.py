"""Row types of listings, records and positions, and the metadata key names."""

from pyspark.sql import types as T

# Metadata keys, entry tags, operations and error texts that
# producers and consumers of the records agree on.
FILE_NAME = "opencdc.file.name"
FILE_ID = "file_id"
FILE_PATH = "file_path"
COLLECTION = "opencdc.collection"
FILE_SIZE = "opencdc.file.size"
FILE_HASH = "opencdc.file.hash"
FILE_CHUNKED = "opencdc.file.chunked"
CHUNK_INDEX = "opencdc.file.chunk.index"
CHUNK_COUNT = "opencdc.file.chunk.count"

TAG_FOLDER = "folder"
TAG_DELETED = "deleted"

CREATE = "create"
DELETE = "delete"

ERR_INDEX_MISSING = "invalid chunk: chunk index not found"
ERR_INDEX_PARSE = "failed to parse chunk index"
ERR_COUNT_MISSING = "invalid chunk: total chunk not found"
ERR_COUNT_PARSE = "failed to parse total chunks"
ERR_HASH_MISSING = "invalid chunk: hash not found"
ERR_SIZE_MISSING = "invalid chunk: file size not found"
ERR_SIZE_PARSE = "failed to parse file size"
ERR_NAME_MISSING = "missing metadata filename"
ERR_SESSION = "invalid session"
ERR_CORRUPT = "corrupt file upload"
# Ours: conditions the fixed texts above have no name for.
ERR_INDEX_RANGE = "invalid chunk: index out of range"
ERR_ESCAPE = "path escapes base"
ERR_HASH_DIFFERS = "corrupt file upload: content hash differs"
ERR_NO_RECORD = "invalid record: not a record in JSON"
ERR_NO_OPERATION = "invalid record: unknown operation"
ERR_NO_KEY = "invalid record: no file path in the key"

# Store hash: sha256 over the concatenated sha256 of each 4 MiB block.
HASH_BLOCK = 4 * 1024 * 1024
DEFAULT_CHUNK_SIZE = 3_932_160
MAX_CHUNK_SIZE = 4 * 1024 * 1024

ENTRY = T.StructType([
    T.StructField("tag", T.StringType()),
    T.StructField("id", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("path", T.StringType()),
    T.StructField("server_modified", T.TimestampType()),
    T.StructField("size", T.LongType()),
    T.StructField("content_hash", T.StringType()),
])

CHANGE = T.StructType([T.StructField("seq", T.LongType())] + ENTRY.fields)

# As kept in the log: ``mark`` is the newest modification time (nanoseconds)
# of the files before the entry, which positions carry.
LOGGED = T.StructType(CHANGE.fields + [T.StructField("mark", T.LongType())])

CHUNK_INFO = T.StructType([
    T.StructField("file_id", T.StringType()),
    T.StructField("file_path", T.StringType()),
    T.StructField("chunk_index", T.LongType()),
    T.StructField("total_chunks", T.LongType()),
])

POSITION = T.StructType([
    T.StructField("cursor", T.StringType()),
    T.StructField("chunk_info", CHUNK_INFO),
    T.StructField("last_processed_unix_time", T.LongType()),
])

RECORD = T.StructType([
    T.StructField("seq", T.LongType()),
    T.StructField("position", T.StringType()),
    T.StructField("operation", T.StringType()),
    T.StructField("metadata", T.MapType(T.StringType(), T.StringType())),
    T.StructField("key", T.StructType([T.StructField("file_path", T.StringType())])),
    T.StructField("payload_before", T.BinaryType()),
    T.StructField("payload_after", T.BinaryType()),
])

# A record as JSON text; payloads are base64. ``BAD_JSON`` receives text that is no such record.
BAD_JSON = "_bad_json"
RECORD_JSON = T.StructType([
    *[field for field in RECORD.fields if field.name in ("position", "operation", "metadata", "key")],
    T.StructField("payload", T.StructType([
        T.StructField("before", T.BinaryType()),
        T.StructField("after", T.BinaryType()),
    ])),
    T.StructField(BAD_JSON, T.StringType()),
])

SEGMENT = T.StructType([
    T.StructField("target_path", T.StringType()),
    T.StructField("hash", T.StringType()),
    T.StructField("chunk_count", T.LongType()),
    T.StructField("segment", T.LongType()),
    T.StructField("have", T.LongType()),
    T.StructField("want", T.LongType()),
    T.StructField("bytes", T.LongType()),
    T.StructField("seq", T.LongType()),
    T.StructField("last_seq", T.LongType()),
    T.StructField("size", T.LongType()),
    T.StructField("content", T.BinaryType()),
])

# What the state of a stream knows of a segment.
SESSION = T.StructType([field for field in SEGMENT.fields if field.name != "content"])

# As stored: ``multi`` is the folder, true for files of several segments.
STORED_SEGMENT = T.StructType(SEGMENT.fields + [T.StructField("multi", T.BooleanType())])

# Checked records as stored; ``failed`` and ``action`` are folders.
ACTION = T.StructType([
    T.StructField("seq", T.LongType()),
    T.StructField("action", T.StringType()),
    T.StructField("target_path", T.StringType()),
    T.StructField("chunk_index", T.LongType()),
    T.StructField("chunk_count", T.LongType()),
    T.StructField("hash", T.StringType()),
    T.StructField("size", T.LongType()),
    T.StructField("length", T.LongType()),
    T.StructField("payload_after", T.BinaryType()),
    T.StructField("error", T.StringType()),
    T.StructField("failed", T.BooleanType()),
])
