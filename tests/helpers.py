import hashlib

from pyspark.sql import Row

from drivesync import schemas as s


def store_hash(data: bytes, block: int = s.HASH_BLOCK) -> str:
    digests = [hashlib.sha256(data[i:i + block]).digest() for i in range(0, len(data), block)]
    return hashlib.sha256(b"".join(digests)).hexdigest()


def record(seq, data=None, operation="create", **meta):
    """A destination record; metadata keys by their short names."""
    names = {
        "collection": s.COLLECTION, "name": s.FILE_NAME, "hash": s.FILE_HASH, "size": s.FILE_SIZE,
        "chunked": s.FILE_CHUNKED, "index": s.CHUNK_INDEX, "count": s.CHUNK_COUNT,
    }
    return Row(
        seq=seq, position=None, operation=operation,
        metadata={names[k]: v for k, v in meta.items()},
        key=Row(file_path="/src"), payload_before=None, payload_after=data,
    )


def records(spark, *rows):
    return spark.createDataFrame(list(rows), s.RECORD)


def chunked(seq, path_name, data, chunk, collection="/c", file_hash=None):
    """Chunk records of a file with consecutive seq."""
    count = max(1, -(-len(data) // chunk))
    return [
        record(
            seq + i, data[i * chunk:(i + 1) * chunk], collection=collection, name=path_name,
            hash=file_hash or store_hash(data), size=str(len(data)), chunked="true",
            index=str(i + 1), count=str(count),
        )
        for i in range(count)
    ]


def entry(path, size=0, tag="file", seq=None, when=0, content_hash=None, content=None):
    import datetime
    stamp = datetime.datetime.fromtimestamp(1_704_067_200 + when, datetime.timezone.utc)
    row = dict(
        tag=tag, id=f"id:{path}", name=path.rsplit("/", 1)[-1], path=path, server_modified=stamp,
        size=size, content_hash=content_hash,
    )
    if seq is not None:
        row = dict(seq=seq, **row)
    if content is not None:
        row["content"] = content
    return row


def entries(spark, *rows):
    schema = s.CHANGE if "seq" in rows[0] else s.ENTRY
    if "content" in rows[0]:
        schema = type(schema)(list(schema.fields)).add("content", "binary")
    return spark.createDataFrame([tuple(r[f] for f in schema.names) for r in rows], schema)


def as_set(df, *columns):
    return {tuple(r) for r in df.select(*columns).collect()}
