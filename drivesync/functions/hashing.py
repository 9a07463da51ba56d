"""Content hash of the store: sha256 over the sha256 of each block.

These expressions hash content that sits in one cell; files spread over
several rows are hashed by ``operators.reassemble.hash_segments``.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

from drivesync.functions.numbers import ceil_div
from drivesync.schemas import HASH_BLOCK


def block_count(size: Column, block: int) -> Column:
    """Number of blocks; an empty file still counts one."""
    return ceil_div(size, block)


def content_hash(content: Column, block: int = HASH_BLOCK) -> Column:
    size = F.octet_length(content).cast("long")

    def block_digest(i: Column) -> Column:
        start = ((i - 1) * block + 1).cast("int")
        return F.sha2(F.substring(content, start, F.lit(block)), 256)

    blocks = F.sequence(F.lit(1).cast("long"), block_count(size, block))
    digests = F.unhex(F.array_join(F.transform(blocks, block_digest), ""))
    single = F.sha2(F.unhex(F.sha2(content, 256)), 256)
    empty = F.sha2(F.lit(b""), 256)
    return (
        F.when(size == 0, empty)
        .when(size <= block, single)
        .otherwise(F.sha2(digests, 256))
    )
