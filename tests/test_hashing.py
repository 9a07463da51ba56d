from helpers import store_hash
from pyspark.sql import functions as F

from drivesync.functions.hashing import content_hash

# Published hashes of two small files.
GOLDEN = {
    b"test file content": "d8a411e8f8643821bed189e627ff57151918aa554c00c10b31c693ab2dded273",
    b"a" * 3072: "2fc8ddec4e71269c71f2fb08b062172bfa4699b979c7a16d2a8dcc0dab488214",
}


def test_golden(spark):
    df = spark.createDataFrame([(k,) for k in GOLDEN], "c binary")
    for row in df.select("c", content_hash(F.col("c")).alias("h")).collect():
        assert row.h == GOLDEN[bytes(row.c)]


def test_blocks(spark):
    datas = [bytes(range(256)) * n + b"x" * n for n in range(0, 20)]
    df = spark.createDataFrame([(d,) for d in datas], "c binary")
    for block in (1, 7, 256, 1024):
        for row in df.select("c", content_hash(F.col("c"), block).alias("h")).collect():
            assert row.h == store_hash(bytes(row.c), block)
