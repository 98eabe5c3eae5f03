import base64
import gzip
import hashlib
import os
import random

import pytest
from pyspark.sql import functions as F

from spendlens.llm import warc
from spendlens.llm.warc import parse_record, read_manifest, read_warc, record, write_warc


def digest(b):
    return base64.b32encode(hashlib.sha1(b).digest()).decode()


def expected(rows, min_bytes=0):
    top = {}
    for i, _, h in rows:
        if i is not None:
            top[h or ""] = max(i, top.get(h or "", i))
    out = []
    for i, _, h in rows:
        b = (h or "").encode()
        to = top.get(h or "") if len(b) >= min_bytes else i
        out.append((i, len(b), digest(b), "response" if to == i or to is None else "revisit",
                    None if to == i else to))
    return sorted(out, key=repr)


def actual(df):
    return sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)
                   for r in df.collect()), key=repr)


SCHEMA = "page_id bigint, url string, html string"


@pytest.mark.parametrize("min_bytes,shard,roll", [(0, 64 << 20, 16 << 20), (20, 9000, 700)])
def test_round_trip(spark, workdir, min_bytes, shard, roll):
    r = random.Random(1)
    pool = ["same page é😀" * 3, "", None, "short", "\r\n\r\nWARC/1.1\r\n"]
    rows = [(i * 7, f"http://h/{i}\n x é", r.choice(pool) if r.random() < 0.4 else
             "".join(r.choice("<p>abc é\r\n") for _ in range(r.randrange(500)))) for i in range(300)]
    folder = f"file://{workdir}/w"
    manifest = write_warc(spark.createDataFrame(rows, SCHEMA).repartition(5), folder, min_bytes, shard, roll)
    assert actual(read_warc(spark, folder)) == expected(rows, min_bytes)
    html = {i: (h or "").encode() for i, _, h in rows}
    for x in read_warc(spark, folder).collect():
        assert x.payload == (html[x.page_id] if x.record_type == "response" else None)
    files = sorted(manifest.collect())
    on_disk = sorted(f for f in os.listdir(f"{workdir}/w") if f.endswith(".gz"))
    assert [f.name for f in files] == on_disk and not os.listdir(f"{workdir}/w/temporary")
    assert len(files) > (3 if roll == 700 else 0)
    ids = []
    for f in files:  # in id order over the files, each a chain of gzip members
        data = gzip.open(f"{workdir}/w/{f.name}").read()
        assert data.count(b"WARC/1.1\r\nWARC-Type") == f.records
        ids += [int(x.split(b"\r\n")[0]) for x in data.split(b"X-Page-Id: ")[1:]]
    assert ids == sorted(ids) or shard == 9000
    # the same rows, dealt otherwise, give the same bytes
    again = write_warc(spark.createDataFrame(rows[::-1], SCHEMA).repartition(3), f"{folder}2",
                       min_bytes, shard, roll)
    assert sorted(again.collect()) == files


def test_odd_rows(spark, workdir):
    rows = [(1, None, None), (1, None, None), (None, "u", "x"), (4, "", "x"), (4, "u", "x"),
            (2**62, "u", "y" * 3_000_000), (-(2**62), "u", "y")]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("digest", F.lit("d")).withColumn("shard", F.lit(9))
    write_warc(df, f"{workdir}/o", shard_bytes=1 << 20, roll_bytes=1 << 12)
    assert actual(read_warc(spark, f"{workdir}/o")) == expected(rows)
    write_warc(df.limit(0), f"{workdir}/e")
    assert read_warc(spark, f"{workdir}/e").count() == 0


def test_hot_cell_is_split(spark):
    df = spark.range(4000).select(F.when(F.col("id") < 3000, 5).otherwise(F.col("id")).alias("page_id"),
                                  F.encode(F.lit("x" * 100), "utf-8").alias("payload"),
                                  F.col("id").alias("digest"))
    sharded, n = warc.assign_shards(df, 200_000)
    counts = {r.shard: r["count"] for r in sharded.groupBy("shard").count().collect()}
    assert sum(counts.values()) == 4000 and max(counts) < n and max(counts.values()) < 500


def test_damage_and_strays(spark, workdir):
    folder = f"{workdir}/d"
    write_warc(spark.createDataFrame([(i, "u", f"page {i}") for i in range(20)], SCHEMA), folder)
    open(f"{folder}/pages-000099-00000.warc.gz", "wb").write(b"stray")
    open(f"{folder}/temporary/left.warc.gz", "wb").write(b"stray")
    assert read_warc(spark, folder).count() == 20
    name = read_manifest(spark, folder).first().name
    data = open(f"{folder}/{name}", "rb").read()
    open(f"{folder}/{name}", "wb").write(data[:-30])
    with pytest.raises(Exception, match="cut short|has 19 of 20"):
        read_warc(spark, folder).count()
    good = record(3, "u", b"payload", None, "d")
    assert parse_record(good)[:2] == (3, 7)
    with pytest.raises(ValueError, match="damaged"):
        parse_record(good.replace(b"payload\r\n\r\n", b"pAyload\r\n\r\n"))
