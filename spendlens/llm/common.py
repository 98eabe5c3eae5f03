"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spendlens.session import checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession, label: str) -> str:
    """A new folder under ``spark.checkpoint.dir``, which all executors see."""
    return f"{checkpoint_dir(spark).rstrip('/')}/spendlens-llm/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back.

    Cuts the lineage: a lost executor costs a re-read, not a recomputation.
    """
    path = shared_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col), F.lit(""))


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def unused(df: DataFrame, *names: str) -> list[str]:
    """Column names like ``names`` that ``df`` has not got, in whatever case."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        name = f"_{name}"
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def let(value: Column, kind: str, use) -> Column:
    """``use(value)`` of type ``kind``, with the value worked out once."""
    return F.aggregate(F.array(value), F.lit(None).cast(kind), lambda _, v: use(v))


#: Elements whose running totals are worked out in one go, with copies of what is there.
RUN = 256


def _running(values: Column, op) -> Column:
    """Exclusive running totals of a short int array: the accumulator is copied at each step."""
    start = F.struct(F.lit(0).alias("now"), F.array().cast("array<int>").alias("out"))
    return F.aggregate(values, start, lambda a, x: F.struct(
        op(a["now"], x).alias("now"), F.concat(a["out"], F.array(a["now"])).alias("out")),
        lambda a: a["out"])


def running(values: Column, op) -> Column:
    """Exclusive running totals of an int array under ``op`` (a sum or a maximum of
    numbers that are not negative): what the elements before each one come to.

    Long arrays go in two levels, blocks of ``RUN`` and the blocks' totals, so that a
    million elements cost no million copies of a million."""
    kind = "array<int>"

    def blocked(v: Column) -> Column:
        parts = F.transform(F.sequence(F.lit(0), F.floor((F.size(v) - 1) / RUN).cast("int")),
                            lambda k: F.slice(v, k * RUN + 1, RUN))
        return let(parts, kind, lambda p: F.flatten(F.zip_with(
            p, _running(F.transform(p, lambda b: F.aggregate(b, F.lit(0), op)), op),
            lambda b, base: F.transform(_running(b, op), lambda x: op(base, x)))))

    return let(values, kind, lambda v: F.when(F.size(v) <= RUN, _running(v, op)).otherwise(blocked(v)))


def cut_text(text: Column, kind: str, use, block: int = 256) -> Column:
    """``use(part)`` of type ``kind``, where ``part(start, end)`` is a part of the text in code
    points.  The text is cut into blocks once, so that many parts of a long text do not walk
    it from its start again and again."""
    def part(blocks: Column, start: Column, end: Column) -> Column:
        k = F.floor(start / block).cast("int")
        n = F.floor((F.greatest(end, start + 1) - 1) / block).cast("int") - k + 1
        return F.substr(F.array_join(F.slice(blocks, k + 1, n), ""), start % block + 1, end - start)

    blocks = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{block}}}"), F.lit(0))
    return let(blocks, kind, lambda b: use(lambda start, end: part(b, start, end)))
