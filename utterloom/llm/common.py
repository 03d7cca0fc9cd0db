"""What the training-data operators share: columns, Arrow passes, lineage cuts."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: The white space that separates words in every word contract here.
SPACE = r"[\x20\x09-\x0D]+"


#: Numbers up to which a list is broadcast (16 MB or so, two more a row counted in); beyond it the join shuffles.
BROADCAST_NUMBERS = 2_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(col: str = "text") -> Column:
    """The column as text; null counts as empty."""
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def words_of(text: Column) -> Column:
    """Non-empty words between runs of ASCII white space."""
    flat = F.translate(text, "\t\n\x0b\x0c\r", "     ")
    return F.filter(F.split(flat, " "), lambda w: w != "")


def fits(df: DataFrame, numbers: int | Column = 1) -> bool:
    """Whether df, of so many numbers a row (or as many as the column says), is small enough to be broadcast."""
    size = F.lit(numbers) if isinstance(numbers, int) else numbers
    return (df.agg(F.sum(size + 2)).first()[0] or 0) <= BROADCAST_NUMBERS


def few(df: DataFrame, numbers: int | Column = 0) -> DataFrame:
    """df, to be broadcast if its measured size allows it; a list of one column takes no more than its rows."""
    return F.broadcast(df) if fits(df, numbers) else df


def met(rows: DataFrame, table: DataFrame, key: str, numbers: int) -> DataFrame:
    """Inner join of many rows with a checkpointed table of one row a key: broadcast if it is small.

    Else both sides are shuffled and nothing but the join stands on either, so that adaptive execution can split a key
    that has a third of all rows over several tasks.
    """
    return rows.join(F.broadcast(table) if fits(table, numbers) else table, key)


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir; only a local session that names none gets its own."""
    sc = spark.sparkContext
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and (not sc.master.startswith("local") or sc.master.startswith("local-cluster")):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="utterloom-"))
    return sc._jsc.sc().getCheckpointDir().get()


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame) -> tuple[DataFrame, Callable[[], None]]:
    """df as a Parquet table in the shared folder, and what deletes it when no job needs it any more.

    For rows with texts, which a checkpoint would store uncompressed and read whole.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/table-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)

    def drop() -> None:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)

    return spark.read.parquet(path), drop


class Scratch:
    """Written tables of one step, which go when it is done; what it returns must not read them any more."""

    def __init__(self) -> None:
        self._drops: list[Callable[[], None]] = []

    def keep(self, df: DataFrame) -> DataFrame:
        table, drop = written(df)
        self._drops.append(drop)
        return table

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_: object) -> None:
        for drop in self._drops:
            drop()


def arrow_pass(
    df: DataFrame, rows: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str
) -> DataFrame:
    return df.mapInArrow(rows, schema)


def binaries(column: pa.Array) -> list[bytes | None]:
    """UTF-8 bytes of a string column, without decoding it."""
    wide = pa.types.is_large_string(column.type)
    return column.cast(pa.large_binary() if wide else pa.binary()).to_pylist()


def unique_name(df: DataFrame, base: str) -> str:
    """A column name that the frame doesn't have yet."""
    taken = {c.lower() for c in df.columns}
    name = base
    while name.lower() in taken:
        name = f"_{name}"
    return name
