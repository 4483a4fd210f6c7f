"""Helpers shared by the training-data operators: tables, scratch space, words."""

from __future__ import annotations

import gc
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from curlew.functions.memory import give_back
from curlew.llm.tokens import forget_words
from curlew.sources.scratch import delete, shared_root

#: Bytes that separate words everywhere in this subpackage.
SPACE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table. Texts go to Python in batches that Spark bounds by bytes (spark.sql.execution.arrow.maxBytesPerBatch, 64 MB)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class Stored:
    """A DataFrame written to the shared scratch folder, so that lost executors cost no recomputation."""

    def __init__(self, df: DataFrame, name: str):
        self.spark = df.sparkSession
        self.path = f"{shared_root(self.spark)}/{name}-{uuid.uuid4().hex}"
        df.write.option("compression", "zstd").parquet(self.path)
        self.df = self.spark.read.schema(df.schema).parquet(self.path)

    def drop(self) -> None:
        """Deletes the files. Only for tables that no DataFrame still to be run reads."""
        delete(self.spark, self.path)


class Temporary:
    """Deletes at its end what `store` wrote within it, except what `keep` was told of.

    For operators that return tables that read only a few of those they wrote.
    """

    _open: list[Temporary] = []

    def __enter__(self) -> Temporary:
        self.made: list[Stored] = []
        self._open.append(self)
        return self

    def keep(self, stored: Stored) -> Stored:
        self.made.remove(stored)
        if len(self._open) > 1:
            self._open[-2].made.append(stored)
        return stored

    def __exit__(self, *_) -> None:
        self._open.remove(self)
        for x in self.made:
            x.drop()


def store(df: DataFrame, name: str) -> Stored:
    out = Stored(df, name)
    if Temporary._open:
        Temporary._open[-1].made.append(out)
    return out


def release(spark: SparkSession) -> None:
    """Lets go of the shuffle files of stages whose results are stored, instead of at the driver's next garbage collection."""
    gc.collect()
    spark._jvm.System.gc()


def lean(run: Callable[[Iterator], Iterator], encodes: bool = False) -> Callable[[Iterator], Iterator]:
    """The function over batches, such that a Python worker, which lives on for other stages, keeps little memory.

    Before it goes what encoders remember of earlier stages, unless the function `encodes`; after it what was freed.
    """

    def wrapped(batches):
        if not encodes and forget_words():
            give_back()
        yield from run(batches)
        give_back()

    return wrapped


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def utf8(text: Column) -> Column:
    """The text's UTF-8 bytes; null counts as empty."""
    return F.coalesce(text, F.lit("")).cast("binary")


def text_key(text: Column) -> Column:
    """Tells texts with one doc_id apart."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def left_join(big: DataFrame, small: DataFrame, key: str) -> DataFrame:
    """Left join on a nullable key of which one value may hold a large part of `big`; `small` has one row a key.

    Adaptive execution broadcasts a small side by its measured size and splits a partition that a hot key makes large,
    so neither side is repeated beforehand.
    """
    right = small.withColumnRenamed(key, "_key")
    return big.join(right, big[key].eqNullSafe(right["_key"]), "left").drop("_key")


def fresh(name: str, columns: list[str]) -> str:
    """The name, with underscores added while a column has it already."""
    while name.lower() in {c.lower() for c in columns}:
        name += "_"
    return name


#: Bits of a bitmap of hashed keys: 4 MB, however many keys there are.
BITMAP = 1 << 25


def bitmap_filter(df: DataFrame, keyed: DataFrame, keys: list[str], flag: str | None = None) -> DataFrame:
    """Passes rows of `df` whose keys may be among those of `keyed` (or, with `flag`, says so in a column).

    The hashed keys are sent to all executors as a bitmap of fixed size, so rows that can't join aren't
    shuffled. Where keys outnumber the bits it lets more rows pass; what it drops never joins.
    """
    slot = F.pmod(F.xxhash64(*keys), F.lit(BITMAP))
    words = keyed.select(slot.alias("s")).groupBy(F.expr("shiftright(s, 6)").alias("_word")).agg(F.expr("bit_or(shiftleft(1L, cast(s & 63 AS int)))").alias("_bits"))
    marked = df.withColumn("_slot", slot)
    joined = marked.join(F.broadcast(words), F.expr("shiftright(_slot, 6)") == words["_word"], "left")
    hit = F.coalesce(F.expr("(_bits & shiftleft(1L, cast(_slot & 63 AS int))) != 0"), F.lit(False))
    return joined.filter(hit).select(*df.columns) if flag is None else joined.select(*df.columns, hit.alias(flag))
