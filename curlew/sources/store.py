"""The record store: Parquet snapshots behind numbered pointers.

Every write makes a new snapshot from the old one, then a pointer of the next number, written aside and renamed into
place: readers take the highest number and so see either snapshot whole, and of two writers that started from one
snapshot the second fails. A job that fails leaves the old snapshot in place. Snapshots before the last KEEP go.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curlew.sources.scratch import delete


#: Snapshots that stay for readers that began on them.
KEEP = 3


class Store:
    def __init__(self, spark: SparkSession, root: str, key: str = "id"):
        self.spark, self.root, self.key = spark, root.rstrip("/"), key
        self._fs_path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._fs_path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    def _pointers(self) -> list[int]:
        folder = self._fs_path(f"{self.root}/_pointers")
        if not self._fs.exists(folder):
            return []
        return sorted(int(f.getPath().getName()) for f in self._fs.listStatus(folder) if f.getPath().getName().isdigit())

    def _snapshot(self, number: int) -> str:
        return json.loads(self.spark.read.text(f"{self.root}/_pointers/{number:010d}", wholetext=True).first()[0])["snapshot"]

    def read(self) -> DataFrame | None:
        numbers = self._pointers()
        return self.spark.read.parquet(f"{self.root}/{self._snapshot(numbers[-1])}") if numbers else None

    def _switch(self, df: DataFrame) -> None:
        numbers = self._pointers()
        number = numbers[-1] + 1 if numbers else 0
        name = f"snapshot-{uuid.uuid4().hex}"
        df.write.parquet(f"{self.root}/{name}")
        aside = self._fs_path(f"{self.root}/_pointers/.{name}")
        out = self._fs.create(aside, True)
        out.write(bytearray(json.dumps({"snapshot": name}).encode()))
        out.close()
        place = self._fs_path(f"{self.root}/_pointers/{number:010d}")
        if self._fs.exists(place) or not self._fs.rename(aside, place):
            raise RuntimeError("the store was written meanwhile")
        for old in numbers[: max(0, len(numbers) + 1 - KEEP)]:
            delete(self.spark, f"{self.root}/{self._snapshot(old)}")
            delete(self.spark, f"{self.root}/_pointers/{old:010d}")

    def upsert(self, new: DataFrame, now=None) -> None:
        """K4, K5: replaces rows by key, keeping created_at and an old raw_payload; adds columns either side lacks (K7).

        `now` fixes the time in tests. Of several new rows with a key the last by seq counts.
        """
        now = F.current_timestamp() if now is None else F.lit(now).cast("timestamp")
        if "seq" in new.columns:
            new = new.groupBy(self.key).agg(F.max_by(F.struct(*[c for c in new.columns if c != self.key]), "seq").alias("r")).select(self.key, "r.*")
        new = new.drop("created_at", "updated_at").withColumn("updated_at", now)
        old = self.read()
        if old is None:
            return self._switch(new.withColumn("created_at", now))
        kept = old.join(new.select(self.key), self.key, "left_anti")
        carried = ["created_at", *(["raw_payload"] if "raw_payload" in old.columns and "raw_payload" in new.columns else [])]
        before = old.select(self.key, *[F.col(c).alias(f"_{c}") for c in carried])
        changed = new.join(before, self.key, "left").withColumn("created_at", F.coalesce("_created_at", now))
        if "raw_payload" in carried:
            changed = changed.withColumn("raw_payload", F.coalesce("raw_payload", "_raw_payload"))
        self._switch(kept.unionByName(changed.drop(*[f"_{c}" for c in carried]), allowMissingColumns=True))

    def update_status(self, key: str, **values) -> None:
        """K6: some columns of one row."""
        old = self.read()
        hit = F.col(self.key) == key
        self._switch(old.withColumns({c: F.when(hit, F.lit(v)).otherwise(F.col(c)) for c, v in values.items()} | {"updated_at": F.when(hit, F.current_timestamp()).otherwise(F.col("updated_at"))}))

    def by_status(self, *statuses: str) -> DataFrame:
        """Oldest first; the filter reaches the Parquet scan."""
        return self.read().filter(F.col("status").isin(*statuses)).orderBy("created_at", "seq" if "seq" in self.read().columns else self.key)

    def latest(self, limit: int = 10) -> DataFrame:
        """S6."""
        return self.read().orderBy(F.desc("updated_at"), self.key).limit(limit)


def flatten(df: DataFrame) -> DataFrame:
    """The response's fields as columns, metadata as JSON text with sorted keys."""
    sorted_keys = F.to_json(F.map_from_entries(F.array_sort(F.map_entries(F.from_json("metadata", "map<string,string>")))))
    return df.select(*[c for c in df.columns if c not in ("response", "metadata")], *[F.col(f"response.{f}").alias(f"response_{f}") for f in ("format", "text", "chosen", "rejected")], sorted_keys.alias("metadata_json"))


def unflatten(df: DataFrame) -> DataFrame:
    pair = F.col("response_format") == "preference_pair"
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    response = F.struct(F.when(pair, "preference_pair").otherwise("single").alias("format"), F.when(~F.coalesce(pair, F.lit(False)), text("response_text")).alias("text"), F.when(pair, text("response_chosen")).alias("chosen"), F.when(pair, text("response_rejected")).alias("rejected"))
    flat = [f"response_{f}" for f in ("format", "text", "chosen", "rejected")]
    return df.select(*[c for c in df.columns if c not in (*flat, "metadata_json")], response.alias("response"), F.coalesce("metadata_json", F.lit("{}")).alias("metadata"))
