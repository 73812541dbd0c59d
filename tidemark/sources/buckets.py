"""A stored table in hash buckets, of which an upsert reads and writes only those with news."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.expressions import same_keys
from tidemark.session import checkpoint_folder
from tidemark.sources.files import child_names
from tidemark.sources.publish import NUMBER, recover, replace_folders

BUCKET = "bucket"


class BucketedTable:
    """Rows by key in ``buckets`` folders; the number of buckets stays what it was first.

    Files of a bucket are replaced as a whole, safe against a crash. Columns may come later: older
    buckets keep the ones they have, and reading fills in NULL.
    """

    def __init__(self, spark: SparkSession, root: str, keys: Sequence[str], buckets: int = 64):
        self.spark, self.root, self.keys, self.buckets = spark, root.rstrip("/"), list(keys), buckets
        self.staging = f"{self.root}.staging"
        recover(spark, self.staging)

    def bucket_of(self, keys: Sequence[str] | None = None) -> Column:
        """The bucket of a row; keys are hashed as text, so their width plays no role."""
        texts = [F.col(f"`{k}`").cast("string") for k in keys or self.keys]
        return F.pmod(F.xxhash64(*texts), F.lit(self.buckets)).cast("int")

    def stored_buckets(self) -> list[int]:
        return sorted(int(n.split("=")[1]) for n in child_names(self.spark, self.root) if n.startswith(f"{BUCKET}="))

    def read(self, buckets: Sequence[int] | None = None) -> DataFrame | None:
        """All rows, or those of some buckets; None if nothing is stored there."""
        there = self.stored_buckets()
        wanted = there if buckets is None else sorted(set(there) & set(buckets))
        if not wanted:
            return None
        paths = [f"{self.root}/{BUCKET}={b}" for b in wanted]
        return self.spark.read.option("mergeSchema", True).parquet(*paths)

    def replace(self, rows: DataFrame, buckets: Sequence[int] | None = None) -> None:
        """Store rows as the whole content of some buckets, or of all."""
        numbers = list(range(self.buckets)) if buckets is None else sorted(buckets)
        places = {b: k for k, b in enumerate(numbers)}
        place = F.create_map(*[F.lit(x) for pair in places.items() for x in pair])[self.bucket_of()]
        numbered = rows.withColumn(NUMBER, place.cast("int"))
        # One file a bucket: its rows meet in one task anyway where the table is joined by key.
        replace_folders(
            self.spark, [numbered.repartition(NUMBER)], [f"{self.root}/{BUCKET}={b}" for b in numbers], self.staging
        )

    def upsert(self, news: DataFrame) -> list[int]:
        """Put rows in place of the stored ones with their keys; returns the buckets that were touched.

        The news hold at most one row per key. Only the keys' buckets are read and written.
        """
        path = f"{checkpoint_folder(self.spark)}/news-{uuid.uuid4().hex}"
        news.write.parquet(path)
        fresh = self.spark.read.schema(news.schema).parquet(path)
        touched = sorted(r[0] for r in fresh.select(self.bucket_of()).distinct().collect())
        if not touched:
            return []
        old = self.read(touched)
        if old is None:
            self.replace(fresh, touched)
            return touched
        new_keys = fresh.select([F.col(k).alias(f"_new_{k}") for k in self.keys])
        kept = old.join(new_keys, same_keys(old, new_keys, self.keys, "_new_"), "left_anti")
        self.replace(kept.unionByName(fresh, allowMissingColumns=True), touched)
        return touched
