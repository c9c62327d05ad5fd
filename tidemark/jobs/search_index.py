"""Documents in slices by time, so that a page of a search opens the slices that fill it.

Slices follow one another in the order of hits, newest first. A small table has the number of
documents per slice, status and country: it tells which slices hold a page of such hits, and
adds up to totals. Words and addresses are not counted; for them slices are opened from the
newest on, twice as many each time, until the page is full.

An index is written beside the one in use and published with one manifest entry.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.times import micros
from tidemark.jobs.manifest import GRACE, Manifest
from tidemark.operators.search import PAGE_DEFAULT, matches, search, search_after, search_page, search_total

#: Documents aimed at per slice.
SLICE_ROWS = 1_000_000
COUNTS = T.StructType(
    [
        T.StructField("slice", T.IntegerType()),
        T.StructField("status", T.StringType()),
        T.StructField("country", T.StringType()),
        T.StructField("n", T.LongType()),
        T.StructField("oldest", T.LongType()),
    ]
)


class SearchIndex:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.manifest = spark, Manifest(spark, f"{root}/manifest", f"{root}/runs")

    def build(self, docs: DataFrame, slice_rows: int = SLICE_ROWS) -> None:
        """Index documents with columns ``id, name, email, company, country, status, updated_at``."""
        slices = max(1, -(-docs.count() // slice_rows))
        order = (F.desc("updated_at"), F.asc("id"))
        rows = docs.repartitionByRange(slices, *order).sortWithinPartitions(*order)
        name = self.manifest.new_run("slices")
        rows.withColumn("slice", F.spark_partition_id()).write.partitionBy("slice").parquet(self.manifest.path(name))
        written = self.spark.read.schema(T.StructType([*docs.schema.fields, COUNTS["slice"]])).parquet(self.manifest.path(name))
        counts = written.groupBy("slice", "status", "country").agg(
            F.count(F.lit(1)).alias("n"), F.min(micros(F.col("updated_at"))).alias("oldest")
        )
        run = self.manifest.write_run("counts", counts.coalesce(1))
        content = {"path": name, "counts": run, "schema": docs.schema.json(), "slices": slices}
        self.manifest.step(lambda _: content)

    def _counts(self, content: dict) -> DataFrame:
        return self.manifest.read_runs([content["counts"]], COUNTS)

    def _slices(self, content: dict, wanted: list[int]) -> DataFrame:
        schema = T.StructType.fromJson(json.loads(content["schema"]))
        path = self.manifest.path(content["path"])
        if not wanted:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{path}/slice={k}" for k in wanted])

    def _filled(self, content: dict) -> list[int]:
        """Slices that hold documents; one number per ``SLICE_ROWS`` documents."""
        return sorted(r["slice"] for r in self._counts(content).select("slice").distinct().collect())

    def _until_full(self, content: dict, slices: list[int], wanted: int, hits) -> DataFrame:
        """The first slices that hold ``wanted`` hits, or all."""
        m = 1
        while m < len(slices) and hits(self._slices(content, slices[:m])).limit(wanted).count() < wanted:
            m *= 2
        return self._slices(content, slices[:m])

    def page(self, page: int = 1, limit: int = PAGE_DEFAULT, q: str | None = None, **terms: str | None) -> DataFrame:
        """As ``search.search_page`` on all documents."""
        content, skip = self.manifest.newest()[1], (page - 1) * limit
        if q:
            found = self._until_full(content, self._filled(content), skip + limit, lambda docs: search(docs, q=q, **terms))
            return search_page(found, page, limit, q=q, **terms)
        upto = F.sum("n").over(Window.orderBy("slice"))
        per_slice = self._counts(content).where(matches(**terms)).groupBy("slice").agg(F.sum("n").alias("n"))
        placed = per_slice.withColumn("before", upto - F.col("n"))
        # Each of these holds a hit of the page, so there are at most as many as hits.
        held = placed.where((F.col("before") + F.col("n") > skip) & (F.col("before") < skip + limit)).orderBy("slice").collect()
        hits = search(self._slices(content, [r["slice"] for r in held]), **terms)
        first = skip - held[0]["before"] if held else 0
        return hits.orderBy(F.desc("updated_at"), "id").offset(first).limit(limit)

    def after(
        self, updated_micros: int, last_id: int, limit: int = PAGE_DEFAULT, q: str | None = None, **terms: str | None
    ) -> DataFrame:
        """As ``search.search_after`` on all documents."""
        content = self.manifest.newest()[1]
        ends = self._counts(content).groupBy("slice").agg(F.min("oldest").alias("oldest"))
        slices = sorted(r["slice"] for r in ends.where(F.col("oldest") <= updated_micros).select("slice").collect())
        follow = lambda docs: search_after(docs, updated_micros, last_id, limit, q=q, **terms)
        return follow(self._until_full(content, slices, limit, follow))

    def total(self, q: str | None = None, **terms: str | None) -> DataFrame:
        """As ``search.search_total``: added up from the counts, unless words are asked for."""
        content = self.manifest.newest()[1]
        if q:
            return search_total(self._slices(content, self._filled(content)), q=q, **terms)
        counts = self._counts(content).where(matches(**terms))
        return counts.agg(F.coalesce(F.sum("n"), F.lit(0).cast("long")).alias("total"))

    def vacuum(self, grace: float = GRACE) -> int:
        """Remove indexes that are out of use."""
        return self.manifest.vacuum(grace)
