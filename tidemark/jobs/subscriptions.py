"""Durable subscriptions: each subscriber reads the events its bindings take, from where it stopped.

Committed events of a store are dealt out by topic (their routing key) as runs, one publication
after another; a manifest entry names the runs and how far the store's log has been published.
Which topics a subscriber takes is found in a trie of its bindings, once per topic and not per
event, so it opens the runs of its topics alone, and of these the publications it has not yet
acknowledged. A delivery that is not acknowledged is delivered again.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.jobs.manifest import GRACE, Lost, Manifest
from tidemark.jobs.store import REPLAY, Store
from tidemark.operators.routing import BindingTrie, routing_key
from tidemark.schemas import CHANGE

# Folders of a publication: events/publication=<id>/routing_key=<topic>/
TOPIC = T.StructField("routing_key", T.StringType())
FOLDERS = [T.StructField("publication", T.StringType()), TOPIC]


@dataclass(frozen=True)
class Delivery:
    """Events for a subscriber up to a publication; acknowledge ``upto`` when they are dealt with."""

    events: DataFrame
    upto: int
    topics: tuple[str, ...]


class Subscriptions:
    def __init__(self, store: Store):
        self.store = store
        root = f"{store.root}/subscriptions"
        self.manifest = Manifest(store.spark, f"{root}/manifest", f"{root}/runs")

    def subscribe(self, name: str, *patterns: str, from_start: bool = True) -> None:
        """Add a subscriber, or change the bindings of one; what it acknowledged stays."""

        def added(content: dict) -> dict:
            known = content.get("subscribers", {})
            start = 0 if from_start else content.get("published", 0)
            upto = known.get(name, {}).get("upto", start)
            return {**content, "subscribers": {**known, name: {"patterns": list(patterns), "upto": upto}}}

        self.manifest.step(added)

    def publish(self) -> int:
        """Deal out what the store committed since the last publication; returns its number.

        The events of one topic are one run. Of two publishers at a time the first counts.
        """
        content = self.manifest.newest()[1]
        covered, number = content.get("covered", {}), content.get("published", 0)
        modes = self.store.manifest.newest()[1].get("modes", {})
        upto = {mode: m["upto"] for mode, m in modes.items() if m.get("upto")}
        if upto == covered:
            return number
        # Batches beyond the last without a gap wait for it, so none is published twice.
        rows = self.store.changes(covered)
        ripe = F.lit(False)
        for mode, batch_id in upto.items():
            ripe = ripe | ((F.col("mode") == mode) & (F.col("batch_id") <= batch_id))
        events = rows.where(ripe & (F.col("mode") != REPLAY)).withColumn(TOPIC.name, routing_key())
        run = f"events/{FOLDERS[0].name}={uuid.uuid4().hex}"
        events.select(*CHANGE.names, TOPIC.name).write.partitionBy(TOPIC.name).parquet(self.manifest.path(run))
        written = self.store.spark.read.schema(T.StructType([CHANGE["id"], TOPIC])).parquet(self.manifest.path(run))
        # One row per topic.
        topics = {r[TOPIC.name]: r["count"] for r in written.groupBy(TOPIC.name).count().collect()}

        def published(content: dict) -> dict:
            if content.get("published", 0) != number:
                raise Lost("another publication was faster")
            runs = [*content.get("runs", []), {"path": run, "number": number + 1, "topics": topics}]
            return {**content, "published": number + 1, "covered": upto, "runs": runs}

        try:
            return self.manifest.step(published)["published"]
        except Lost:
            return self.manifest.newest()[1]["published"]

    def poll(self, name: str) -> Delivery:
        """The events a subscriber has not acknowledged, each once however many bindings take it."""
        content = self.manifest.newest()[1]
        mine = content["subscribers"][name]
        trie = BindingTrie(mine["patterns"])
        wanted = [(r["path"], t) for r in content.get("runs", []) if r["number"] > mine["upto"] for t in r["topics"] if trie.takes(t)]
        schema = T.StructType([*CHANGE.fields, *FOLDERS])
        if wanted:
            # One folder per publication and topic; what all have acknowledged is not among them.
            paths = [f"{self.manifest.path(path)}/{TOPIC.name}={topic}" for path, topic in wanted]
            events = self.store.spark.read.schema(schema).option("basePath", self.manifest.path("events")).parquet(*paths)
        else:
            events = self.store.spark.createDataFrame([], schema)
        events = events.drop(FOLDERS[0].name)
        return Delivery(events, content.get("published", 0), tuple(sorted({topic for _, topic in wanted})))

    def acknowledge(self, name: str, upto: int) -> None:
        """Note how far a subscriber has come; publications that all have passed are dropped."""

        def noted(content: dict) -> dict:
            known = content["subscribers"]
            known = {**known, name: {**known[name], "upto": max(known[name]["upto"], upto)}}
            passed = min(s["upto"] for s in known.values())
            runs = [r for r in content.get("runs", []) if r["number"] > passed]
            return {**content, "subscribers": known, "runs": runs}

        self.manifest.step(noted)

    def backlog(self, names: Iterable[str] | None = None) -> dict[str, int]:
        """Events waiting per subscriber, from the counts of the publications."""
        content = self.manifest.newest()[1]
        out = {}
        for name, s in content.get("subscribers", {}).items():
            if names is None or name in names:
                trie = BindingTrie(s["patterns"])
                fresh = [r["topics"] for r in content.get("runs", []) if r["number"] > s["upto"]]
                out[name] = sum(n for topics in fresh for t, n in topics.items() if trie.takes(t))
        return out

    def vacuum(self, grace: float = GRACE) -> int:
        """Remove dropped publications."""
        return self.manifest.vacuum(grace)
