"""Subscriptions: every event of its topics, once, from where a subscriber stopped."""

import random
import re

from test_jobs import ROWS, Table, fresh

from tidemark.jobs import replicate
from tidemark.jobs import store as st
from tidemark.jobs.subscriptions import Subscriptions
from tidemark.operators.routing import BindingTrie, binding_regex


def test_the_trie_takes_what_the_patterns_take():
    rng = random.Random(2)
    words = ["a", "b", "record", "*", "#"]
    for _ in range(400):
        patterns = [".".join(rng.choices(words, k=rng.randint(1, 4))) for _ in range(rng.randint(1, 4))]
        topic = ".".join(rng.choices(words[:3], k=rng.randint(1, 5)))
        want = any(re.fullmatch(binding_regex(p)[1:-1], topic) for p in patterns)
        assert BindingTrie(patterns).takes(topic) == want, (patterns, topic)


def received(delivery):
    return sorted((r["id"], r["version"], r["op"]) for r in delivery.events.collect())


def test_a_subscriber_resumes_and_opens_its_topics_alone(spark, work):
    store, source = fresh(spark, work), Table(spark, ROWS)
    subs = Subscriptions(store)
    subs.subscribe("all", "#")
    subs.subscribe("gone", "record.deleted", "*.deleted")
    replicate.run_backfill(store, source, chunk_rows=15)
    assert subs.publish() == 1 == subs.publish()
    events = sorted((r["id"], r["version"], r["op"]) for r in store.events().collect())
    deleted = [e for e in events if e[2] == "deleted"]
    first = subs.poll("gone")
    assert received(first) == deleted and first.topics == ("record.deleted",)
    assert all("routing_key=record.deleted" in f for f in first.events.inputFiles())
    assert received(subs.poll("gone")) == deleted  # not acknowledged: delivered again
    assert subs.backlog() == {"all": 40, "gone": len(deleted)}
    subs.acknowledge("gone", first.upto)
    assert received(subs.poll("gone")) == [] and received(subs.poll("all")) == events
    replicate.run_incremental(store, source)
    again = Subscriptions(st.Store(spark, store.root))  # another process
    assert again.publish() == 2
    assert received(again.poll("gone")) == deleted and received(again.poll("all")) == sorted(events * 2)
    again.subscribe("late", "record.created", from_start=False)
    assert received(again.poll("late")) == []
    second = again.poll("all")
    again.acknowledge("all", second.upto)
    again.acknowledge("gone", second.upto)
    assert again.manifest.newest()[1]["runs"] == [] and again.vacuum(grace=0) == 2


def test_a_replay_publishes_nothing_and_gaps_wait(spark, work):
    from rows import record

    store, source = fresh(spark, work), Table(spark, ROWS)
    subs = Subscriptions(store)
    subs.subscribe("all", "#")
    replicate.plan_chunks(store, source(), 10)
    (row,) = store.ledger().where("kind = 'chunk' AND batch_id = 2").collect()
    store.claim(st.Batch(st.BACKFILL, 2, 0, 0, row["lo_id"], row["last_id"]), "slow", 600)
    assert replicate.run_backfill(store, source, max_chunks=3) == 3
    subs.publish()
    assert [e[0] for e in received(subs.poll("all"))] == list(range(1, 11))  # chunks 3 and 4 wait for 2
    store.renew("slow", 0)
    replicate.run_backfill(store, source)
    source.rows[2] = record(3, amount="1.00")
    assert replicate.run_replay(store, source) == 1
    subs.publish()
    assert [e[0] for e in received(subs.poll("all"))] == list(range(1, 41))
