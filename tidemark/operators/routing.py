"""Topic routing of events."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def routing_key(op: Column | None = None) -> Column:
    return F.concat(F.lit("record."), F.col("op") if op is None else op)


def binding_regex(pattern: str) -> str:
    """A topic pattern as a regular expression: ``*`` is one word, ``#`` any number."""
    words = [r"[^.]+" if w == "*" else w if w == "#" else re.escape(w) for w in pattern.split(".")]
    # Several "#" in a row say no more than one.
    words = [w for i, w in enumerate(words) if w != "#" or i == 0 or words[i - 1] != "#"]
    if words == ["#"]:
        return "^.*$"
    text = r"\.".join(words)
    # "#" may stand for no word at all, so it takes its dot along.
    text = text.replace(r"\.#", r"(\.[^.]+)*").replace(r"#\.", r"([^.]+\.)*")
    return f"^{text}$"


class BindingTrie:
    """Topic patterns as one trie of words; ``*`` is one word, ``#`` any number.

    A topic walks all patterns at once: the places it can be in are a set of nodes.
    """

    def __init__(self, patterns: Iterable[str]):
        self._root: dict = {}
        for pattern in patterns:
            node = self._root
            for word in pattern.split("."):
                node = node.setdefault(word, {})
            node[""] = {}  # a pattern ends here; no word is empty

    def takes(self, topic: str) -> bool:
        """Whether any pattern takes the topic."""
        places = self._rest([self._root])
        for word in topic.split("."):
            step = []
            for node in places:
                step += [node[w] for w in {word, "*"} - {"", "#"} if w in node]
                if "_many" in node:
                    step.append(node)
            places = self._rest(step)
        return any("" in node for node in places)

    @staticmethod
    def _rest(nodes: list[dict]) -> list[dict]:
        """The nodes, and those reached by a ``#`` that stands for no word."""
        out, todo = [], list(nodes)
        while todo:
            node = todo.pop()
            if not any(node is o for o in out):
                out.append(node)
                if "#" in node:
                    node["#"]["_many"] = {}  # it may take further words
                    todo.append(node["#"])
        return out


def fan_out(events: DataFrame, bindings: Mapping[str, str]) -> DataFrame:
    """One copy of each event per subscriber whose binding takes its routing key.

    The subscribers of an event are an array built in the row, so events are read once.
    """
    key = F.col("routing_key")
    takers = F.array_compact(
        F.array(*[F.when(key.rlike(binding_regex(p)), F.lit(s)) for s, p in bindings.items()])
    )
    return events.withColumn("routing_key", routing_key()).withColumn("subscriber", F.explode(takers))


def subscribe(events: DataFrame, *patterns: str) -> DataFrame:
    """The events one subscriber receives, each once however many patterns match."""
    key = routing_key()
    return events.where(reduce(lambda a, b: a | b, [key.rlike(binding_regex(p)) for p in patterns]))
