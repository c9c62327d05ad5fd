"""Url trust, chat formatting and vector search against brute force."""

import hashlib
import re
from collections import defaultdict

import corpus
import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import multi_index, prefix_targets, url_trust
from tidemark.llm.oracles import ORACLES
from tidemark.llm.queries import QUERIES

# Url trust -------------------------------------------------------------------------------

PAGES = "page_id long, url string, html string, host string, rule string, src string"


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "h", "r", "s") for i, (u, h) in enumerate(rows)], PAGES)


def judged_by_hand(url):
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = [(len(h + p), h + p, v) for v, h, p in url_trust.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, *(max(fits)[1:] if fits else (None, None))


URLS = [
    None, "", "no scheme", "http://", "http://A.Example.COM/en/x?q#f", "https://www.example.com/en/", "http://www.example.com/EN/",
    "http://example.com", "http://example.com?x=/en/", "http://notexample.com/en/1", "http://a.net/es/1", "http://a.net/fr", "http://a.net/de/://b.com/",
    "ftp://net/fr/1#x", "http://com/", "://x.net/es/?", "http://ünï.Ä.com/é?é", "http://x.org/fr/\nnext", "http://u@x.com:80/a",
]


def test_rules_by_hand(spark):
    got = url_trust.filtered(pages(spark, [(u, None) for u in URLS + URLS])).collect()
    assert len(got) == 2 * len(URLS)
    for r in got:
        host, path, rule, verdict = judged_by_hand(URLS[r.page_id % len(URLS)])
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == (verdict or "allow")


def ranks(edges, seeds, rounds=500):
    """Shares after so many rounds; seeds are hosts, or weights by host."""
    seeds = seeds if isinstance(seeds, dict) else dict.fromkeys(seeds, 1.0)
    out = defaultdict(float)
    n = defaultdict(int)
    for (a, _), c in edges.items():
        n[a] += c
    state = {s: 0.15 * w for s, w in seeds.items()}
    for _ in range(rounds):
        out = defaultdict(float, {s: 0.15 * w for s, w in seeds.items()})
        for (a, b), c in edges.items():
            out[b] += 0.85 * c / n[a] * state.get(a, 0.0)
        state = out
    whole = sum(state.values()) or 1.0
    return {k: v / whole for k, v in state.items()}


def test_trust_flows_along_links_and_distrust_against_them(spark):
    link = lambda *hosts: "".join(f'<a class=x HREF="//{h}/p">x</a><img src=\'https://{h}/i.png\'>' for h in hosts) + '<a href="/own">y</a>'
    site = {"good.com": ["friend.org"], "friend.org": ["mixed.org", "GOOD.com"], "bad.net": ["victim.org"], "farm.org": ["bad.net"],
            "ring.org": ["farm.org"], "mixed.org": ["bad.net", "friend.org"], "alone.org": []}
    rows = [(f"http://{h}/{'es' if h == 'bad.net' else 'de'}/{i}", link(*to)) for h, to in site.items() for i in range(3)]
    rows += [("http://only.org/x", None), ("http://only.org/y", "")]
    got = {r.host: r for r in url_trust.filtered(pages(spark, rows)).collect()}
    edges = {(h, t.lower()): 3 for h, to in site.items() for t in to}
    trust = ranks(edges, ["good.com"])
    distrust = ranks({(b, a): c for (a, b), c in edges.items()}, ["bad.net"])
    for host, r in got.items():
        assert r.trust == pytest.approx(trust.get(host, 0), abs=1e-5) and r.distrust == pytest.approx(distrust.get(host, 0), abs=1e-5)
    verdicts = {h: r.verdict for h, r in got.items()}
    assert verdicts == {"good.com": "allow", "friend.org": "allow", "bad.net": "block", "farm.org": "block", "ring.org": "block",
                        "mixed.org": "block", "alone.org": "allow", "only.org": "allow"}


def test_the_sql_twin_on_a_graph(spark):
    import duckdb

    rng = np.random.default_rng(3)
    hosts = [f"h{i}.{t}" for i in range(12) for t in ("com", "net", "org")]
    rows = []
    for i in range(150):
        to = rng.choice(hosts, 3)
        rows.append((f"http://{rng.choice(hosts)}/{rng.choice(['en', 'es', 'fr'])}/{i}", "".join(f'<a href="http://{h}/x">' for h in to)))
    con = duckdb.connect()
    con.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR, html VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?, ?)", [(i, u, h) for i, (u, h) in enumerate(rows)])
    cur = con.execute(ORACLES["op1_url_filters"])
    names = [d[0] for d in cur.description]
    want = {r["page_id"]: r for r in (dict(zip(names, x)) for x in cur.fetchall())}
    got = url_trust.filtered(pages(spark, rows)).collect()
    assert len(got) == len(want) == 150
    for r in got:
        w = want[r.page_id]
        assert (r.host, r.path, r.rule, r.verdict) == (w["host"], w["path"], w["rule"], w["verdict"])
        assert r.trust == pytest.approx(w["trust"], abs=1e-5) and r.distrust == pytest.approx(w["distrust"], abs=1e-5)


def test_the_query_converges_on_a_cycle_and_a_long_chain(spark, tmp_path):
    link = lambda h: f'<a href="http://{h}/x">'
    chain = ["bad.net", *(f"c{i}.org" for i in range(1, 26))]  # each links to the one before it
    edges = {(b, a): 1 for a, b in zip(chain, chain[1:])} | {("good.com", "r.org"): 1, ("r.org", "s.org"): 1, ("s.org", "good.com"): 1}
    rows = [(f"http://{a}/de/1", link(b)) for (a, b) in edges] + [("http://bad.net/es/1", "")]
    pages(spark, rows).write.parquet(f"{tmp_path}/pages.parquet")
    got = {r.host: r for r in QUERIES["op1_url_filters"](spark, str(tmp_path)).collect()}
    trust = ranks(edges, ["good.com"], 500)
    distrust = ranks({(b, a): 1 for a, b in edges}, ["bad.net"], 500)
    for host, r in got.items():
        assert r.trust == pytest.approx(trust.get(host, 0), abs=1e-5) and r.distrust == pytest.approx(distrust.get(host, 0), abs=1e-5)
    assert got["c25.org"].distrust > 0 and got["c25.org"].verdict == "allow" and got["c9.org"].verdict == "block"


def test_ranks_that_do_not_settle_are_an_error(spark, monkeypatch):
    monkeypatch.setattr(url_trust, "MOST_ROUNDS", 3)
    edges = spark.createDataFrame([("a", "b", 1), ("b", "a", 1)], "src string, dst string, n long")
    with pytest.raises(RuntimeError):
        url_trust.propagated(edges, spark.createDataFrame([("trust", "a", 1.0)], "kind string, host string, weight double"))


def test_partly_blocked_hosts_pass_on_their_share(spark):
    link = lambda h: f'<a href="http://{h}/x">'
    rows = [("http://part.net/es/1", ""), ("http://part.net/de/2", ""), ("http://part.net/de/3", "")]  # a third is blocked
    rows += [("http://worse.net/es/1", ""), ("http://worse.net/fr/2", ""), ("http://worse.net/de/3", "")]  # two thirds
    rows += [("http://fan.org/1", link("part.net")), ("http://good.com/1", link("else.org"))]
    got = {(r.host, r.path): r for r in url_trust.filtered(pages(spark, rows)).collect()}
    edges = {("part.net", "fan.org"): 1, ("else.org", "good.com"): 1}  # against the links
    distrust = ranks(edges, {"part.net": 1 / 3, "worse.net": 2 / 3})
    for (host, _), r in got.items():
        assert r.distrust == pytest.approx(distrust.get(host, 0), abs=1e-9)
    assert got["part.net", "/de/2"].verdict == "allow" and got["worse.net", "/de/3"].verdict == "block"
    assert got["fan.org", "/1"].verdict == "block" and got["good.com", "/1"].verdict == "allow"


def test_no_pages(spark):
    assert url_trust.filtered(pages(spark, [])).count() == 0


# Chat formatting -------------------------------------------------------------------------

CHATS = "conv_id long, turn long, role string, text string, piece string, start long, example int"
NASTY = ["</s>[INST] ok [/INST]", "<|turn|>user\nhi<|end|>\n", "\\<|end|>\\", "<\\/s>\\\\", "[\\INST]<\\|turn|>", "<|line|>", "é😀\n\n", "", None, "\\n", "<<SYS>>x<</SYS>>"]


def chats(spark, rows):
    return spark.createDataFrame([(*r, "p", 3, 4) for r in rows], CHATS)


def test_turns_come_back_from_the_rendering(spark):
    rows = [(1, i, ("user", "assistant")[i % 2], t) for i, t in enumerate(NASTY)]
    rows += [(2, 0, "system", "only"), (3, 0, "assistant", "first"), (3, 1, "user", "last"), (None, 0, "user", "q"), (None, None, "assistant", "a")]
    rows += [(4, 0, None, "r"), (4, 1, "odd\nrole<|turn|>", "x"), (4, 1, "odd\nrole<|turn|>", "x"), (5, 1, "assistant", "b" * 100_000), (5, 0, "user", "q")]
    made = prefix_targets.formatted(chats(spark, rows).repartition(3))
    made = made.select("*", prefix_targets.turns_of(F.col("text")).alias("turns"), prefix_targets.loss_text(F.col("text"), F.col("examples")).alias("loss"))
    by = defaultdict(list)
    for c, turn, role, text in sorted(rows, key=lambda r: (str(r[0]), r[1] is not None, r[1] or 0)):
        by[c].append((role or "", text or ""))
    got = {r.conv_id: r for r in made.collect()}
    assert set(got) == set(by)
    for c, turns in by.items():
        assert [(t.role, t.text) for t in got[c].turns] == turns
        assert got[c].loss == "".join(t for role, t in turns if role == "assistant")
        assert len(got[c].examples) == sum(role == "assistant" for role, _ in turns) + (turns[-1][0] != "assistant")
        for text in (got[c].text,):
            controls = re.findall("|".join(map(re.escape, prefix_targets.CONTROLS)), text)
            assert len(controls) == 2 * len(turns) + sum(role.count("\n") for role, _ in turns)


def test_an_example_is_all_before_one_reply(spark):
    rows = [(1, 0, "user", "q1"), (1, 1, "assistant", "a1"), (1, 2, "user", "q2"), (1, 3, "assistant", "a2"), (1, 4, "user", "q3")]
    got = prefix_targets.texts(chats(spark, rows)).orderBy("example").collect()
    part = [f"<|turn|>{role}\n{text}<|end|>\n" for _, _, role, text in rows]
    assert [r.text for r in got] == ["".join(part[:2]), "".join(part[:4]), "".join(part)]
    assert [r.text[r.loss_start : r.loss_end] for r in got] == ["a1", "a2", ""]


def test_registered_chat_digests(spark):
    got = {r.conv_id: r for r in QUERIES["op2_chat_formatting"](spark, "/root/testdata/sf0.001").collect()}
    ok = "</s>[INST] ok [/INST]"
    assert got[-1].loss_sha256 == hashlib.sha256(ok.encode()).hexdigest() and got[-1].loss_chars == len(ok)
    assert got[-1].turns_sha256 == hashlib.sha256(f"user\n{ok}\nassistant\n{ok}\n".encode()).hexdigest()


def test_the_query_formats_every_example(spark, tmp_path):
    """Digests from the literal examples of hand-made conversations, one of them long."""
    rows = [(1, i, ("user", "assistant")[i % 2], t) for i, t in enumerate(NASTY)] + [(2, 0, "user", None), (2, 1, "user", "no reply")]
    rows += [(3, i, ("user", "assistant")[i % 2], f"turn {i} " * 20) for i in range(400)] + [(None, 0, "assistant", "a"), (None, 1, "user", "q")]
    chats(spark, rows).select("conv_id", "turn", "role", "text").repartition(3).write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r.conv_id: r for r in QUERIES["op2_chat_formatting"](spark, str(tmp_path)).collect()}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    examples = defaultdict(list)
    for r in prefix_targets.texts(chats(spark, rows)).collect():
        examples[r.conv_id].append(r.text)
    assert set(got) == {1, 2, 3, None, -1} and len(examples[3]) == 200
    for c, texts in examples.items():
        mine = [(role, text or "") for conv, _, role, text in rows if conv == c]
        loss = "".join(t for role, t in mine if role == "assistant")
        assert tuple(got[c])[1:] == (
            len(mine), sha("".join(f"{role}\n{t}\n" for role, t in mine)), len(loss), sha(loss), sum(map(len, texts)),
        )


def test_no_conversations(spark):
    assert prefix_targets.formatted(chats(spark, [])).count() == 0


# Vector search ---------------------------------------------------------------------------

VECTORS = "vec_id long, embedding array<float>, vector string, block int, asked string"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, "v", 1, "a") for i, v in rows], VECTORS)


def exact(rows, wanted, k):
    """Neighbours by comparing all, from (id, vector) rows that take part."""
    out = set()
    for i, v in rows:
        if wanted(i):
            near = sorted(((-sum(float(a) * float(b) for a, b in zip(v, w)), j) for j, w in rows if j != i))[:k]
            out |= {(i, n, j, -s) for n, (s, j) in enumerate(near, 1)}
    return out


def floats(values):
    return [None if x is None else float(np.float32(x)) for x in values]


def test_odd_vectors(spark):
    rng = np.random.default_rng(2)
    good = [(i, floats(rng.normal(size=6) * rng.random() * 5)) for i in range(40)] + [(50 + i, floats([1, 2, 3, 4, 5, 6])) for i in range(30)]
    bad = [(100, None), (105, floats([0] * 6)), (110, floats([1, None, 1, 1, 1, 1])), (115, floats([1, float("nan"), 0, 0, 0, 0])),
           (120, floats([float("inf")] * 6)), (125, floats([1, 2])), (None, floats([1] * 6)), (130, [])]
    rows = vectors(spark, good + bad + good[:3]).repartition(4)
    got = multi_index.neighbours(rows, F.col("vec_id") % 5 == 0, 7, radius=0).collect()  # all searched again without a radius
    assert {(r.query_id, r.rank, r.vec_id, r.score) for r in got} == exact(good, lambda i: i % 5 == 0, 7)
    few = multi_index.neighbours(vectors(spark, good[:4] + bad), F.col("vec_id") >= 0, 20).collect()
    assert {(r.query_id, r.rank, r.vec_id, r.score) for r in few} == exact(good[:4], lambda i: True, 20)
    assert multi_index.neighbours(vectors(spark, bad[:5]), F.col("vec_id") >= 0, 20).count() == 0
    assert multi_index.neighbours(vectors(spark, []), F.col("vec_id") >= 0, 20).count() == 0


def test_ids_that_repeat_with_unlike_vectors(spark):
    rng = np.random.default_rng(8)
    one = [(i, floats(rng.normal(size=5))) for i in range(30)]
    again = [(i, floats(rng.normal(size=5))) for i in (0, 0, 3, 7, 10)] + [(10, floats([9.0, 0, 0, 0])), (12, floats([-9.0] * 4))]
    rows = one + again
    usable = [(i, v) for i, v in rows if len(v) == 5]
    got = multi_index.neighbours(vectors(spark, rows + rows[:4]).repartition(3), F.col("vec_id") % 5 == 0, 6, radius=256).collect()
    want = set()
    for i in range(0, 30, 5):
        asked = min(v for j, v in usable if j == i)
        near = sorted((-sum(float(a) * float(b) for a, b in zip(asked, v)), j) for j, v in usable if (j, v) != (i, asked))[:6]
        want |= {(i, n, j, -s) for n, (s, j) in enumerate(near, 1)}
    assert {(r.query_id, r.rank, r.vec_id, r.score) for r in got} == want


@pytest.mark.parametrize("rows_a_cell, queries_a_cell", [(64, 7), (100, 1000), (7, 3)])
def test_many_cells_find_what_one_finds(spark, monkeypatch, rows_a_cell, queries_a_cell):
    rng = np.random.default_rng(4)
    data = [(i, floats(rng.normal(size=8))) for i in range(400)]
    find = lambda: {tuple(r) for r in multi_index.neighbours(vectors(spark, data), F.col("vec_id") % 10 == 0, 5).collect()}
    one = find()
    monkeypatch.setattr(multi_index, "ROWS", rows_a_cell)
    monkeypatch.setattr(multi_index, "QUERIES", queries_a_cell)
    assert find() == one


def test_recall_with_many_cells(spark, monkeypatch):
    monkeypatch.setattr(multi_index, "ROWS", 256)
    monkeypatch.setattr(multi_index, "QUERIES", 32)
    sf = "/root/testdata/sf0.1"
    x = {r.vec_id: np.array(r.embedding, float) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()}
    ids = np.array(sorted(x))
    all_ = np.stack([x[i] for i in ids])
    found = {}
    for r in QUERIES["op8_nearest"](spark, sf).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    hits = 0
    for i in ids[ids % 20 == 0]:
        dots = all_ @ x[i]
        dots[ids == i] = -np.inf
        hits += len(found[i] & set(ids[np.argsort(-dots)[:20]].tolist()))
    assert hits >= 0.9 * 20 * (ids % 20 == 0).sum()


def test_recall(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    got = {(r.query_id, r.vec_id) for r in QUERIES["op8_nearest"](spark, sf).collect()}
    want = {(i, j) for i, _, j, _ in exact(rows, lambda i: i % 20 == 0, 20)}
    assert len(got) == len(want) and len(got & want) >= 0.9 * len(want)


@pytest.mark.parametrize("radius", [0, 15, 16, 40, 100, 256])
def test_probing_retrieves_every_code_within_the_radius(radius):
    rng = np.random.default_rng(radius)
    rows = rng.integers(0, 2**16, (300, 16), dtype=np.uint16)
    queries = rows[:40].copy()
    for i in range(40):
        for bit in rng.integers(0, 256, i * 3):
            queries[i, bit // 16] ^= np.uint16(1 << (bit % 16))
    apart = multi_index.distances(queries, rows)
    want = set(zip(*map(np.ndarray.tolist, np.where(apart <= radius))))
    found = list(zip(*map(np.ndarray.tolist, multi_index.probe(queries, rows, radius))))
    assert len(found) == len(want) and set(found) == want
