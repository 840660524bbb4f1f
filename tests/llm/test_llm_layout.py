import zlib
from collections import defaultdict

import odd
import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from wordloom.llm import sharding, url_filter
from wordloom.llm.queries import QUERIES
from wordloom.session import shared_folder


# Resharding.


@given(st.lists(st.integers(0, 100), min_size=2, max_size=6), st.data())
def test_transfers_move_the_fewest_bytes(sizes, data):
    targets = sharding.capacities(sum(sizes), len(sizes))
    moves = sharding.transfers(sizes, targets)
    after = list(sizes)
    for (i, j), amount in moves.items():
        after[i] -= amount
        after[j] += amount
    assert after == targets
    assert sum(moves.values()) == sum(max(0, s - t) for s, t in zip(sizes, targets))


@given(
    st.lists(st.integers(0, 4), min_size=2, max_size=3),
    st.lists(st.lists(st.integers(0, 9), min_size=3, max_size=3), min_size=3, max_size=3),
)
def test_flow_is_the_cheapest(supply, cost):
    demand = sharding.capacities(sum(supply), 3)
    supply = supply + [0] * (3 - len(supply))
    flow = sharding.cheapest_flow(supply, demand, cost)

    def best(i, left):
        if i == 3:
            return 0 if not any(left) else float("inf")
        found = float("inf")
        for a in range(min(supply[i], left[0]) + 1):
            for b in range(min(supply[i] - a, left[1]) + 1):
                c = supply[i] - a - b
                if c <= left[2]:
                    rest = best(i + 1, (left[0] - a, left[1] - b, left[2] - c))
                    found = min(found, a * cost[i][0] + b * cost[i][1] + c * cost[i][2] + rest)
        return found

    assert sum(cost[i][j] * n for (i, j), n in flow.items()) == best(0, tuple(demand))


def check_shards(rows, out, shards):
    texts = defaultdict(list)
    for i, t in rows:
        texts[i].append((t or "").encode())
    places, bytes_ = defaultdict(list), defaultdict(int)
    for r in out:
        assert (r.size, r.text_crc32) in {(len(t) + 1, zlib.crc32(t)) for t in texts[r.doc_id]}
        places[r.shard].append(r.slot)
        bytes_[r.shard] += r.size
    assert len(out) == len(rows)
    assert all(sorted(own) == list(range(len(own))) for own in places.values())
    return [bytes_[i] for i in range(shards)]


def test_shards_of_odd_texts(spark):
    rows = [*odd.TEXTS, (3, "word"), (None, "x"), (None, None)]
    docs = odd.documents(spark, rows, **odd.CLASHES)
    check_shards(rows, sharding.reshard(docs, F.lit(0), 4).collect(), 4)
    empty = odd.documents(spark, [])
    assert sharding.reshard(empty, F.lit(0)).collect() == []


def test_shards_are_equal_and_little_moves(spark, sf_dir):
    rows = [(i, "x" * (i * 37 % 200)) for i in range(3000)]
    old = F.when(F.col("doc_id") % 3 == 0, 0).otherwise(F.col("doc_id") % 8)
    out = sharding.reshard(odd.documents(spark, rows), old, 8).collect()
    bytes_ = check_shards(rows, out, 8)
    total = sum(bytes_)
    assert max(bytes_) - min(bytes_) <= 2 * 201
    before = [sum(r.size for r in out if r.old_shard == i) for i in range(8)]
    moved = sum(r.size for r in out if r.shard != r.old_shard)
    least = sum(max(0, b - total // 8) for b in before)
    assert abs(moved - least) <= 8 * 201


def test_rewriting_touches_only_blocks_that_lose_rows(spark):
    docs = odd.documents(spark, [(i, "x" * (i % 50)) for i in range(500)])
    placed = sharding.reshard(docs, F.when(F.col("doc_id") < 300, 0).otherwise(1), 3, blocks=8).cache()
    folder = shared_folder(spark, "test-shards")
    sharding.rewrite_affected(docs, placed, folder)
    changed = {(r.old_shard, r.block) for r in placed.collect() if r.shard != r.old_shard}
    want = {(r.doc_id, r.shard) for r in placed.collect() if (r.old_shard, r.block) in changed}
    got = {(r.doc_id, r.shard) for r in spark.read.parquet(folder).collect()}
    assert got == want and len(got) < 500


def test_every_row_of_an_affected_block_is_written(spark):
    rows = [(i, "x" * (i % 50)) for i in range(300)] + [(None, "y" * 20)] * 40 + [(7, "twice")] * 2
    docs = odd.documents(spark, rows, **odd.CLASHES)
    folder = shared_folder(spark, "test-shards")
    out = sharding.reshard_and_rewrite(docs, F.lit(5), folder, 3, blocks=4, shares=[1, 2, 1]).collect()
    bytes_ = check_shards(rows, out, 3)
    total = sum(bytes_)
    assert all(abs(b - total * share / 4) <= 100 for b, share in zip(bytes_, [1, 2, 1]))
    got = [(r.document.doc_id, r.document.text, r.shard, r.slot) for r in spark.read.parquet(folder).collect()]
    assert sorted(((i, t) for i, t, *_ in got), key=str) == sorted(rows, key=str)
    places = [(r.doc_id, r.shard, r.slot) for r in out]
    assert sorted(((i, s, n) for i, _, s, n in got), key=str) == sorted(places, key=str)
    placed = sharding.reshard(docs.select("doc_id", "text"), F.lit(5), 3, blocks=4).cache()
    folder = shared_folder(spark, "test-shards")
    sharding.rewrite_affected(docs.select("doc_id", "text"), placed, folder)
    assert sorted(((r.doc_id, r.text) for r in spark.read.parquet(folder).collect()), key=str) == sorted(rows, key=str)


@given(
    st.lists(st.tuples(st.integers(0, 3), st.integers(0, 9), st.integers(1, 50)), unique_by=lambda b: b[:2]),
    st.integers(1, 100),
)
def test_bundles_hold_the_losing_blocks_of_one_shard(blocks, most):
    plan = sharding.targets_of_blocks(blocks, sharding.capacities(sum(b[2] for b in blocks), 3))
    out = sharding.bundles(blocks, plan, most)
    sizes, last = {b[:2]: b[2] for b in blocks}, {(o, b): here[-1][1] for o, b, here in plan}
    assert out.keys() == {(o, b) for o, b, here in plan if {shard for _, shard in here} != {o}}
    held = defaultdict(list)
    for at, number in out.items():
        held[number].append(at)
    assert sorted(held) == list(range(len(held)))
    for own in held.values():
        assert len({last[at] for at in own}) == 1
        assert len(own) == 1 or sum(sizes[at] for at in own) <= most


def test_a_shard_is_written_in_few_files(spark):
    rows = [(i, "x" * (i % 50)) for i in range(2000)] + [(None, "y" * 20)] * 40
    docs = odd.documents(spark, rows)
    folder, merge = shared_folder(spark, "test-shards"), "spark.sql.adaptive.coalescePartitions.enabled"
    kept = spark.conf.get(merge)
    spark.conf.set(merge, "false")
    try:
        out = sharding.reshard_and_rewrite(docs, F.lit(0), folder, 4)
        files = out.inputFiles()
        bytes_ = check_shards(rows, out.collect(), 4)
    finally:
        spark.conf.set(merge, kept)
    assert max(bytes_) - min(bytes_) <= 2 * 50
    written = [name for name in files if "/test-shards-" in name]
    # One file for each shard, and one more for each of the three cuts.
    assert written and len(written) <= 4 + 3


def test_the_query_writes_its_shards(spark, sf_dir):
    out = QUERIES["op4_sharding"](spark, sf_dir)
    assert any("/new-shards-" in name for name in out.inputFiles())


# Urls.

URLS = [
    (0, None),
    (1, ""),
    (2, "no scheme/en/"),
    (3, "http://Example.COM/en/1"),
    (4, "http://www.example.com/en/1"),
    (5, "http://a.www.example.com/en/?x=/fr/"),
    (6, "http://example.com/de/1#://b.net/es/"),
    (7, "http://x.net/es/1"),
    (8, "http://net/fr/"),
    (9, "http://x.net/en/1"),
    (10, "http://x.org/en/1"),
    (11, "http://com"),
    (12, "http://com?x"),
    (13, "https://other.net/en/1"),
    (14, "ftp://y.org"),
]


def brute_rule(url, rules):
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    cut = min((rest.index(c) for c in "/?#" if c in rest), default=len(rest))
    host, tail = rest[:cut], rest[cut:]
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    path = tail[: min((tail.index(c) for c in "?#" if c in tail), default=len(tail))]
    fits = [
        r for r in rules
        if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])
    ]
    best = max(fits, key=lambda r: len(r[0] + r[1]), default=None)
    return host, path, best


def pages(spark, rows, html=None, **extra):
    frame = spark.createDataFrame(
        [(i, u, (html or {}).get(i)) for i, u in rows], "page_id long, url string, html string"
    )
    for name, value in extra.items():
        frame = frame.withColumn(name, F.lit(value))
    return frame


def test_rules(spark):
    rows = [*URLS, (3, URLS[3][1]), (None, "http://x.net/es/1")]
    clashes = {k: v for k, v in odd.CLASHES.items()}
    out = url_filter.judge(pages(spark, rows, **clashes)).collect()
    got = sorted((r.page_id is None, r.page_id or 0, r.host, r.path, r.rule or "", r.verdict) for r in out)
    want = []
    for i, url in rows:
        host, path, rule = brute_rule(url, url_filter.RULES)
        verdict = rule[2] if rule else None
        want.append((i is None, i or 0, host, path, rule[0] + rule[1] if rule else "", verdict))
    for mine, theirs in zip(got, sorted(want, key=lambda r: r[:5]), strict=True):
        assert mine[:5] == theirs[:5]
        assert theirs[5] is None or mine[5] == theirs[5]
    assert url_filter.judge(pages(spark, [])).collect() == []


def brute_ranks(seeds, edges, damping, rounds):
    hosts = {h for h, _, _ in seeds} | {h for e in edges for h in e[:2]}
    out = {}
    for kind, at in (("trust", 1), ("distrust", 2)):
        total = sum(s[at] for s in seeds) or 1
        own = {s[0]: s[at] / total for s in seeds}
        steps = defaultdict(list)
        for a, b, w in edges:
            source, end = (a, b) if kind == "trust" else (b, a)
            steps[source].append((end, w))
        rank = dict(own)
        for _ in range(rounds):
            new = {h: (1 - damping) * own.get(h, 0) for h in hosts}
            for h, r in rank.items():
                weight = sum(w for _, w in steps[h])
                for end, w in steps[h]:
                    new[end] += damping * r * w / weight
            rank = new
        out[kind] = rank
    return out


def test_propagation(spark):
    seeds = [("a", 3.0, 0.0), ("b", 1.0, 0.0), ("c", 0.0, 2.0)]
    edges = [("a", "b", 2.0), ("a", "d", 1.0), ("d", "c", 1.0), ("b", "a", 1.0), ("e", "c", 3.0), ("f", "e", 1.0)]
    got = url_filter.propagate(
        spark.createDataFrame(seeds, "host string, trusted double, blocked double"),
        spark.createDataFrame(edges, "source string, target string, weight double"),
    )
    want = brute_ranks(seeds, edges, url_filter.DAMPING, url_filter.ROUNDS)
    rows = {r.host: r for r in got.collect()}
    for kind in ("trust", "distrust"):
        for host, value in want[kind].items():
            assert (getattr(rows[host], kind) if host in rows else 0) == pytest.approx(value)


def test_links_decide_where_no_rule_does(spark):
    rows = [(1, "http://good.com/x"), (2, "http://bad.net/es/"), (3, "http://friend.org/"), (4, "http://spam.org/")]
    html = {
        1: '<a href="http://friend.org/y">f</a> <a href="/local">l</a>',
        4: "<a href='https://BAD.net/es/1'>b</a><img src=//cdn.org/x>",
    }
    out = {r.page_id: r.verdict for r in url_filter.judge(pages(spark, rows, html)).collect()}
    assert out == {1: "allow", 2: "block", 3: "allow", 4: "block"}


def test_distrust_goes_back_over_long_ways(spark):
    rows = [(i, f"http://h{i}.org/") for i in range(14)] + [(14, "http://bad.net/es/")]
    html = {i: f'<a href="http://h{i + 1}.org/">next</a>' for i in range(13)}
    html[13] = '<a href="http://bad.net/es/1">bad</a>'
    out = {r.page_id: r.verdict for r in url_filter.judge(pages(spark, rows, html)).collect()}
    assert out == dict.fromkeys(range(15), "block")


def test_ranks_have_converged(spark):
    seeds = spark.createDataFrame([("a", 1.0, 0.0), ("z", 0.0, 1.0)], "host string, trusted double, blocked double")
    edges = [("a", "b", 1.0), ("b", "a", 1.0), ("b", "z", 1e-3)]
    edges = spark.createDataFrame(edges, "source string, target string, weight double")
    rows = {r.host: r for r in url_filter.propagate(seeds, edges).collect()}
    d, share = url_filter.DAMPING, 1 / 1.001
    assert rows["a"].trust == pytest.approx((1 - d) / (1 - d * d * share), abs=1e-9)
    assert rows["b"].distrust == pytest.approx(d * (1 - d) / (1 - d * d), abs=1e-9)


def test_links_without_a_scheme_and_far_parents(spark):
    html = {1: '<a href="//Bad.net/es/">b</a><img src=//cdn.org/x><a href="/local//x.org">l</a>'}
    edges = url_filter.link_edges(pages(spark, [(1, "http://spam.org/")], html)).collect()
    assert {(r.source, r.target) for r in edges} == {("spam.org", "bad.net"), ("spam.org", "cdn.org")}


def test_domains_are_nodes(spark):
    hosts = spark.createDataFrame([("www.a.ex.org",), ("b.ex.org",), ("ex.org",), ("10.0.0.1:80",), ("",)], "host string")
    edges = {(r.source, r.target) for r in url_filter.family_edges(hosts).collect()}
    up = {("www.a.ex.org", "a.ex.org"), ("a.ex.org", "ex.org"), ("b.ex.org", "ex.org")}
    assert edges == up | {(b, a) for a, b in up}


def test_hubs_are_cut(spark, monkeypatch):
    monkeypatch.setattr(url_filter, "ENDS_PER_COPY", 3)
    seeds = [(f"s{i}", float(i % 2), float(i % 2 == 0)) for i in range(10)]
    edges = [(f"s{i}", "hub", 1.0) for i in range(10)] + [("hub", f"s{i}", 1.0) for i in range(8)]
    got = url_filter.propagate(
        spark.createDataFrame(seeds, "host string, trusted double, blocked double"),
        spark.createDataFrame(edges, "source string, target string, weight double"),
        tolerance=1e-2,
    )
    want = brute_ranks(seeds, edges, url_filter.DAMPING, url_filter.ROUNDS)
    for r in got.collect():
        for kind in ("trust", "distrust"):
            assert getattr(r, kind) == pytest.approx(want[kind][r.host], abs=1e-2)


def test_given_pages_are_judged_by_their_graph(spark, sf_dir):
    given = spark.read.parquet(f"{sf_dir}/pages.parquet")
    judged = url_filter.judge(given).collect()
    nothing = spark.createDataFrame([], "source string, target string, weight double")
    alone = {r.page_id: r.verdict for r in url_filter.judge(given, edges=nothing).collect()}
    assert any(alone[r.page_id] != r.verdict for r in judged)
    seeds, edges = {}, set()
    for r in judged:
        kind = next((v for h, p, v in url_filter.RULES if h + p == r.rule), None)
        good, bad = seeds.get(r.host, (0.0, 0.0))
        seeds[r.host] = (good + (kind == "allow"), bad + (kind == "block"))
        labels = r.host.split(".")
        for i in range(len(labels) - 2):
            pair = ".".join(labels[i:]), ".".join(labels[i + 1 :])
            edges |= {pair, pair[::-1]}
    want = brute_ranks([(h, *s) for h, s in seeds.items()], [(a, b, 1.0) for a, b in edges], url_filter.DAMPING, 200)
    for r in judged:
        trust, distrust = (want[k].get(r.host, 0.0) for k in ("trust", "distrust"))
        assert (r.trust, r.distrust) == (pytest.approx(trust, abs=1e-8), pytest.approx(distrust, abs=1e-8))
        if r.rule is None:
            assert r.verdict == ("block" if distrust > trust else "allow")
