"""Mixing, top-k, decontamination, archives: brute force, round trips and odd rows."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from hearthline.llm import decontaminate, mixing, topk, warc
from tests.llm.conftest import plain, prose, spaced


def water(sizes: dict, weights=(3, 1, 2), budget=1.5, cap=2.0):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, done = budget * sum(sizes.values()), {}
    while len(done) < len(names):
        left = [s for s in names if s not in done]
        level = (total - sum(done.values())) / sum(weight[s] for s in left)
        over = [s for s in left if level * weight[s] > cap * sizes[s]]
        if not over:
            return {**done, **{s: level * weight[s] for s in left}}
        done |= {s: cap * sizes[s] for s in over}
    return done


def mix_rows():
    r = random.Random(1)
    rows = [(i, r.choice(["b", "a", "é", "Z", None, "hot", "hot", "hot"]), prose(r, int(r.paretovariate(1)) % 900 + 1)) for i in range(400)]
    return rows + [(900, "a", None), (901, "only empty", ""), (902, "tiny", "one"), (3, rows[3][1], rows[3][2]), (None, "b", "x y z")]


def test_mix_meets_its_targets(frame):
    rows = mix_rows()
    docs = frame([(*x, 1) for x in rows], "doc_id long, source string, text string, size int")
    got = mixing.mix(docs).collect()
    assert len(got) == len(rows)
    sizes: dict = {}
    for _, s, t in rows:
        sizes[s] = sizes.get(s, 0) + len(spaced(t))
    want = water(sizes)
    by: dict = {}
    for x in got:
        assert x.source_size == sizes[x.source] and x.target == pytest.approx(want[x.source])
        assert x.taken == x.copies * x.size <= 2 * x.size
        by[x.source] = by.get(x.source, 0) + x.taken
    assert all(abs(by[s] - want[s]) <= max(3, 0.02 * want[s]) for s in want)
    again = mixing.mix(docs.repartition(7)).collect()
    key = lambda x: (str(x.id), str(x.source), x.size, x.taken)
    assert sorted(map(key, got)) == sorted(map(key, again))


def test_mix_rates_are_exponential_tilts(frame):
    docs = frame(mix_rows(), "doc_id long, source string, text string")
    for source, rows in ((s, list(g)) for s, g in _by_source(mixing.mix(docs).collect())):
        free = [x for x in rows if x.size and x.rate < 2]
        slopes = [np.log(x.rate) / x.size for x in free]
        assert np.ptp(slopes) < 1e-9 if slopes else True, source
        assert sum(x.rate * x.size for x in rows) == pytest.approx(rows[0].target, rel=1e-5, abs=1e-6)


def _by_source(rows):
    by: dict = {}
    for x in rows:
        by.setdefault(x.source, []).append(x)
    return by.items()


def test_repeat_gives_the_copies(frame):
    docs = frame([(*x, 9) for x in mix_rows()], "doc_id long, source string, text string, copy int")
    copies = {(x.id, x.size): x.copies for x in mixing.mix(docs).collect()}
    rows = mixing.repeat(docs).collect()
    assert set(rows[0].asDict()) == {"doc_id", "source", "text", "copy"}
    for (id, size), n in copies.items():
        own = [x.copy for x in rows if x.doc_id == id and len(spaced(x.text)) == size]
        assert sorted(set(own)) == list(range(1, n + 1))
    assert mixing.repeat(docs.limit(0)).collect() == mixing.mix(docs.limit(0)).collect() == []


def best(rows, query, k):
    (own,) = {tuple(v) for i, v in rows if i == query}
    scores = sorted((-int(np.dot(own, v)), i) for i, v in rows if i != query and len(v) == len(own))
    return [(-s, i) for s, i in scores[:k]]


@pytest.mark.parametrize("settings", [topk.Settings(), topk.Settings(k=3, leaf=2, shard=40, block=4, first_part=3)])
def test_top_k_is_exact(frame, settings):
    r = np.random.default_rng(2)
    rows = [(i, r.integers(-9, 10, 5).tolist()) for i in range(0, 300, 3)] + [(i, [1, 1, 1, 1, 1]) for i in range(1, 60, 3)]
    rows += [(1000, [1, 2]), (1002, [3, -4])]
    vectors = frame(rows, "vec_id long, v array<long>")
    got = topk.top_k(vectors, F.col("vec_id") % 10 == 0, "vec_id", F.col("v"), settings).collect()
    for q in {i for i, _ in rows if i % 10 == 0}:
        mine = sorted((x.rank, x.score, x.id) for x in got if x.query == q)
        assert [(s, i) for _, s, i in mine] == best(rows, q, settings.k)
        assert [n for n, _, _ in mine] == list(range(1, len(mine) + 1))


def test_top_k_of_odd_rows(frame):
    rows = [(0, [0.5, 0.1]), (100, [float("nan"), 1.0]), (1, None), (2, [None, 1.0]), (3, [float("-inf"), 0.0]), (4, [-0.0001, 0.9999]), (None, [1.0, 1.0]), (0, [0.5, 0.1])]
    vectors = frame(rows, "vec_id long, embedding array<float>")
    got = topk.top_k(vectors, F.col("vec_id") % 100 == 0, "vec_id", topk.quantised("embedding")).collect()
    assert [(x.query, x.rank, x.id, x.score) for x in got] == [(0, 1, 4, 512 * -1 + 102 * 1023)]
    assert topk.top_k(vectors.limit(0), F.lit(True), "vec_id", topk.quantised("embedding")).collect() == []


def test_tree_boxes_are_tight_and_bound_scores():
    r = np.random.default_rng(3)
    vectors = np.floor(r.normal(0, 50, (500, 6)))
    tree, queries = topk.Tree(vectors, 20), np.floor(r.normal(0, 50, (30, 6)))
    assert sorted(tree.order.tolist()) == list(range(500))
    for node, (a, b) in enumerate(tree.span):
        inside = vectors[tree.order[a:b]]
        assert (inside.min(axis=0) == tree.low[node]).all() and (inside.max(axis=0) == tree.high[node]).all()
        assert (tree.bounds(queries, node) >= (queries @ inside.T).max(axis=1)).all()


def contamination(docs, items, window=10):
    windows: dict = {}
    for i, t in items:
        w = plain(t)
        for a in range(max(1, len(w) - window + 1) if w else 0):
            windows.setdefault(tuple(w[a : a + window]), set()).add("" if i is None else str(i))
    out = []
    for d, t in docs:
        w, hit, found = plain(t), set(), set()
        for n in {len(x) for x in windows}:
            for a in range(len(w) - n + 1):
                if tuple(w[a : a + n]) in windows:
                    hit |= set(range(a, a + n))
                    found |= windows[tuple(w[a : a + n])]
        out.append((d, len(w), len(hit), sorted(found)))
    return out


@pytest.mark.parametrize("block", [200_000, 7])
def test_windows_are_found_exactly(frame, block):
    r = random.Random(4)
    items = [(i, prose(r, r.randrange(1, 30), 50)) for i in range(20)] + [(20, None), (21, "!?"), (None, "null id here"), (1, "w1"), (22, "Tail-Words")]
    docs = []
    for i in range(60):
        parts = [prose(r, r.randrange(0, 40), 50)]
        for _ in range(r.randrange(3)):
            parts += [r.choice(items)[1] or "", prose(r, 3, 50)]
        docs.append((i, ", ".join(parts).upper() if i % 7 == 0 else "  ".join(parts)))
    docs += [(70, None), (71, ""), (72, "tail words"), (72, "tail words"), (None, "a null id here"), (73, "w1 " * 30_000)]
    table = frame([(*x, "n_hit") for x in docs], "doc_id long, text string, items string")
    bench = frame([(*x, 0) for x in items], "item_id long, text string, doc_id int")
    settings = decontaminate.Settings(block_windows=block)
    got = decontaminate.decontaminate(table, bench, keep=["doc_id", "items"], settings=settings).collect()
    assert sorted(map(str, ((x.doc_id, x.n_words, x.n_hit, x["items"]) for x in got))) == sorted(map(str, contamination(docs, items)))
    kept = decontaminate.decontaminate(table, bench, keep=table.columns, settings=settings, prefix="__")
    assert set(table.columns) < set(kept.columns) and kept.where("__n_hit > 0").count() == sum(x.n_hit > 0 for x in got)


def test_no_windows_and_no_documents(frame):
    docs, none = frame([(1, "a b"), (2, None)], "doc_id long, text string"), frame([], "item_id long, text string")
    assert [(x.n_words, x.n_hit, x["items"]) for x in decontaminate.decontaminate(docs, none, ["doc_id"]).collect()] == [(2, 0, []), (0, 0, [])]
    items = frame([(1, "a b")], "item_id long, text string")
    assert decontaminate.decontaminate(docs.limit(0), items, ["doc_id"]).collect() == []


def pages():
    r = random.Random(5)
    same = "<p>é " + prose(r, 40) + "</p>"
    rows = [(i, f"http://h/{i}", r.choice([same, prose(r, 60), "short"])) for i in range(40)]
    rows += [(50, None, None), (51, "http://a b/\r\nX: y", ""), (None, "u", same), (52, "é", "x" * 99), (53, "é", "x" * 99)]
    return rows + [(54, "", "y" * 100), (55, "", "y" * 100), (54, "again", "y" * 100), (60, "big", "z\r\n\r\n" * 200_000)]


def test_archives_round_trip(frame):
    rows = pages()
    table = frame([(*x, "digest") for x in rows], "page_id long, url string, html string, file string").repartition(3)
    small = warc.Settings(file_bytes=4_000, read_bytes=2_000, task_bytes=3_000)
    index = warc.write_archives(table, settings=small)
    assert index.count() == len(rows) and index.select("file").distinct().count() > 3
    got = warc.read_records(index, payload=True, settings=small).collect()
    first: dict = {}
    for i, _, h in rows:
        if i is not None:
            first[h or ""] = min(first.get(h or "", i), i)
    want = []
    for i, _, h in rows:
        body = (h or "").encode()
        later = len(body) >= 100 and i != first[h or ""]
        want.append((str(i), len(body), hashlib.sha256(body).hexdigest(), "revisit" if later else "response", str(first[h or ""]) if later else "None", None if later else body))
    assert sorted(map(str, want)) == sorted(str((str(x.id), x.payload_bytes, x.payload_digest, x.record_type, str(x.refers_to), None if x.payload is None else bytes(x.payload))) for x in got)
    urls = {(x.id, x.url) for x in got}
    assert ("50", None) in urls and ("51", "http://a%20b/%0D%0AX:%20y") in urls
    some = index.where("id in ('3', '7')")
    assert {x.id for x in warc.read_records(some).collect()} == {"3", "7"}


def test_archives_of_an_empty_table(frame):
    index = warc.write_archives(frame([], "page_id long, url string, html string"))
    assert warc.read_records(index).collect() == []


def test_reads_are_coalesced():
    rows = [(0, 10), (10, 10), (25, 5), (500, 10), (510, 1000), (1510, 1)]
    groups = list(warc.ranges(rows, warc.Settings(read_bytes=100, read_gap=10)))
    assert groups == [[(0, 10), (10, 10), (25, 5)], [(500, 10)], [(510, 1000)], [(1510, 1)]]


def test_a_broken_payload_is_noticed():
    record = warc.page_record("1", "u", b"abc", 3, hashlib.sha256(b"abc").hexdigest(), None, warc.Settings())
    assert warc.parse(record)["payload"] == b"abc"
    with pytest.raises(ValueError, match="differs"):
        warc.parse(record.replace(b"abc", b"abd"))
