"""Line runs, prefix trie, spelling variants: against plain loops on small tables."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from hearthline.llm import line_dedup, prefix_trie, spelling
from tests.llm.conftest import _LOW, spaced


# --- lines ---------------------------------------------------------------------


def left_lines(texts, least):
    cut = [[(line, line.strip(" \t\n\x0b\x0c\r").translate(_LOW)) for line in (t or "").split("\n")] for t in texts]
    held = Counter(k for lines in cut for k in {k for _, k in lines})
    out = []
    for lines in cut:
        kept = [line for line, k in lines if not k or held[k] < least]
        out.append(("\n".join(kept), len(lines), len(lines) - len(kept)))
    return out


@pytest.mark.parametrize("batches, fanout, parts", [(1, 2, 1), (4, 2, 3), (5, 3, 8)])
def test_lines_of_many_documents_go(frame, batches, fanout, parts):
    r = random.Random(batches)
    pool = [f"  Common Line {i}\t" for i in range(30)] + ["É accent", "é accent", "", "  "]
    texts = [
        "\n".join(r.choice(pool).swapcase() if r.random() < 0.2 else r.choice(pool) for _ in range(r.randrange(1, 9)))
        for _ in range(60)
    ]
    texts += [None, "", "\n", "a\n\nb\n", texts[0], texts[0], "same\nsame\nsame", "long " * 30_000 + "\n" + pool[0]]
    docs = frame(list(enumerate(texts)), "id long, text string").repartition(parts)
    settings = line_dedup.Settings(least_documents=6, batches=batches, fanout=fanout)
    got = line_dedup.drop_lines(docs, settings=settings).orderBy("id").collect()
    assert [(x.text, x.n_lines, x.n_dropped) for x in got] == left_lines(texts, 6)


def test_runs_are_compacted_and_count_each_line_once_per_batch(spark, frame):
    runs = line_dedup.Runs(spark, line_dedup.Settings(least_documents=5, fanout=2))
    want = Counter()
    for batch in range(7):
        rows = [(h, -h, 1 + (h + batch) % 3) for h in range(batch, batch + 6)]
        for h, _, n in rows:
            if want[h] < 5:
                want[h] += n
        runs.add(frame(rows, "h1 long, h2 long, n long"))
    # 7 batches in base 2: one run on each of three levels.
    assert [len(level) for level in runs.levels] == [1, 1, 1]
    got = {x.h1: x.n for x in runs.totals().collect()}
    assert set(got) == set(want) and {h for h in got if got[h] >= 5} == {h for h in want if want[h] >= 5}
    runs.close()
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("line_run_")]


def test_adding_a_batch_moves_no_rows(spark, frame):
    runs = line_dedup.Runs(spark)
    rows = [(h, h, 20) for h in range(50)]
    first = runs.write(frame(rows, "h1 long, h2 long, n long"))
    runs.add(spark.table(first))
    plan = runs.unsettled(spark.table(first))._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    assert runs.unsettled(spark.table(first)).count() == 0
    runs.close()


def test_lines_keep_other_columns_and_take_null_ids_and_empty_tables(frame):
    rows = [(None, "x\ny", 1, "row"), (7, "x", 2, "t1"), (7, "x\nz", 3, None)]
    docs = frame(rows, "id long, text string, n_lines int, `row` string").withColumn("lines", F.lit(1)).withColumn("hits", F.lit(2))
    got = line_dedup.drop_lines(docs, settings=line_dedup.Settings(least_documents=3)).collect()
    assert sorted((x.text, x.n_lines, x.n_dropped, x.row or "") for x in got) == [("", 1, 1, "t1"), ("y", 2, 1, "row"), ("z", 2, 1, "")]
    assert {"id", "lines", "hits"} <= set(got[0].asDict())
    assert line_dedup.drop_lines(docs.limit(0)).count() == 0


# --- trie ------------------------------------------------------------------------


def plain_trie(rows):
    said = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            said[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(turns)] for c, turns in said.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        head = own.get(c - (c % 20 if c >= 0 else -(-c % 20)), [])[:h]
        built[c] = head + turns[h:]
    members = defaultdict(list)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += children[p] == 0
            saved[p[:d]] += (len(m) - 1) * len(spaced(p[-1][1])) if p else 0
    out = []
    for p, m in members.items():
        ends = ",".join(str(c) for c in sorted(m) if len(built[c]) == len(p))
        up = min(members[p[:-1]]) if p else None
        out.append((min(m), len(p), up, len(m), children[p], leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def trie_rows(convs, settings=prefix_trie.Settings()):
    source, length = F.col("conv_id") - F.col("conv_id") % 20, F.crc32(F.col("conv_id").cast("string")) % 4
    found = prefix_trie.trie(prefix_trie.with_heads(prefix_trie.sequences(convs), source, length, 3), settings)
    return sorted((tuple(x) for x in found.collect()), key=str)


def talks(seed, convs, words):
    r = random.Random(seed)
    rows = []
    for c in range(convs):
        for t in range(r.choice([0, 1, 2, 3, 5, 9])):
            rows.append((c, t, r.choice(["user", "assistant", None]), " ".join(r.choice(words) for _ in range(r.randrange(3)))))
    return rows


TURNS = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("seed, steps, pieces", [(1, 1_000_000, 512), (2, 40, 2), (3, 7, 1)])
def test_trie_is_that_of_plain_loops_whatever_the_shards(frame, seed, steps, pieces):
    rows = talks(seed, 150, ["a", "b"])
    # Many copies of one conversation, a long one and one that shares most of it, a null turn, a negative id.
    rows += [(c, t, "user", "hot one") for c in range(1000, 1090) for t in range(4)]
    rows += [(c, t, "user", f"step {t % 5}") for c in (2000, 2021) for t in range(300 + c % 20)]
    rows += [(3000, None, "user", "first"), (3000, 0, "user", "then"), (-7, 0, "user", "x"), (None, 0, "user", "nobody"), (3100, 0, None, None)]
    convs = frame(rows, TURNS).repartition(5)
    assert trie_rows(convs, prefix_trie.Settings(steps_per_shard=steps, ids_per_piece=pieces)) == plain_trie(rows)


def test_trie_of_odd_tables(frame):
    assert prefix_trie.trie(prefix_trie.sequences(frame([], TURNS))).count() == 0
    rows = [(1, 0, "u", "long " * 50_000), (2, 0, "u", "long " * 50_000), (2, 0, "u", "long " * 50_000)]
    assert trie_rows(frame(rows, TURNS).withColumn("steps", F.lit(1)).withColumn("w", F.lit(2))) == plain_trie(rows)


def test_extents_by_sparse_table():
    r = np.random.default_rng(5)
    for n in (1, 2, 3, 17, 64, 100):
        values = r.integers(0, 5, n)
        values[0] = -1
        table = prefix_trie.Minima(values)
        for i, depth in itertools.product(range(n), range(5)):
            right = i
            while right + 1 < n and values[right + 1] >= depth:
                right += 1
            left = i
            while left > 0 and values[left] >= depth:
                left -= 1
            at, deep = np.array([i]), np.array([depth])
            assert table.right(at, deep)[0] == right and table.left(at, deep)[0] == left
            assert table.least(np.array([left]), np.array([right]))[0] == values[left : right + 1].min()


# --- spelling --------------------------------------------------------------------


def plain_vocabulary(rows):
    n = Counter()
    for id, text in rows:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(_LOW)
            h = zlib.crc32(f"{'' if id is None else id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= 7 and c >= 2}


def one_apart(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_variants(n):
    near = {w: [v for v in n if v != w and abs(len(v) - len(w)) <= 1 and one_apart(v, w)] for w in n}
    form = {}
    for w, vs in near.items():
        if vs and n[best := min(vs, key=lambda v: (-n[v], v))] >= 10 * n[w]:
            form[w] = best
    out = {}
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out[w] = (n[w], len(near[w]), form.get(w), n.get(form.get(w)), root)
    return out


def found_variants(vocab, settings=spelling.Settings()):
    rows = spelling.variants(vocab, settings).collect()
    return {x.word: (x.n, x.n_near, x.form, x.form_n, x.root) for x in rows}


def misspelt(seed, words):
    r = random.Random(seed)
    letters = "abcdeéàÿz"
    base = ["".join(r.choice(letters) for _ in range(r.randrange(7, 11))) for _ in range(words)]
    n = {}
    for w in base:
        n[w] = r.choice([2, 30, 400, 5000])
        for _ in range(r.randrange(4)):
            i, kind = r.randrange(len(w)), r.randrange(3)
            v = [w[:i] + w[i + 1 :], w[:i] + r.choice(letters) + w[i:], w[:i] + r.choice(letters) + w[i + 1 :]][kind]
            if len(v) >= 7:
                n.setdefault(v, r.choice([2, 3, 40]))
    return n


@pytest.mark.parametrize("shard, leaf, block", [(20_000, 24, 512), (40, 3, 7), (15, 1, 64)])
def test_variants_are_those_of_plain_loops_whatever_the_shards(frame, shard, leaf, block):
    n = misspelt(leaf, 250)
    # A third of all words are one word in other orders: no plane parts them.
    r = random.Random(1)
    for _ in range(150):
        n.setdefault("".join(r.sample("abcdeez", 7)), r.choice([2, 20, 300]))
    n |= {"xxxxxxx" * 60: 50, "xxxxxxx" * 60 + "y": 5, "qqqqqqq": 7, "wwwwwwww" * 3: 2}
    settings = spelling.Settings(shard=shard, leaf=leaf, block=block)
    assert found_variants(frame(list(n.items()), "word string, n long"), settings) == plain_variants(n)


def test_large_groups_of_equal_letters_are_matched_whole(monkeypatch, frame):
    monkeypatch.setattr(spelling, "MANY", 4)
    n = {"".join(p): 2 + i % 40 for i, p in enumerate(itertools.permutations("abcde"))}
    n |= {w + x: 3 for w, x in itertools.product(list(n), "fg")}
    words = list(n)
    code, starts = spelling.letters(pa.array(words))
    by = {size: np.array([i for i, w in enumerate(words) if len(w) == size]) for size in (5, 6)}
    rows = {s: np.stack([code[starts[i] : starts[i + 1]] for i in at]) for s, at in by.items()}
    f, g = (np.array([i for i in range(len(by[6])) if words[by[6][i]][-1] == x]) for x in "fg")
    for a, b, ia, ib in ((rows[5], rows[6], by[5], by[6]), (rows[6][f], rows[6][g], by[6][f], by[6][g])):
        i, j = spelling.matched(a, b)
        got = {(words[ia[x]], words[ib[y]]) for x, y in zip(i, j)}
        assert got == {(words[x], words[y]) for x, y in itertools.product(ia, ib) if one_apart(words[x], words[y])}


def test_vocabulary_of_texts(frame):
    r = random.Random(3)
    words = ["Mistakes", "mistakes", "ÉTENDUES", "étendues", "letters", "short", "naïveté×÷", "underscore_word", "abcdefgh1ijklmnop"]
    rows = [(i if i % 7 else None, " ".join(r.choice(words) for _ in range(40))) for i in range(60)]
    rows += [(5, None), (6, ""), (7, "a" * 70_000 + " " + "a" * 70_000), rows[3], rows[3]]
    got = spelling.vocabulary(frame(rows, "doc_id long, text string"))
    assert {x.word: x.n for x in got.collect()} == plain_vocabulary(rows)
    empty = spelling.vocabulary(frame([], "doc_id long, text string"))
    assert found_variants(empty) == {}


def test_roots_follow_forms_to_the_end(frame):
    forms = {"a": "b", "b": "c", "c": "d", "d": "e", "x": "e", "y": "a"}
    got = spelling.roots(frame(list(forms.items()), "word string, form string"))
    assert {x.word: x.root for x in got.collect()} == dict.fromkeys(forms, "e")
