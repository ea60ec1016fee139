"""Spelling variants: words one edit apart, found with K-d trees over letter counts.

A word is a vector: how often each letter stands in it. One replaced letter moves the vector by an L1
distance of 2, one inserted or deleted letter by 1, so for each pair of lengths the words near a word
are in a small range around its vector. A shard of words of one length is a K-d tree: nodes are split at
the median of the letter that varies most, and each keeps its tight box. A range search goes down into the
boxes that are within the distance; what is found is verified letter by letter. Vectors and boxes are
kept as unary bits, so a distance is the number of bits that differ.

Large vocabularies are dealt into shards by the top of such a tree, which is fitted per length on a sample of
at most ``sample`` words (all words are dealt; the sample only decides where planes lie). A word goes to
its own shard, and as a query to the shards that one edit may reach: a plane is crossed only by a letter count next to
it, once up and once down at most. Of two words of one length the query goes to the later shard only, of two
lengths from the shorter to the longer, so each pair is found once. Words that planes can't part (equal letters in
another order) are dealt into further parts by hash. Words with equal vectors are never one edit apart; two
large groups of equal vectors are matched by their words without one letter, not pair by pair.

Defined results: null and empty texts have no words; a null id counts as an empty text in the hash
that plants variants; repeated rows count as often as they are there; very long texts and words are taken whole;
ties between forms go to the smaller word in code-point order; an empty table gives an empty result. Only the
id and text columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from hearthline.llm.seeds import whole_groups
from hearthline.sources.stages import stage

LETTERS = 26 + 64  # a-z and U+00C0 to U+00FF
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
POINT, SAME, SHORTER = 0, 1, 2  # of a row in a shard: its word; a query of that length; one a letter shorter


@dataclass(frozen=True)
class Settings:
    least_length: int = 7
    least_count: int = 2
    one_in: int = 31  # of (document, word), so many lose a letter
    ratio: int = 10  # a form is so many times as frequent
    shard: int = 20_000  # words of one tree
    sample: int = 50_000  # words on which the dealing is fitted
    leaf: int = 24
    block: int = 512  # queries searched at once


# Words and their counts: DataFrame functions.


def runs(docs: DataFrame, id: str, text: str, settings: Settings = Settings()) -> DataFrame:
    """``word``, one row per run of letters that may still be long enough after losing one."""
    # A run shorter than this can't reach the length; the greedy pattern takes maximal runs only.
    pattern = f"[A-Za-z\\u00C0-\\u00FF]{{{settings.least_length},}}"
    found = F.explode(F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(0)))
    rows = docs.select(F.coalesce(F.col(id).cast("string"), F.lit("")).alias("id"), found.alias("run"))
    rows = rows.select("id", F.translate("run", _UPPER, _LOWER).alias("run"))
    h = F.crc32(F.concat_ws(":", "id", "run"))
    at = (h % F.char_length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring(F.col("run"), at + 2, F.char_length("run")))
    return rows.select(F.when(h % settings.one_in == 0, cut).otherwise(F.col("run")).alias("word"))


def vocabulary(docs: DataFrame, id: str = "doc_id", text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """``word, n``: words long and frequent enough; counts are combined in each task first."""
    words = runs(docs, id, text, settings).where(F.char_length("word") >= settings.least_length)
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= settings.least_count)


# Letters of many words at once.


def letters(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Letter numbers of all words one after another, and where each word starts."""
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    starts = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8)[starts[0] : starts[-1]] if len(column) and starts[-1] > starts[0] else np.zeros(0, np.uint8)
    # U+00C0 to U+00FF are the byte C3 and one of 80 to BF.
    real = raw != 0xC3
    code = np.where(raw < 0x80, raw - 97, raw - 0x80 + 26).astype(np.uint8)[real]
    before = np.zeros(len(raw) + 1, np.int64)
    np.cumsum(real, out=before[1:])
    return code, before[starts - starts[0]]


def counts(code: np.ndarray, starts: np.ndarray) -> np.ndarray:
    length = np.diff(starts)
    cell = np.repeat(np.arange(len(length)), length) * LETTERS + code
    kind = np.uint8 if length.max(initial=0) < 256 else np.int64
    return np.bincount(cell, minlength=len(length) * LETTERS).astype(kind).reshape(-1, LETTERS)


def plane(vectors: np.ndarray) -> tuple[int, int] | None:
    """The letter that varies most and the largest count that stays left, at the median; None if all are equal."""
    letter = int(np.argmax(vectors.var(axis=0)))
    values = vectors[:, letter]
    low, high = int(values.min()), int(values.max())
    if low == high:
        return None
    return letter, min(int(np.median(values)), high - 1)


# Dealing words into shards.


@dataclass
class Dealing:
    """Planes above the shards of one length. Node ``i`` has children ``left[i]`` and ``left[i] + 1``, or is a shard."""

    letter: list[int] = field(default_factory=lambda: [0])
    most: list[int] = field(default_factory=lambda: [0])
    left: list[int] = field(default_factory=lambda: [-1])
    parts: list[int] = field(default_factory=lambda: [1])

    @classmethod
    def fit(cls, vectors: np.ndarray, each: float, settings: Settings) -> Dealing:
        """Planes for a sample of which each word stands for ``each`` words."""
        out, rows = cls(), [vectors]
        node = 0
        while node < len(rows):
            here = rows[node]
            if len(here) * each > settings.shard and len(here) >= 32:
                found = plane(here)
                if found:
                    out.letter[node], out.most[node] = found
                    out.left[node] = len(rows)
                    right = here[:, found[0]] > found[1]
                    for side in (here[~right], here[right]):
                        rows.append(side)
                        for values, start in ((out.letter, 0), (out.most, 0), (out.left, -1), (out.parts, 1)):
                            values.append(start)
                else:
                    out.parts[node] = int(-(-len(here) * each // settings.shard))
            rows[node] = None
            node += 1
        return out

    def reached(self, vectors: np.ndarray, up: bool, down: bool) -> tuple[np.ndarray, np.ndarray]:
        """Rows and shards that each vector reaches, moved by one letter more and one fewer at most."""
        letter, most, left = map(np.array, (self.letter, self.most, self.left))
        row, node = np.arange(len(vectors)), np.zeros(len(vectors), np.int64)
        more = np.full(len(vectors), -1 if up else -2)  # the letter that has one more: -1 still free, -2 none
        fewer = np.full(len(vectors), -1 if down else -2)
        done = []
        while len(row):
            stop = left[node] < 0
            done.append((row[stop], node[stop]))
            row, node, more, fewer = (x[~stop] for x in (row, node, more, fewer))
            d, v = letter[node], most[node]
            value = vectors[row, d].astype(np.int64) + (more == d) - (fewer == d)
            side = (value > v).astype(np.int64)
            rise = (value == v) & (more == -1) & (fewer != d)
            fall = (value == v + 1) & (fewer == -1) & (more != d)
            row = np.concatenate([row, row[rise], row[fall]])
            down_to = left[node]
            next_more = np.concatenate([more, d[rise], more[fall]])
            next_fewer = np.concatenate([fewer, fewer[rise], d[fall]])
            node = np.concatenate([down_to + side, down_to[rise] + 1, down_to[fall]])
            more, fewer = next_more, next_fewer
        row, node = (np.concatenate([x[i] for x in done]) for i in (0, 1))
        both = np.unique(np.stack([row, node]), axis=1)
        return both[0], both[1]


def _dealings(vocab: DataFrame, settings: Settings) -> dict[int, Dealing]:
    total = vocab.count()
    one_in = -(-total // settings.sample) or 1
    some = vocab.where(F.pmod(F.xxhash64("word"), F.lit(one_in)) == 0).select("word").limit(2 * settings.sample)
    column = some.toArrow()["word"].combine_chunks()
    if not len(column):
        return {}
    code, starts = letters(column)
    vectors, length = counts(code, starts), np.diff(starts)
    return {int(n): Dealing.fit(vectors[length == n], one_in, settings) for n in np.unique(length)}


_DEALT = "size int, node int, part int, kind int, word string, n long"


def _deal(vocab: DataFrame, dealings: dict[int, Dealing]) -> DataFrame:
    """Each word in its shard, and as a query in the shards that it may reach."""
    whole = Dealing()

    def rows_of(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        code, starts = letters(batch.column("word"))
        vectors, length = counts(code, starts), np.diff(starts)
        salt = np.add.reduceat(code.astype(np.int64) * (np.arange(len(code)) - np.repeat(starts[:-1], length) + 7), starts[:-1])
        for n in np.unique(length):
            mine = np.flatnonzero(length == n)
            own = dealings.get(int(n), whole)
            rows, home = own.reached(vectors[mine], False, False)
            parts = np.array(own.parts)
            part = salt[mine] % parts[home]
            found = [(n, rows, home, part, np.full(len(rows), POINT))]
            at, node = own.reached(vectors[mine], True, True)
            for p in range(int(parts.max())):
                ahead = (parts[node] > p) & ((node > home[at]) | ((node == home[at]) & (p > part[at])))
                found.append((n, at[ahead], node[ahead], np.full(ahead.sum(), p), np.full(ahead.sum(), SAME)))
            longer = dealings.get(int(n) + 1, whole)
            at, node = longer.reached(vectors[mine], True, False)
            for p in range(max(longer.parts)):
                ahead = np.array(longer.parts)[node] > p
                found.append((n + 1, at[ahead], node[ahead], np.full(ahead.sum(), p), np.full(ahead.sum(), SHORTER)))
            for size, at, node, part, kind in found:
                if len(at):
                    picked = batch.take(pa.array(mine[at]))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(len(at), size, np.int32)), *(pa.array(x.astype(np.int32)) for x in (node, part, kind)),
                            picked.column("word"), picked.column("n"),
                        ],
                        names=[x.split(" ")[0] for x in _DEALT.split(", ")],
                    )

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                yield from rows_of(batch)

    return vocab.select("word", "n").mapInArrow(run, _DEALT)


# Range searches inside a shard.


def packed(vectors: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Counts as unary bits, in words of 64."""
    letter = np.repeat(np.arange(LETTERS), most)
    step = np.arange(len(letter)) - np.repeat(np.cumsum(most) - most, most)
    lanes = max(1, -(-len(letter) // 64))
    bits = np.zeros((len(vectors), lanes * 64), bool)
    bits[:, : len(letter)] = vectors[:, letter] > step
    return np.packbits(bits, axis=1).view(np.uint64)


class Tree:
    """A K-d tree over distinct vectors with the tight box of each node, as unary bits."""

    def __init__(self, vectors: np.ndarray, bits: np.ndarray, leaf: int):
        self.order = np.arange(len(vectors))
        spans, self.left, low, high = [(0, len(vectors))], [], [], []
        node = 0
        while node < len(spans):
            a, b = spans[node]
            rows = self.order[a:b]
            low.append(np.bitwise_and.reduce(bits[rows], axis=0))
            high.append(np.bitwise_or.reduce(bits[rows], axis=0))
            found = plane(vectors[rows]) if b - a > leaf else None
            self.left.append(len(spans) if found else -1)
            if found:
                right = vectors[rows, found[0]] > found[1]
                middle = b - int(right.sum())
                self.order[a:b] = np.concatenate([rows[~right], rows[right]])
                spans += [(a, middle), (middle, b)]
            node += 1
        self.left, self.spans = np.array(self.left), np.array(spans)
        self.low, self.high = np.array(low), np.array(high)
        self.bits = bits

    def within(self, queries: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
        """Queries and vectors that are exactly ``distance`` apart."""
        query, node = np.arange(len(queries)), np.zeros(len(queries), np.int64)
        leaves = []
        while len(query):
            q = queries[query]
            away = np.bitwise_count(self.low[node] & ~q).sum(axis=1) + np.bitwise_count(q & ~self.high[node]).sum(axis=1)
            near = away <= distance
            query, node = query[near], node[near]
            down = self.left[node]
            leaves.append((query[down < 0], node[down < 0]))
            query, down = query[down >= 0], down[down >= 0]
            query, node = np.concatenate([query, query]), np.concatenate([down, down + 1])
        query, node = (np.concatenate([x[i] for x in leaves]) for i in (0, 1))
        first, size = self.spans[node, 0], self.spans[node, 1] - self.spans[node, 0]
        place = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(first, size)
        query, point = np.repeat(query, size), self.order[place]
        exact = np.bitwise_count(queries[query] ^ self.bits[point]).sum(axis=1) == distance
        return query[exact], point[exact]


def one_edit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether words of equal length differ in one place, or the longer has one letter more; row by row."""
    n = a.shape[1]
    if n == b.shape[1]:
        return (a != b).sum(axis=1) == 1
    # Equal up to the first difference, and from there on with the longer one shifted.
    ahead, behind = a != b[:, :n], a != b[:, 1:]
    first = np.where(ahead.any(axis=1), ahead.argmax(axis=1), n)
    last = np.where(behind.any(axis=1), n - 1 - behind[:, ::-1].argmax(axis=1), -1)
    return last < first


def _rows_equal(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of equal rows of two matrices."""
    _, key = np.unique(np.concatenate([a, b]), axis=0, return_inverse=True)
    key = key.reshape(-1)
    one, other = key[: len(a)], key[len(a) :]
    order = np.argsort(other, kind="stable")
    first = np.searchsorted(other[order], one, "left")
    size = np.searchsorted(other[order], one, "right") - first
    place = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(first, size)
    return np.repeat(np.arange(len(a)), size), order[place]


def matched(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs one edit apart between two large groups with equal vectors each: by the words without one letter."""
    pairs = []
    for p in range(b.shape[1]):
        rest = np.delete(b, p, axis=1)
        pairs.append(_rows_equal(a if a.shape[1] < b.shape[1] else np.delete(a, p, axis=1), rest))
    both = np.unique(np.stack([np.concatenate([x[i] for x in pairs]) for i in (0, 1)]), axis=1)
    return both[0], both[1]


MANY = 4096  # pairs of words of two vectors from which on they are not compared one by one


def _links(tree: Tree, words: _Words, queries: _Words, distance: int, block: int, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of ``queries`` and rows of ``words`` that are one edit apart."""
    for at in range(0, len(queries.bits), block):
        q, p = tree.within(queries.bits[at : at + block], distance)
        q += at
        if same:
            q, p = q[q < p], p[q < p]
        pairs = queries.size[q] * words.size[p]
        for x, y in zip(q[pairs > MANY].tolist(), p[pairs > MANY].tolist()):
            mine, theirs = queries.members(x), words.members(y)
            i, j = matched(queries.letters[mine], words.letters[theirs])
            yield mine[i], theirs[j]
        few = pairs <= MANY
        q, p, pairs = q[few], p[few], pairs[few]
        # Pieces of bounded size, whatever the number of words per vector.
        cut = np.searchsorted(np.cumsum(pairs), np.arange(0, pairs.sum() + 1, 500_000)[1:])
        for q, p, pairs in zip(np.split(q, cut), np.split(p, cut), np.split(pairs, cut)):
            nth = np.arange(pairs.sum()) - np.repeat(np.cumsum(pairs) - pairs, pairs)
            wide = np.repeat(words.size[p], pairs)
            i = queries.order[np.repeat(queries.first[q], pairs) + nth // wide]
            j = words.order[np.repeat(words.first[p], pairs) + nth % wide]
            near = one_edit(queries.letters[i], words.letters[j])
            yield i[near], j[near]


@dataclass
class _Words:
    """Words of one length: letters row by row, and their distinct vectors."""

    column: pa.Array
    n: np.ndarray
    letters: np.ndarray
    vectors: np.ndarray
    order: np.ndarray
    first: np.ndarray
    size: np.ndarray
    bits: np.ndarray | None = None

    @classmethod
    def of(cls, table: pa.Table) -> _Words | None:
        if not table.num_rows:
            return None
        column = table["word"].combine_chunks()
        code, starts = letters(column)
        vectors, which = np.unique(counts(code, starts), axis=0, return_inverse=True)
        which = which.reshape(-1)
        order = np.argsort(which, kind="stable")
        size = np.bincount(which, minlength=len(vectors))
        return cls(column, table["n"].to_numpy(), code.reshape(len(column), -1), vectors, order, np.cumsum(size) - size, size)

    def members(self, vector: int) -> np.ndarray:
        return self.order[self.first[vector] : self.first[vector] + self.size[vector]]


_LINKS = "a string, a_n long, b string, b_n long"


def _near_in(table: pa.Table, settings: Settings) -> Iterator[pa.RecordBatch]:
    kind = table["kind"].to_numpy()
    points, same, shorter = (_Words.of(table.filter(pa.array(kind == k))) for k in (POINT, SAME, SHORTER))
    if points is None:
        return
    sets = [x for x in (points, same, shorter) if x is not None]
    most = np.max([x.vectors.max(axis=0) for x in sets], axis=0).astype(np.int64)
    for x in sets:
        x.bits = packed(x.vectors, most)
    tree = Tree(points.vectors, points.bits, settings.leaf)
    for queries, distance in ((points, 2), (same, 2), (shorter, 1)):
        if queries is None:
            continue
        for i, j in _links(tree, points, queries, distance, settings.block, queries is points):
            if len(i):
                yield pa.RecordBatch.from_arrays(
                    [queries.column.take(pa.array(i)), pa.array(queries.n[i]), points.column.take(pa.array(j)), pa.array(points.n[j])],
                    names=["a", "a_n", "b", "b_n"],
                )


def near_words(vocab: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``a, a_n, b, b_n``: every pair of words one edit apart, once."""
    dealt = _deal(vocab, _dealings(vocab, settings))
    shards = ("size", "node", "part")
    dealt = dealt.repartition(*shards).sortWithinPartitions(*shards)

    def run(batches):
        for table in whole_groups(batches, shards):
            keys = np.stack([table[c].to_numpy() for c in shards])
            bounds = np.flatnonzero(np.append(True, (keys[:, 1:] != keys[:, :-1]).any(axis=0)))
            for i, j in zip(bounds, np.append(bounds[1:], table.num_rows)):
                yield from _near_in(table.slice(i, j - i), settings)

    return dealt.mapInArrow(run, _LINKS)


def roots(forms: DataFrame) -> DataFrame:
    """``word, root``: where following ``form`` from word to word ends; forms grow, so there are no rings."""
    steps = forms.select("word", F.col("form").alias("root"))
    while True:
        on = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = stage(steps.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        steps = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return steps


def variants(vocab: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``word, n, n_near, form, form_n, root`` for each word of ``vocab`` (``word, n``)."""
    vocab = stage(vocab, "vocabulary")
    links = stage(near_words(vocab, settings), "near-words")
    one = links.select(F.col("a").alias("word"), F.col("b").alias("near"), F.col("b_n").alias("m"))
    other = links.select(F.col("b").alias("word"), F.col("a").alias("near"), F.col("a_n").alias("m"))
    best = F.min(F.struct((-F.col("m")).alias("m"), "near"))
    near = one.unionByName(other).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    rows = vocab.join(near, "word", "left")
    enough = -F.col("best.m") >= settings.ratio * F.col("n")
    rows = stage(rows.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(enough, F.col("best.near")).alias("form"),
        F.when(enough, -F.col("best.m")).alias("form_n"),
    ), "forms")
    ends = roots(rows.where("form is not null"))
    return rows.join(ends, "word", "left").withColumn("root", F.coalesce("root", "word"))
