"""Benchmark decontamination by a prefix-filtered set join of word shingles.

Every benchmark item gives windows of ``window`` consecutive words (a shorter item is one window).
A window occurs in a text exactly if the text contains all its shingles at one place. For full
containment the prefix that must be shared has length 1, so each window is joined by its rarest
shingle alone; rarity is the number of occurrences in all texts. A shared shingle at word ``p`` of
the text and ``o`` of the window fixes the place ``p - o`` (positional bound); the place must leave
room for the whole window (length bound); the words there are then compared one by one.

The windows are cut into blocks of ``block_windows`` rows, so that what is broadcast is bounded
whatever the size of the benchmark; each block is one scan of the texts, without a shuffle.

Defined results: a null or empty text has no words and no hits; an item without words has no
window; a null item id reads as an empty one; equal windows of several items hit for all of them;
items with one id count once. Repeated rows are judged each. ``keep`` names the columns to return;
other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from hearthline.llm.textwords import ALPHANUMERIC, chunks, grams, words
from hearthline.sources.stages import stage

SHINGLE = 3  # words of a shingle; less for a window of fewer words
_FOUND = "__n_words long, __spans array<struct<first:int,past:int>>, __items array<string>"


@dataclass(frozen=True)
class Settings:
    window: int = 10
    block_windows: int = 200_000


def windows(benchmark: DataFrame, item: str, text: str, settings: Settings) -> DataFrame:
    """``words`` (word hashes of a window, 8 bytes each) and ``item``; each pair once."""

    def run(batches):
        for batch in batches:
            ids, rows, owner = batch.column(1).to_pylist(), [], []
            for chunk in chunks(batch.column(0)):
                found = words(chunk, ALPHANUMERIC)
                hashes = found.hashes()
                for i, (a, b) in enumerate(zip(found.bounds[:-1], found.bounds[1:])):
                    for at in range(a, max(a + 1, b - settings.window + 1)) if b > a else ():
                        rows.append(hashes[at : min(b, at + settings.window)].tobytes())
                        owner.append(ids[chunk.first + i])
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary()), pa.array(owner, pa.string())], names=["words", "item"])

    source = benchmark.select(F.col(text), F.coalesce(F.col(item).cast("string"), F.lit("")))
    return source.mapInArrow(run, "words binary, item string").distinct()


class Index:
    """The windows of one block, found by their rarest shingles."""

    def __init__(self, rows: pa.Table):
        seqs = rows["words"].to_pylist()
        kinds = {s: i for i, s in enumerate(dict.fromkeys(seqs))}
        self.items = rows["item"].to_pylist()
        of = np.array([kinds[s] for s in seqs], np.int64)
        self.item_order = np.argsort(of, kind="stable")
        self.item_bounds = np.searchsorted(of[self.item_order], np.arange(len(kinds) + 1))
        self.length = np.array([len(s) // 8 for s in kinds], np.int64)
        self.words = np.zeros((len(kinds), int(self.length.max())), np.uint64)
        for i, s in enumerate(kinds):
            self.words[i, : len(s) // 8] = np.frombuffer(s, np.uint64)
        # All shingles of all windows: hash, window and place in the window, by shingle size.
        self.sizes = sorted({int(min(SHINGLE, n)) for n in self.length})
        self.shingles = {}
        for size in self.sizes:
            hashes, window, place = [], [], []
            for n in np.unique(self.length[np.minimum(self.length, SHINGLE) == size]):
                rows_of = np.flatnonzero(self.length == n)
                for o in range(int(n) - size + 1):
                    hashes.append(np.concatenate([grams(self.words[r, o : o + size], size) for r in rows_of]))
                    window.append(rows_of)
                    place.append(np.full(len(rows_of), o))
            self.shingles[size] = tuple(map(np.concatenate, (hashes, window, place)))
        self.look = {size: Lookup(np.unique(s[0])) for size, s in self.shingles.items()}
        self.anchors: dict = {}

    def choose(self, counts: dict[int, np.ndarray]) -> None:
        """Keep for each window its rarest shingle; ties go to the smaller hash."""
        for size, (hashes, window, place) in self.shingles.items():
            often = counts[size][np.searchsorted(self.look[size].keys, hashes)]
            order = np.lexsort((place, hashes, often, window))
            first = order[np.flatnonzero(np.diff(window[order], prepend=-1))]
            first = first[np.argsort(hashes[first], kind="stable")]
            keys, begin = np.unique(hashes[first], return_index=True)
            self.anchors[size] = (Lookup(keys), np.append(begin, len(first)), window[first], place[first])
        self.shingles, self.look = {}, {}


class Lookup:
    """Places of sorted keys; a bit table turns most hashes away before the search."""

    def __init__(self, keys: np.ndarray):
        self.keys = keys
        bits = max(12, int(len(keys) * 16).bit_length())
        self.mask = np.uint64((1 << bits) - 1)
        self.table = np.zeros(1 << bits, bool)
        self.table[(keys & self.mask).astype(np.int64)] = True

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where ``hashes`` are keys, and which keys."""
        at = np.flatnonzero(self.table[(hashes & self.mask).astype(np.int64)])
        key = np.searchsorted(self.keys, hashes[at])
        key[key == len(self.keys)] = 0
        fits = self.keys[key] == hashes[at]
        return at[fits], key[fits]


def spread(begin: np.ndarray, count: np.ndarray) -> np.ndarray:
    """``begin[i], begin[i] + 1, ...``, ``count[i]`` of them, one after another."""
    total = np.cumsum(count)
    return np.arange(int(total[-1]) if len(total) else 0) + np.repeat(begin - total + count, count)


def _count(docs: DataFrame, text: str, index) -> dict[int, np.ndarray]:
    """Occurrences of the block's shingles in all texts."""

    def run(batches):
        look = index.value.look
        sums = {size: np.zeros(len(v.keys), np.int64) for size, v in look.items()}
        for batch in batches:
            for chunk in chunks(batch.column(0)):
                found = words(chunk, ALPHANUMERIC)
                hashes = found.hashes()
                for size, v in look.items():
                    _, key = v.find(grams(hashes, size))
                    sums[size] += np.bincount(key, minlength=len(v.keys))
        for size, n in sums.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), size, np.int32)), pa.array(at), pa.array(n[at])], names=["size", "key", "n"])

    rows = docs.select(F.col(text)).mapInArrow(run, "size int, key long, n long")
    rows = rows.groupBy("size", "key").agg(F.sum("n").alias("n")).toArrow()
    out = {size: np.zeros(len(v.keys), np.int64) for size, v in index.value.look.items()}
    for size in out:
        own = rows["size"].to_numpy() == size
        out[size][rows["key"].to_numpy()[own]] = rows["n"].to_numpy()[own]
    return out


def _scan(docs: DataFrame, keep: list[str], text: str, index) -> DataFrame:
    source = docs.select(F.col(text).alias("__text"), *keep)
    schema = source.select(*keep).schema
    for part in docs.sparkSession.createDataFrame([], _FOUND).schema:
        schema = schema.add(part)
    span = pa.list_(pa.struct([("first", pa.int32()), ("past", pa.int32())]))

    def run(batches):
        block = index.value
        for batch in batches:
            n_words, spans, items = [], [], []
            for chunk in chunks(batch.column(0)):
                found = words(chunk, ALPHANUMERIC)
                n = len(chunk)
                starts, which = occurrences(block, found)
                past = starts + (block.length[which] if len(which) else 0)
                own = np.searchsorted(found.bounds, starts, "right") - 1
                n_words.append(found.counts())
                chunk_spans, chunk_items = [[] for _ in range(n)], [[] for _ in range(n)]
                for doc in np.unique(own):
                    mine = own == doc
                    a, b = _joined(starts[mine], past[mine])
                    base = found.bounds[doc]
                    chunk_spans[doc] = [{"first": int(x - base), "past": int(y - base)} for x, y in zip(a, b)]
                    hit = np.unique(which[mine])
                    at = spread(block.item_bounds[hit], np.diff(block.item_bounds)[hit])
                    chunk_items[doc] = sorted({block.items[i] for i in block.item_order[at]})
                spans += chunk_spans
                items += chunk_items
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array(np.concatenate(n_words) if n_words else np.zeros(0, np.int64), pa.int64()), pa.array(spans, span), pa.array(items, pa.list_(pa.string()))],
                names=[*keep, "__n_words", "__spans", "__items"],
            )

    return source.mapInArrow(run, schema)


def occurrences(block: Index | None, found) -> tuple[np.ndarray, np.ndarray]:
    """First words (in the chunk) and windows of all verified occurrences."""
    starts, which = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    if block is None:
        return starts[0], which[0]
    hashes = found.hashes()
    for size, (look, begin, window, place) in block.anchors.items():
        at, key = look.find(grams(hashes, size))
        count = np.diff(begin)[key]
        entry = spread(begin[key], count)
        at, w = np.repeat(at, count), window[entry]
        start = at - place[entry]
        doc = np.searchsorted(found.bounds, at, "right") - 1
        fits = (start >= found.bounds[doc]) & (start + block.length[w] <= found.bounds[doc + 1])
        start, w = start[fits], w[fits]
        for j in range(block.words.shape[1]):
            if not len(start):
                break
            inside = j < block.length[w]
            same = hashes[np.where(inside, start + j, 0)] == block.words[w, j]
            start, w = start[same | ~inside], w[same | ~inside]
        starts.append(start)
        which.append(w)
    return np.concatenate(starts), np.concatenate(which)


def _joined(start: np.ndarray, past: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Overlapping or touching ranges as one."""
    order = np.argsort(start, kind="stable")
    start, past = start[order], np.maximum.accumulate(past[order])
    new = np.ones(len(start), bool)
    new[1:] = start[1:] > past[:-1]
    first = np.flatnonzero(new)
    return start[first], past[np.append(first[1:] - 1, len(start) - 1)]


_NO_SPANS = "cast(array() as array<struct<first:int,past:int>>)"
_NO_ITEMS = "cast(array() as array<string>)"


def decontaminate(docs: DataFrame, benchmark: DataFrame, keep: list[str], text: str = "text",
                  item: str = "item_id", item_text: str = "text", settings: Settings = Settings(),
                  prefix: str = "") -> DataFrame:
    """``keep`` columns with ``n_words``, ``spans`` (hit words, joined), ``n_hit`` and ``items``.

    ``prefix`` stands before the names of the new columns, which replace kept ones of the same name.
    """
    keep = [c for c in keep if c not in [prefix + n for n in ("n_words", "spans", "n_hit", "items")]]
    spark = docs.sparkSession
    all_windows = stage(windows(benchmark, item, item_text, settings), "benchmark-windows")
    blocks = -(-all_windows.count() // settings.block_windows)
    # Within one block nothing needs a key; several blocks are put together by row content.
    key = F.sha2(F.to_json(F.struct(F.col(text).alias("__text"), *keep)), 256).alias("__key")
    source, names = (docs, keep) if blocks <= 1 else (docs.withColumn("__key", key), [*keep, "__key"])
    parts = []
    for b in range(blocks):
        rows = all_windows.where(F.pmod(F.xxhash64("words"), F.lit(blocks)) == b).toArrow()
        if not rows.num_rows:
            continue
        index = Index(rows)
        shared = spark.sparkContext.broadcast(index)
        counts = _count(docs, text, shared)
        shared.unpersist()
        index.choose(counts)
        part = _scan(source, names, text, spark.sparkContext.broadcast(index))
        parts.append(part if blocks <= 1 else stage(part, "benchmark-hits"))
    if not parts:  # no window at all
        parts.append(_scan(docs, keep, text, spark.sparkContext.broadcast(None)))
    found = parts[0]
    if len(parts) > 1:
        hits = [p.where("size(__items) > 0").select("__key", "__spans", "__items") for p in parts[1:]]
        more = reduce(DataFrame.unionByName, hits).groupBy("__key").agg(
            F.flatten(F.collect_set("__spans")).alias("__more_spans"), F.flatten(F.collect_set("__items")).alias("__more_items")
        )
        found = found.join(more, "__key", "left").select(
            *keep, "__n_words",
            F.array_sort(F.array_union("__spans", F.coalesce("__more_spans", F.expr(_NO_SPANS)))).alias("__spans"),
            F.array_sort(F.array_union("__items", F.coalesce("__more_items", F.expr(_NO_ITEMS)))).alias("__items"),
        )
    covered = F.expr(
        "aggregate(__spans, named_struct('n', 0L, 'past', 0), (a, s) -> named_struct("
        "'n', a.n + greatest(0, s.past - greatest(a.past, s.first)), 'past', greatest(a.past, s.past)), a -> a.n)"
    )
    return found.select(
        *keep, F.col("__n_words").alias(f"{prefix}n_words"), F.col("__spans").alias(f"{prefix}spans"),
        covered.alias(f"{prefix}n_hit"), F.col("__items").alias(f"{prefix}items"),
    )
