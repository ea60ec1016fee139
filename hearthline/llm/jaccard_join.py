"""N-gram Jaccard join: documents whose sets of word n-grams are alike, and their components.

Equal sets are one class, and one text stands for it, so copies cost nothing. A class puts its n-grams in one order for all
classes, rare ones first, and two classes that are alike share one among the first
``n - ceil(t n) + 1``. The prefix n-grams of all classes meet in one exchange; only those that two
classes share are kept. Candidates then pass

* the length filter: the smaller set has ``t`` times the n-grams of the larger;
* the positional filter: what stands before and after the shared n-gram limits the overlap;
* the suffix filter: fixed pivots cut both sets into parts of about 16; the differences of the part
  sizes add up to a lower bound of the symmetric difference;

and each pair that is left is verified on the whole sets.

N-grams of few documents give all their pairs. For one of many documents, a round pairs each document
with one partner per n-gram; components are computed, and n-grams whose documents are all in one
component are done, as links are wanted up to components only. For n-grams that are still open after
``Settings.rounds``:

* if at most 8 documents of an n-gram are outside its largest component, they meet the others;
* else documents that share an open n-gram, over any number of them, are one meeting. If those outside the meeting's
  largest component fit ``BLOCKS`` blocks of some 256, all pairs of blocks meet in tasks, but for those inside that
  component: a set is sent once for each block it meets, so work and rows stay in proportion to the documents. A
  matrix product gives the overlaps of two blocks, and a task returns a star for each of their components;
* larger meetings are taken apart by levels, so that no large group's pairs are ever all taken: the smallest set of an open n-gram's documents is its pivot, and the overlap of every other set with the
  pivot is counted;
* a set has the same overlap with the pivot at most, and sets alike with the pivot are one component. For
  two others, of which one isn't alike with the pivot, the n-grams of the pivot alone can't make a
  link, since no set is smaller: they must share n-grams that the pivot lacks, at least as many as
  the overlap with the pivot falls short;
* so the rare first of the n-grams that the pivot lacks are the next level's n-grams, kept apart by pivot.

The pivot has none of them and leaves, so the levels end, and no link between components is missed. A
group of thousands of near copies costs pairs in proportion to its size.

Rarity comes from counts of all n-grams of the distinct sets of each task in ``2 ** rarity_bits`` hash
buckets, a fixed size; so it doesn't depend on how rows are dealt to tasks, but for copies. An n-gram
stands out once it is in more documents than a bucket holds on average; any order that is the same for
all documents gives the same links.

Defined results: null and empty texts and texts without words have no set and link with nothing; a
text with fewer words than ``n`` has its whole word sequence as the one n-gram; rows that repeat an id
are rows of their own, in the component that their text gives them; a component is named by the
smallest id that isn't null. Only the id and text columns are read.
"""

from __future__ import annotations

import hashlib
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from hearthline.llm.components import components, smallest_linked
from hearthline.llm.seeds import MARK, SHARED, SINGLE, local_groups, spread_by_key, whole_groups
from hearthline.llm.textwords import SPACED, chunks, grams, mix, words
from hearthline.sources.stages import kept as stage

SLICES = 256  # of the buckets; each is summed in one task
FEW = 4  # rows of one n-gram that a task sends as they are
SMALL = 8  # documents of an n-gram up to which all pairs are taken at once
KEY_BITS = 48  # of an n-gram's hash; a clash costs a candidate and changes no result
NEED_BITS = 21  # slots of the filter for wanted texts
FIRST_BITS = 27  # most slots of the filter for the texts that stand for their classes
HELD_ROWS = 250_000  # n-grams or pairs that a task holds at once
SLICE_ROWS = 256  # rows with sets that a task works on together
SALTED = 4096  # documents of a pivot that a task compares with it
BLOCK_DOCS = 256  # documents of a block, on average; the pairs of two blocks meet in one task
BLOCK_GRAMS = 100_000  # n-grams of a block, on average
BLOCKS = 16  # blocks outside the largest component of a meeting, up to which all its blocks meet
COLUMNS = 8192  # n-grams whose overlaps are counted at once
SENT_ROWS = 200_000  # names of sets or pairs that are sent to all tasks, so that only the sets meant are exchanged


@dataclass(frozen=True)
class Settings:
    n: int = 5  # words
    percent: int = 75  # of the union
    rarity_bits: int = 22
    rounds: int = 2  # of single partners, before open n-grams are taken apart


def _needed(percent: int, n: int) -> int:
    """The least overlap of a set of ``n`` with any set that is alike."""
    return -(-percent * n // 100)


def ngram_sets(column, n: int):
    """The sorted distinct n-gram hashes of each text, or an empty array."""
    for chunk in chunks(column):
        found = words(chunk, SPACED)
        hashes = found.hashes()
        whole = grams(hashes, n)
        for a, b in zip(found.bounds[:-1].tolist(), found.bounds[1:].tolist()):
            if b - a >= n:
                yield np.unique(whole[a : b - n + 1])
            elif b > a:
                yield grams(hashes[a:b], b - a)
            else:
                yield whole[:0]


def row_key(id: str, text: str) -> Column:
    return F.xxhash64(F.col(id), F.col(id).isNull(), F.col(text))


def part_sizes(s: np.ndarray) -> np.ndarray:
    """Sizes of the parts of a set between fixed pivots, at most 255 each."""
    bits = min(12, max(4, (len(s) // 16).bit_length()))
    parts = np.bincount((s >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits)
    return np.minimum(parts, 255).astype(np.uint8)


def least_difference(one: bytes, two: bytes) -> int:
    """A lower bound of the symmetric difference of two sets, from their part sizes."""
    a, b = (np.frombuffer(x, np.uint8).astype(np.int64) for x in (one, two))
    n = min(len(a), len(b))
    return int(np.abs(a.reshape(n, -1).sum(axis=1) - b.reshape(n, -1).sum(axis=1)).sum())


def _slices(batch: pa.RecordBatch):
    """Parts of a batch of few rows, so that what is made of them is small."""
    for at in range(0, batch.num_rows, SLICE_ROWS):
        yield batch.slice(at, SLICE_ROWS)


def _arrays(column):
    """The sets of a binary column, one at a time and not copied."""
    for value in column:
        yield np.frombuffer(value.as_buffer(), np.uint64)


def _digests(sets):
    """128-bit digests of non-empty sets, as two longs each."""
    return [np.frombuffer(hashlib.blake2b(s.tobytes(), digest_size=16).digest(), np.int64).tolist() for s in sets]


def _packed(counts: np.ndarray) -> bytes:
    """Counts of a slice: which are there, these up to 255 as bytes, and the larger ones whole."""
    held = counts[counts > 0]
    parts = (np.packbits(counts > 0), np.minimum(held, 255).astype(np.uint8), held[held >= 255].astype(np.uint32))
    return zlib.compress(b"".join(p.tobytes() for p in parts), 1)


def _unpacked(packed: bytes, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and counts of a slice of ``width`` buckets."""
    packed, bits = zlib.decompress(packed), -(-width // 8)
    at = np.flatnonzero(np.unpackbits(np.frombuffer(packed, np.uint8, bits), count=width))
    count = np.frombuffer(packed, np.uint8, len(at), bits).astype(np.int64)
    count[count == 255] = np.frombuffer(packed[bits + len(at) :], np.uint32)
    return at, count


def overlaps(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of the sets at ``left`` with those at ``right``, as a matrix."""
    own = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, at, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    order = np.argsort(at, kind="stable")
    order = order[(count > 1)[at[order]]]  # an n-gram of one set is in no overlap of two
    own, at = own[order], (np.cumsum(count > 1) - 1)[at[order]]
    out = np.zeros((len(left), len(right)), np.int64)
    for first in range(0, int(at[-1]) + 1 if len(at) else 0, COLUMNS):
        part = slice(*np.searchsorted(at, [first, first + COLUMNS]))
        held = np.zeros((len(sets), COLUMNS), np.float32)
        held[own[part], at[part] - first] = 1
        out += (held[left] @ held[right].T).astype(np.int64)
    return out


def _members(docs: DataFrame, id: str, text: str, settings: Settings) -> DataFrame:
    """Kind 0: a row per document with the digest of its set. Kind 1: counts of slice ``one`` of the buckets,
    packed in ``profile``."""
    buckets = 1 << settings.rarity_bits
    source = docs.select(row_key(id, text).alias("row"), F.col(id).alias("id"), F.col(text).alias("__text"))
    schema = T.StructType([T.StructField("kind", T.IntegerType())])
    for field in source.schema.fields[:2]:
        schema = schema.add(field.name, field.dataType)
    for name in ("n", "one", "two"):
        schema = schema.add(name, "long")
    schema = schema.add("profile", "binary")

    def add(counts, held):
        low = (np.concatenate(held) & np.uint64(buckets - 1)).astype(np.int64)
        at, times = np.unique(low, return_counts=True)
        counts[at] += times.astype(np.uint32)

    def run(batches):
        counts, own, seen, held, waiting = np.zeros(buckets, np.uint32), None, set(), [], 0
        for batch in batches:
            own = batch.column(1).type
            sets = list(ngram_sets(batch.column(2), settings.n))
            if not sets:
                continue
            digests = [d if len(s) else [None, None] for s, d in zip(sets, _digests(sets))]
            profile = [part_sizes(s).tobytes() for s in sets]
            for s, d in zip(sets, digests):
                if len(s) and tuple(d) not in seen:
                    seen.add(tuple(d))
                    held.append(s)
                    waiting += len(s)
                if waiting >= HELD_ROWS:
                    add(counts, held)
                    held, waiting = [], 0
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.zeros(len(sets), np.int32)), batch.column(0), batch.column(1),
                    pa.array([len(s) for s in sets], pa.int64()), pa.array([d[0] for d in digests], pa.int64()),
                    pa.array([d[1] for d in digests], pa.int64()), pa.array(profile, pa.binary()),
                ],
                names=schema.fieldNames(),
            )
        if held:
            add(counts, held)
        width = buckets // SLICES
        for number in range(SLICES if seen else 0):
            part = counts[number * width : (number + 1) * width]
            none, one = pa.nulls(1, pa.int64()), pa.array([number], pa.int64())
            packed = pa.array([_packed(part)], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array([1], pa.int32()), none, pa.nulls(1, own), none, one, none, packed], names=schema.fieldNames()
            )

    return source.mapInArrow(run, schema)


def _rarity(slices: DataFrame, bits: int) -> np.ndarray:
    """The counts of all buckets, from the packed ``slices`` of the tasks; a fixed size."""
    width = (1 << bits) // SLICES

    def run(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for number, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                at, count = _unpacked(packed, width)
                total = sums.setdefault(number, np.zeros(width, np.int64))
                total[at] += count
        for number, total in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([number], pa.int64()), pa.array([np.minimum(total, (1 << 32) - 1).astype(np.uint32).tobytes()], pa.binary())],
                names=["one", "profile"],
            )

    out = np.zeros(1 << bits, np.uint32)
    summed = slices.repartition("one").mapInArrow(run, "one long, profile binary").toArrow()
    for number, packed in zip(summed["one"].to_pylist(), summed["profile"].to_pylist()):
        out[number * width : (number + 1) * width] = np.frombuffer(packed, np.uint32)
    return out


_TOKENS = "key long, doc long, place long, kind int"


def _slots(rows: DataFrame, bits: int) -> np.ndarray:
    """A filter of ``2 ** bits`` slots, packed: which of them the ``row`` of ``rows`` take."""
    width = (1 << bits) // SLICES
    slot = F.pmod(F.col("row"), F.lit(1 << bits))
    rows = rows.select(F.floor(slot / width).cast("int").alias("slice"), (slot % width).cast("int").alias("slot"))

    def run(table: pa.Table) -> pa.Table:
        taken = np.zeros(width, bool)
        taken[table["slot"].to_numpy()] = True
        return pa.table({"slice": table["slice"][:1], "taken": pa.array([np.packbits(taken).tobytes()], pa.binary())})

    out = np.zeros((SLICES, width // 8), np.uint8)
    found = rows.groupBy("slice").applyInArrow(run, "slice int, taken binary").toArrow()
    for number, taken in zip(found["slice"].to_pylist(), found["taken"].to_pylist()):
        out[number] = np.frombuffer(taken, np.uint8)
    return out.reshape(-1)


def _firsts(docs: DataFrame, id: str, text: str, classes: DataFrame, copies: int) -> tuple[DataFrame, np.ndarray | None]:
    """``docs`` and the slots of the rows that stand for their classes, so that ``copies`` of other rows make no n-grams.

    The filter grows with the classes up to a fixed size, and a row more that passes it does no harm. Where it would be
    too full and a good part are copies, the rows are found by a join. None stands for all slots.
    """
    if not copies:
        return docs, None
    n = classes.count()
    if 2 * n > 1 << FIRST_BITS:
        if 4 * copies > n:
            rows = classes.select(F.col("row").alias("__row"))
            docs = docs.join(rows, row_key(id, text) == F.col("__row"), "left_semi")
        return docs, None
    return docs, _slots(classes.select("row"), min(FIRST_BITS, max(NEED_BITS, (16 * n).bit_length())))


def _prefixes(docs: DataFrame, doc: Column, row: Column, text: str, ranks, first: np.ndarray | None, settings: Settings) -> DataFrame:
    """Prefix n-grams (``key``) of each document whose ``row`` takes a slot of ``first``; ``place`` is ``n << 32 | position``.

    Of the documents with equal sets in one task, one is enough.
    """
    mask = np.uint64((1 << settings.rarity_bits) - 1)
    slots = None if first is None else docs.sparkSession.sparkContext.broadcast(first)

    def grouped(key, doc, place):
        order, opens, size = local_groups(key, doc)
        shared = size > FEW
        kind = np.where(shared, SHARED, SINGLE)
        mark = order[opens & shared]
        rows = np.concatenate([order, mark])
        kinds = np.concatenate([kind, np.full(len(mark), MARK)]).astype(np.int32)
        return pa.RecordBatch.from_arrays(
            [pa.array(key[rows].view(np.int64)), pa.array(doc[rows]), pa.array(place[rows]), pa.array(kinds)],
            names=["key", "doc", "place", "kind"],
        )

    def run(batches):
        rank, seen, held, parts = ranks.value, set(), 0, []
        for batch in batches:
            if slots is not None:
                at = batch.column(2).to_numpy() % (8 * len(slots.value))
                batch = batch.filter(pa.array((slots.value[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1))
            for s, own in zip(ngram_sets(batch.column(1), settings.n), batch.column(0).to_pylist()):
                n = len(s)
                digest = hashlib.blake2b(s.tobytes(), digest_size=16).digest()
                if not n or digest in seen:
                    continue
                seen.add(digest)
                prefix = n - _needed(settings.percent, n) + 1
                often = rank[(s & mask).astype(np.int64)]
                first = np.argsort(often, kind="stable")[:prefix]  # s is sorted: ties by hash
                parts.append((s[first] & np.uint64((1 << KEY_BITS) - 1), own, n))
                held += prefix
                if held >= HELD_ROWS:
                    yield grouped(*_columns(parts))
                    held, parts = 0, []
        if parts:
            yield grouped(*_columns(parts))

    return docs.select(doc, F.col(text), row).mapInArrow(run, _TOKENS)


def _columns(parts):
    size = np.array([len(k) for k, _, _ in parts])
    position = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    place = (np.repeat(np.array([n for _, _, n in parts], np.int64), size) << 32) | position
    return np.concatenate([k for k, _, _ in parts]), np.repeat(np.array([c for _, c, _ in parts], np.int64), size), place


def _alike(place: np.ndarray, place_b: np.ndarray, percent: int) -> np.ndarray:
    """Length and positional filter of documents that share an n-gram."""
    n, m, i, j = place >> 32, place_b >> 32, place & 0xFFFFFFFF, place_b & 0xFFFFFFFF
    length = np.minimum(n, m) * 100 >= np.maximum(n, m) * percent
    most = np.minimum(i, j) + np.minimum(n - i, m - j)
    return length & (most * (100 + percent) >= (n + m) * percent)


def _distinct(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    return a[new], b[new]


def _candidates(rows: DataFrame, percent: int) -> DataFrame:
    """Pairs ``doc, other`` of n-grams with few documents; ``key, doc, place`` rows of the others."""
    names = ["key", "doc", "other", "place"]

    def pairs(parts):
        a, b = _distinct(*(np.concatenate([p[i] for p in parts]) for i in range(2)))
        none = pa.nulls(len(a), pa.int64())
        return pa.RecordBatch.from_arrays([none, pa.array(a), pa.array(b), none], names=names)

    def run(batches):
        parts, held = [], 0
        for table in whole_groups(batches):
            key, doc, place, kind = (table[c].to_numpy() for c in ("key", "doc", "place", "kind"))
            opens = np.ones(len(key), bool)
            opens[1:] = key[1:] != key[:-1]
            group = np.cumsum(opens) - 1
            met = np.bincount(group, weights=kind != SHARED)
            marked = np.bincount(group, weights=kind == MARK) > 0
            small = (met <= SMALL) & ~marked & (met == np.bincount(group))
            many = (kind == SHARED) | ((kind == SINGLE) & ~small[group] & (met > 1)[group])
            none = pa.nulls(int(many.sum()), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(key[many]), pa.array(doc[many]), none, pa.array(place[many])], names=names)
            first, size = np.flatnonzero(opens), met.astype(np.int64)
            for n in np.unique(size[small & (met > 1)]):
                at = first[small & (size == n)]
                for i in range(int(n) - 1):
                    for j in range(i + 1, int(n)):
                        fits = _alike(place[at + i], place[at + j], percent)
                        a, b = doc[at + i][fits], doc[at + j][fits]
                        parts.append((np.minimum(a, b), np.maximum(a, b)))
                        held += len(a)
            if held > HELD_ROWS:
                yield pairs(parts)
                parts, held = [], 0
        if parts:
            yield pairs(parts)

    return spread_by_key(rows).mapInArrow(run, "key long, doc long, other long, place long")


def _filters(percent: int) -> tuple[Column, Column]:
    """Length and positional filter of a pair ``place``, ``place_b`` that shares an n-gram."""
    n, m = F.shiftright("place", 32), F.shiftright("place_b", 32)
    i, j = F.col("place").bitwiseAND(0xFFFFFFFF), F.col("place_b").bitwiseAND(0xFFFFFFFF)
    length = F.least(n, m) * 100 >= F.greatest(n, m) * percent
    most = F.least(i, j) + 1 + F.least(n - i, m - j) - 1
    return length, most * (100 + percent) >= (n + m) * percent


def _pairs(left: DataFrame, right: DataFrame, percent: int, extra: Column) -> DataFrame:
    """Distinct candidate pairs ``a < b`` of rows that share ``key``."""
    length, position = _filters(percent)
    met = left.join(right, "key").where(extra & length & position)
    return met.select(F.least("doc", "doc_b").alias("a"), F.greatest("doc", "doc_b").alias("b")).distinct()


def _second(rows: DataFrame) -> DataFrame:
    return rows.select("key", F.col("doc").alias("doc_b"), F.col("place").alias("place_b"), *[F.col(c).alias(f"{c}_b") for c in rows.columns if c == "comp"])


def _counted(rows: DataFrame, name: str) -> tuple[DataFrame, int]:
    """``rows``, stored, and their number."""
    rows = stage(rows, name)
    return rows, rows.count()


def _sent(rows: DataFrame, n: int) -> DataFrame:
    """``rows``, at most ``n``, for a join with sets: few of them go to the sets, so that these stay where they are."""
    return F.broadcast(rows) if n <= SENT_ROWS else rows


class _Verifier:
    """Verified links among candidate pairs; fetches each class's set from its text once."""

    def __init__(self, docs: DataFrame, id: str, text: str, classes: DataFrame, repeated: bool, ranks, settings: Settings):
        self.docs, self.id, self.text, self.settings = docs, id, text, settings
        self.classes, self.repeated, self.ranks, self.sets = classes, repeated, ranks, None
        self.complete = False

    def near(self, pairs: DataFrame) -> DataFrame:
        """Pairs that pass the length and the suffix filter."""
        info = self.classes.select("doc", "n", "profile")
        for side in "ab":
            own = info.select(F.col("doc").alias(side), F.col("n").alias(f"n_{side}"), F.col("profile").alias(f"p_{side}"))
            pairs = pairs.join(own, side)
        percent = self.settings.percent

        def run(batches):
            for batch in batches:
                n, m, one, two = (batch.column(c).to_pylist() for c in ("n_a", "n_b", "p_a", "p_b"))
                keep = [
                    100 * min(x, y) >= percent * max(x, y)
                    and (x + y - least_difference(p, q)) // 2 * (100 + percent) >= (x + y) * percent
                    for x, y, p, q in zip(n, m, one, two)
                ]
                yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

        return pairs.mapInArrow(run, "a long, b long")

    def _fetch(self, pairs: DataFrame) -> None:
        need = pairs.select(F.explode(F.array("a", "b")).alias("row")).distinct()
        if self.sets is not None:
            need = need.join(self.sets.select("row"), "row", "left_anti")
        need, asked = _counted(need, "needed-rows")
        if not asked:
            return
        # A filter of fixed size turns most other texts away, so nothing needs to be shuffled here; the
        # sets of a few texts more do no harm.
        slots = 1 << NEED_BITS
        slot = F.pmod(F.col("row"), F.lit(slots))
        wanted = np.zeros(slots, bool)
        wanted[need.select(slot.alias("s")).distinct().toArrow()["s"].to_numpy()] = True
        shared, n = self.docs.sparkSession.sparkContext.broadcast(wanted), self.settings.n

        def run(batches):
            wanted = shared.value
            for batch in batches:
                for part in _slices(batch.filter(pa.array(wanted[batch.column(0).to_numpy() % slots]))):
                    sets = [s.tobytes() for s in ngram_sets(part.column(1), n)]
                    yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sets, pa.binary())], names=["row", "set"])

        texts = self.docs.select(row_key(self.id, self.text).alias("row"), F.col(self.text).alias("__text"))
        got = texts.mapInArrow(run, "row long, set binary").join(_sent(need, asked), "row", "left_semi")
        # Rows that repeat an id and a text share a row key: one of them is enough.
        got = stage(got.dropDuplicates(["row"]) if self.repeated else got, "ngram-sets")
        self.sets = got if self.sets is None else self.sets.unionByName(got)

    def fetch_all(self, docs: DataFrame) -> None:
        """Fetches the sets of ``doc``, after which ``links`` and ``rest`` ask for no others."""
        rows = stage(docs.distinct().join(self.classes.select("doc", "row"), "doc"), "open-documents")
        self._fetch(rows.select(F.col("row").alias("a"), F.col("row").alias("b")))
        self.complete = True

    def links(self, pairs: DataFrame) -> DataFrame:
        """The links among ``pairs``."""
        rows = self.classes.select("doc", "row")
        for side in "ab":
            own = rows.select(F.col("doc").alias(f"doc_{side}"), F.col("row").alias(side))
            pairs = pairs.withColumnRenamed(side, f"doc_{side}").join(own, f"doc_{side}")
        pairs, met = _counted(pairs, "candidates")
        if met and not self.complete:
            self._fetch(pairs)
        if not met or self.sets is None:
            return pairs.select(F.col("doc_a").alias("a"), F.col("doc_b").alias("b"))
        one = self.sets.select(F.col("row").alias("a"), F.col("set").alias("s_a"))
        two = self.sets.select(F.col("row").alias("b"), F.col("set").alias("s_b"))
        if met <= SENT_ROWS:
            two = two.join(F.broadcast(pairs.select("b").distinct()), "b", "left_semi")
        pairs = one.join(_sent(pairs, met), "a").join(two, "b")
        percent = self.settings.percent

        def run(batches):
            for batch in batches:
                keep = []
                for one, two in zip(_arrays(batch.column("s_a")), _arrays(batch.column("s_b"))):
                    at = np.searchsorted(one, two)
                    at[at == len(one)] = 0
                    same = int((one[at] == two).sum())
                    keep.append(same * (100 + percent) >= percent * (len(one) + len(two)))
                yield batch.select(["doc_a", "doc_b"]).filter(pa.array(keep, pa.bool_()))

        found = pairs.mapInArrow(run, "doc_a long, doc_b long")
        return stage(found.select(F.col("doc_a").alias("a"), F.col("doc_b").alias("b")), "links")

    def meet(self, many: DataFrame) -> tuple[DataFrame | None, DataFrame | None]:
        """The links of meetings that fit blocks, of rows ``key, doc, comp, pivot`` of open n-grams, and the rows of the others.

        A pivot stands for its n-gram. Links may be those of a component, not of a pair. None stands for no rows.
        """
        named = components(many, "doc", "pivot").select(F.col("node").alias("doc"), F.col("component").alias("meeting"))
        named = named.join(many.select("doc", "comp").distinct(), "doc").join(self.classes.select("doc", "row", "n"), "doc")
        named = stage(named, "meetings")
        parts = named.groupBy("meeting", "comp").agg(F.count("*").alias("docs"), F.sum("n").alias("grams"))
        sizes = parts.groupBy("meeting").agg(
            F.max(F.struct("docs", "grams", "comp")).alias("top"), F.sum("docs").alias("docs"), F.sum("grams").alias("grams")
        )

        def blocks(docs: Column, grams: Column) -> Column:
            return F.greatest(F.ceil(docs / BLOCK_DOCS), F.ceil(grams / BLOCK_GRAMS)).cast("int")

        sizes = sizes.select(
            "meeting", F.col("top.comp").alias("top"), blocks(F.col("top.docs"), F.col("top.grams")).alias("inside"),
            blocks(F.col("docs") - F.col("top.docs"), F.col("grams") - F.col("top.grams")).alias("outside"),
        )
        sizes, n = _counted(sizes, "meeting-sizes")
        fits = sizes.where(F.col("outside") <= BLOCKS)
        fit = fits.count()
        found = left = None
        if fit:
            own = named.join(_sent(fits, n), "meeting")
            if not self.complete:
                self._fetch(own.select(F.col("row").alias("a"), F.col("row").alias("b")))
            found = self._between(own)
        if fit < n:
            large = named.join(_sent(sizes.where(F.col("outside") > BLOCKS), n), "meeting").select("doc")
            left = many.join(large, "doc", "left_semi")
        return found, left

    def _between(self, docs: DataFrame) -> DataFrame:
        """Links of different components among ``doc, row, comp`` of a ``meeting``, by its blocks ``inside`` and ``outside``
        of the component ``top``."""
        apart, hashed = F.col("comp") != F.col("top"), F.xxhash64("doc")
        block = F.when(apart, F.pmod(hashed, "outside")).otherwise(F.col("outside") + F.pmod(hashed, F.greatest("inside", F.lit(1))))
        # Outside the largest component a block meets all blocks, inside only those outside.
        last = F.when(apart, F.col("inside")).otherwise(0) + F.col("outside") - 1
        docs = docs.select("meeting", "doc", "row", "comp", block.cast("int").alias("block"), last.cast("int").alias("last"))
        docs, n = _counted(docs, "blocks")
        own = self.sets.join(_sent(docs, n), "row").withColumn("other", F.explode(F.sequence(F.lit(0), "last")))
        own = own.select("meeting", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"), "doc", "comp", "block", "set")
        percent = self.settings.percent

        def run(table: pa.Table) -> pa.Table:
            doc, comp, block = (table[c].to_numpy() for c in ("doc", "comp", "block"))
            sets = list(_arrays(table["set"]))
            left, right = (np.flatnonzero(block == table[c][0].as_py()) for c in "xy")
            size = np.array([len(s) for s in sets])
            alike = overlaps(sets, left, right) * (100 + percent) >= (size[left][:, None] + size[right]) * percent
            i, j = np.nonzero(alike & (comp[left][:, None] != comp[right]))
            node, low = smallest_linked(doc[left[i]], doc[right[j]])
            return pa.table({"a": low[node != low], "b": node[node != low]})

        return stage(own.groupBy("meeting", "x", "y").applyInArrow(run, "a long, b long"), "block-links")

    def rest(self, pairs: DataFrame) -> DataFrame:
        """Sets against their pivots, of distinct pairs ``pivot, doc, apart``: a row with a null ``key`` for a link of two that
        are ``apart``, and a row ``key, doc, place`` for each of the first n-grams that the pivot lacks."""
        rows = self.classes.select("doc", "row")
        of_pivot = pairs.groupBy("pivot").agg(F.ceil(F.count("*") / SALTED).cast("int").alias("salts"))
        of_pivot = of_pivot.join(rows.select(F.col("doc").alias("pivot"), F.col("row").alias("b")), "pivot")
        pairs = pairs.join(rows.withColumnRenamed("row", "a"), "doc").join(of_pivot, "pivot")
        pairs, met = _counted(pairs, "pivots")
        if met and not self.complete:
            self._fetch(pairs)
        if not met or self.sets is None:
            return pairs.select(F.lit(None).cast("long").alias("key"), "doc", "pivot", F.lit(0).cast("long").alias("place"))
        salted = _sent(pairs.select("pivot", "b", "salts").distinct(), met)
        salted = self.sets.withColumnsRenamed({"row": "b", "set": "s_b"}).join(salted, "b")
        salted = salted.select("pivot", "s_b", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
        own = pairs.withColumn("salt", F.pmod(F.xxhash64("doc"), "salts").cast("int"))
        own = _sent(own.select("a", "doc", "pivot", "salt", "apart"), met)
        own = self.sets.withColumnsRenamed({"row": "a", "set": "s_a"}).join(own, "a")
        percent, ranks = self.settings.percent, self.ranks
        mask = np.uint64((1 << self.settings.rarity_bits) - 1)

        def run(batches):
            rank = ranks.value
            for part in (part for batch in batches for part in _slices(batch)):
                columns = [[np.zeros(0, np.int64)] for _ in range(4)]
                named = (part.column(c).to_pylist() for c in ("doc", "pivot", "apart"))
                for doc, pivot, apart, one, two in zip(*named, _arrays(part.column("s_a")), _arrays(part.column("s_b"))):
                    at = np.searchsorted(two, one)
                    at[at == len(two)] = 0
                    other = one[two[at] != one]
                    n, m, same = len(one), len(two), len(one) - len(other)
                    short = 1
                    alike = same * (100 + percent) >= percent * (n + m)
                    if not alike:
                        short = -(-percent * (n + max(m, _needed(percent, n))) // (100 + percent)) - same
                    first = np.argsort(rank[(other & mask).astype(np.int64)], kind="stable")[: max(0, len(other) - short + 1)]
                    key = mix(other[first] + mix(np.array([pivot]).view(np.uint64))).view(np.int64)
                    key = np.concatenate([key, np.zeros(int(alike and apart), np.int64)])
                    place = np.full(len(key), n << 32)
                    place[len(first) :] = -1
                    for column, values in zip(columns, (key, np.full(len(key), doc), np.full(len(key), pivot), place)):
                        column.append(values)
                key, doc, pivot, place = (np.concatenate(c) for c in columns)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key, mask=place < 0), pa.array(doc), pa.array(pivot), pa.array(place)], names=["key", "doc", "pivot", "place"]
                )

        met = own.join(salted, ["pivot", "salt"]).select("doc", "pivot", "apart", "s_a", "s_b")
        return stage(met.mapInArrow(run, "key long, doc long, pivot long, place long"), "rest-ngrams")


def _named(rows: DataFrame, labels: DataFrame | None) -> DataFrame:
    """``rows`` with the component ``comp`` of ``doc``."""
    if labels is None:
        return rows.withColumn("comp", F.col("doc"))
    own = labels.select(F.col("node").alias("doc"), F.col("component").alias("comp"))
    return rows.join(own, "doc", "left").withColumn("comp", F.coalesce("comp", "doc"))


def _merged(labels: DataFrame | None, links: DataFrame) -> DataFrame:
    """``labels`` after ``links`` between components: their components are those of the components' names."""
    if labels is None:
        return components(links)
    ends = links
    for side in "ab":
        own = labels.select(F.col("node").alias(side), F.col("component").alias(f"comp_{side}"))
        ends = ends.join(own, side, "left").withColumn(f"comp_{side}", F.coalesce(f"comp_{side}", side))
    new = components(ends, "comp_a", "comp_b").select(F.col("node").alias("component"), F.col("component").alias("low"))
    moved = labels.join(new, "component", "left").select("node", F.coalesce("low", "component").alias("component"))
    # A document without links so far is a component of its own, which only ``new`` names.
    alone = new.join(labels.select(F.col("node").alias("component")), "component", "left_anti")
    return stage(moved.unionByName(alone.select(F.col("component").alias("node"), F.col("low").alias("component"))), "labels")


def _components(pairs: DataFrame, shared: DataFrame, verify: _Verifier, settings: Settings) -> DataFrame:
    """``node, component`` of all documents that link with another one."""
    labels = None
    number = 0
    while True:
        now = _named(shared, labels)
        order = F.col("doc") if number == 0 else F.xxhash64("key", "doc", F.lit(number))
        parts = now.groupBy("key", "comp").agg(
            F.count("*").alias("n"), F.min(F.struct(order.alias("o"), "doc", "place", "comp")).alias("one"),
            F.min(F.struct(F.shiftright("place", 32).alias("n"), "doc", "comp")).alias("least"),
        )
        groups = parts.groupBy("key").agg(
            F.count("*").alias("comps"), F.sum("n").alias("met"), F.max(F.struct("n", "comp")).alias("top"),
            F.min("one").alias("one"), F.min("least").alias("least"),
        )
        open_ = groups.where("comps > 1").select(
            "key", (F.col("met") - F.col("top.n") <= SMALL).alias("few"), F.col("top.comp").alias("top"), F.col("one.doc").alias("doc_b"),
            F.col("one.place").alias("place_b"), F.col("one.comp").alias("comp_b"), F.col("least.doc").alias("pivot"),
            F.col("least.comp").alias("comp_pivot"),
        )
        left = stage(now.join(open_, "key"), "open-ngrams")
        if number and left.isEmpty():
            return labels
        last = number >= settings.rounds
        if not last:
            # One partner for each n-gram: the same for most n-grams of a group at first, then
            # another one for each n-gram.
            length, position = _filters(settings.percent)
            met = left.where((F.col("comp") != F.col("comp_b")) & length & position)
            more = met.select(F.least("doc", "doc_b").alias("a"), F.greatest("doc", "doc_b").alias("b"))
        else:
            # Few documents outside the largest component of an n-gram meet all its documents.
            few = left.where("few").select("key", "doc", "place", "comp", "top")
            apart = (F.col("comp") != F.col("comp_b")) & ((F.col("comp_b") == F.col("top")) | (F.col("doc") < F.col("doc_b")))
            more = _pairs(few.where("comp <> top"), _second(few.drop("top")), settings.percent, apart)
            # The documents of later levels are among those of this one.
            if number and not verify.complete:
                verify.fetch_all(left.select("doc"))
        found = verify.links(verify.near((more if number else more.unionByName(pairs)).distinct()))
        if last:
            many, met = _counted(left.where(~F.col("few")).select("key", "doc", "comp", "pivot", "comp_pivot"), "many-ngrams")
            inside, large = verify.meet(many) if met else (None, None)
            found = found if inside is None else found.unionByName(inside)
            if large is not None:
                large = large.where(F.col("doc") != F.col("pivot"))
                met = large.select("pivot", "doc", (F.col("comp") != F.col("comp_pivot")).alias("apart")).distinct()
                rest = verify.rest(met)
                found = found.unionByName(rest.where("key is null").select(F.col("doc").alias("a"), F.col("pivot").alias("b")))
                shared = rest.where("key is not null").select("key", "doc", "place")
        # All links found join two components; without any, the components stand.
        if labels is None or not found.isEmpty():
            labels = _merged(labels, found)
        if last and large is None:
            return labels
        number += 1


def join(docs: DataFrame, id: str = "doc_id", text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """``row, id, n, component`` for every row of ``docs``; ``row`` is a hash of id and text."""
    found = stage(_members(docs, id, text, settings), "ngram-members")
    rank = _rarity(found.where("kind = 1").select("one", "profile"), settings.rarity_bits)
    # Whole-number ids that name one text each are used as they are, else a hash of id and text.
    members = found.where("kind = 0").drop("kind")
    whole = isinstance(members.schema["id"].dataType, (T.LongType, T.IntegerType, T.ShortType, T.ByteType))
    own = members.where("n > 0").groupBy("id").agg(F.count("*").alias("n"), F.min("row").alias("x"), F.max("row").alias("y"))
    odd, repeated, texts = own.agg(F.count_if(F.expr("id is null or x <> y")), F.count_if(F.expr("n > 1")), F.sum("n")).first()
    whole = whole and not odd
    members = members.withColumn("doc", (F.col("id") if whole else F.col("row")).cast("long"))
    classes = members.where("n > 0").groupBy("one", "two").agg(
        F.min(F.struct("doc", "row")).alias("first"), F.min("n").alias("n"), F.min("profile").alias("profile"), F.min("id").alias("id")
    )
    classes = stage(classes.select("one", "two", "first.doc", "first.row", "n", "profile", "id"), "ngram-classes")

    key = F.col(id) if whole else row_key(id, text)
    ranks = docs.sparkSession.sparkContext.broadcast(rank)
    source, first = _firsts(docs, id, text, classes, (texts or 0) - classes.count())
    tokens = _prefixes(source, key.cast("long"), row_key(id, text), text, ranks, first, settings)
    found = stage(_candidates(tokens, settings.percent), "ngram-candidates")
    named = members.where("n > 0").select("doc", "one", "two").distinct()
    named = named.join(classes.select("one", "two", F.col("doc").alias("class")), ["one", "two"])
    named = stage(named.select("doc", "class"), "class-names")
    pairs = found.where("key is null").select(F.col("doc").alias("x"), F.col("other").alias("y")).distinct()
    for side in "xy":
        pairs = pairs.join(named.select(F.col("doc").alias(side), F.col("class").alias(f"class_{side}")), side)
    pairs = pairs.where("class_x <> class_y").select(
        F.least("class_x", "class_y").alias("a"), F.greatest("class_x", "class_y").alias("b")
    ).distinct()
    many = found.where("key is not null").join(named, "doc").select("key", F.col("class").alias("doc"), "place").distinct()
    many = stage(many, "shared-ngrams")
    verify = _Verifier(docs, id, text, classes, repeated > 0, ranks, settings)
    labels = _components(pairs, many, verify, settings)

    rooted = classes.select("one", "two", "id", F.col("doc").alias("node"))
    rooted = rooted.join(labels, "node", "left")
    rooted = stage(rooted.select("one", "two", "id", F.coalesce("component", "node").alias("root")), "ngram-roots")
    smallest = rooted.groupBy("root").agg(F.min("id").alias("component"))
    rooted = rooted.join(smallest, "root").select("one", "two", "component")
    out = members.join(rooted, ["one", "two"], "left")
    return out.select("row", "id", "n", F.coalesce("component", "id").alias("component"))


def keep_one(docs: DataFrame, id: str = "doc_id", text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """The rows of ``docs`` that stand for their components: those with the smallest id.

    Of rows that repeat an id, the one with the smallest row key stays, once. Documents without
    words all stay.
    """
    joined = join(docs, id, text, settings)
    first = joined.where("n > 0").groupBy("component").agg(F.min(F.struct("id", "row")).alias("first"))
    kept = first.select(F.col("first.row").alias("__row"), F.lit(False).alias("__bare"))
    bare = joined.where("n = 0").select(F.col("row").alias("__row"), F.lit(True).alias("__bare"))
    kept = stage(kept.unionByName(bare).distinct(), "kept-rows")
    out = docs.withColumn("__row", row_key(id, text)).join(kept, "__row")
    again = joined.where("n > 0").groupBy("row").count().where("count > 1")
    if not again.isEmpty():
        out = out.where(~F.col("__bare")).dropDuplicates(["__row"]).unionByName(out.where("__bare"))
    return out.drop("__row", "__bare")
