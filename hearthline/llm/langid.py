"""Language identification: multinomial naive Bayes over hashed character n-grams.

Learning counts hashed n-grams per language over every learnable text, in numpy inside each
task, and Spark sums the counts. The log-probability matrix (languages x buckets, a fixed number
of buckets) is broadcast, and texts are scored batch by batch.

Defined results: a null text, an empty text and a text without any letter are ``und`` with score
0; a text that the model ties on gets the first language in code-point order; without learnable
rows every text is ``und``. Repeated rows are scored each. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from hearthline.llm.textwords import LOWER, chunks, mix

_LETTER = regex.compile(r"\p{L}")
UNKNOWN = "und"

# Digits, punctuation and control characters all read as a space: they tell no language.
_FOLD = LOWER.copy()
_FOLD[_FOLD < 0x61] = 0x20
_FOLD[0x7B:0x80] = 0x20


@dataclass(frozen=True)
class Settings:
    sizes: tuple[int, ...] = (1, 2, 3)  # n-gram lengths, in bytes of lower-cased UTF-8
    buckets: int = 1 << 14
    smoothing: float = 0.5
    max_languages: int = 500  # the matrix is broadcast: more languages than this are an error


def _has_letter(data: np.ndarray) -> bool:
    lower = LOWER[data]
    if bool(((lower >= 0x61) & (lower <= 0x7A)).any()):
        return True
    return bool((data >= 0x80).any()) and bool(_LETTER.search(data.tobytes().decode("utf-8")))


def _buckets(chunk, settings: Settings) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each n-gram length: buckets of all n-grams in the chunk, and the text of each."""
    data = _FOLD[chunk.data]
    owner = np.repeat(np.arange(len(chunk)), np.diff(chunk.starts))
    for size in settings.sizes:
        n = len(data) - size + 1
        if n <= 0:
            continue
        code = np.zeros(n, np.uint32)
        for i in range(size):
            code = (code << np.uint32(8)) | data[i : i + n]
        keep = owner[:n] == owner[size - 1 :]
        keep &= code != np.uint32(int.from_bytes(b" " * size, "big"))
        code = code[keep].astype(np.uint64) + np.uint64(size << 40)
        yield (mix(code) % np.uint64(settings.buckets)).astype(np.int64), owner[:n][keep]


def count_ngrams(docs: DataFrame, text: str, lang: str, settings: Settings) -> DataFrame:
    """``lang, bucket, n`` summed over all texts; rows with a null language are left out."""
    width = settings.buckets

    def count(batches):
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            names = batch.column(1).to_pylist()
            codes = {v: i for i, v in enumerate(dict.fromkeys(names))}
            number = np.array([codes[v] for v in names], np.int64)
            sums = np.zeros((len(codes), width), np.int64)
            for chunk in chunks(batch.column(0)):
                own = number[chunk.first : chunk.first + len(chunk)]
                for bucket, owner in _buckets(chunk, settings):
                    flat = np.bincount(own[owner] * width + bucket, minlength=sums.size)
                    sums += flat.reshape(sums.shape)
            for name, i in codes.items():
                totals[name] = totals.get(name, 0) + sums[i]
        for name, row in totals.items():
            at = np.flatnonzero(row)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(row[at])],
                names=["lang", "bucket", "n"],
            )

    known = docs.select(F.col(text).alias("text"), F.col(lang).alias("lang"))
    known = known.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    counted = known.mapInArrow(count, "lang string, bucket int, n long")
    return counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


@dataclass(frozen=True)
class Model:
    languages: list[str]
    logs: np.ndarray  # buckets x languages
    settings: Settings


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", settings: Settings = Settings()):
    """Count over all of ``docs`` and build the model; languages have equal priors."""
    from hearthline.sources.stages import stage

    counts = stage(count_ngrams(docs, text, lang, settings), "language-counts")
    names = counts.select("lang").distinct().limit(settings.max_languages + 1).collect()
    if len(names) > settings.max_languages:
        raise ValueError(f"more than {settings.max_languages} languages")
    languages = sorted(r.lang for r in names)
    found = counts.toArrow()  # at most languages x buckets rows
    table = np.zeros((settings.buckets, len(languages)))
    if len(found):
        order = {v: i for i, v in enumerate(languages)}
        column = np.array([order[v] for v in found["lang"].to_pylist()])
        table[found["bucket"].to_numpy(), column] = found["n"].to_numpy()
    table += settings.smoothing
    logs = (np.log(table) - np.log(table.sum(axis=0))).astype(np.float32) if languages else table
    return Model(languages, logs, settings)


def identify(docs: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None,
             pred: str = "lang_pred", score: str = "score") -> DataFrame:
    """``keep`` columns with ``pred`` and ``score``: the chosen language and its share.

    The new columns replace kept ones of the same name.

    The score is the posterior of the chosen language after the summed log-probabilities are
    tempered by the square root of the number of n-grams: those of one text aren't independent.
    """
    keep = [c for c in (docs.columns if keep is None else keep) if c not in (pred, score)]
    shared = docs.sparkSession.sparkContext.broadcast(model)
    source = docs.select(F.col(text).alias("__text"), *keep)
    schema = source.select(*keep).schema.add(pred, "string").add(score, "double")

    def judge(batches):
        model = shared.value
        names = np.array([*model.languages, UNKNOWN], object)
        for batch in batches:
            chosen, share = [], []
            for chunk in chunks(batch.column(0)):
                n = len(chunk)
                sums, total = np.zeros((n, len(model.languages))), np.zeros(n)
                for bucket, owner in _buckets(chunk, model.settings):
                    if not len(owner) or not model.languages:
                        continue
                    first = np.flatnonzero(np.diff(owner, prepend=-1))
                    sums[owner[first]] += np.add.reduceat(
                        model.logs[bucket], first, axis=0, dtype=np.float64
                    )
                    total += np.bincount(owner, minlength=n)
                lettered = np.array(
                    [_has_letter(chunk.data[a:b]) for a, b in zip(chunk.starts[:-1], chunk.starts[1:])]
                )
                if model.languages:
                    z = sums / np.sqrt(np.maximum(total, 1))[:, None]
                    z = np.exp(z - z.max(axis=1, keepdims=True))
                    best = z.argmax(axis=1)
                    top = z.max(axis=1) / z.sum(axis=1)
                else:
                    best, top = np.zeros(n, int), np.zeros(n)
                known = lettered & bool(model.languages)
                chosen.append(names[np.where(known, best, len(names) - 1)])
                share.append(np.where(known, top, 0.0))
            if chosen:
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[1:], pa.array(np.concatenate(chosen), pa.string()), pa.array(np.concatenate(share))],
                    names=[*keep, pred, score],
                )

    return source.mapInArrow(judge, schema)


def held_out(id_column: str):
    """Rows whose labels must not be learned from."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_column).cast("string")), F.lit(4)) == 2, F.lit(False))
