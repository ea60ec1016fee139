"""URL filters: glob rules run as one bit-parallel Shift-And automaton.

All rules are packed into the bits of several 64-bit words. One step per byte of the URL moves
every rule at once: ``D = ((D << 1) & B[c]) | (D & S[c])``, where ``B[c]`` has the positions that
the byte fits and ``S[c]`` the wildcard positions that may stay on it. Steps run over all URLs of a
batch together, so the cost per byte doesn't depend on the number of URLs in Python.

The canonical URL is ``host#path``, as neither part can hold a ``#``. Glob syntax: ``*`` is any run of
bytes and ``**.`` at the front is any run of host labels, which doesn't leave the host. Every glob matches
from the start of the canonical URL and holds as soon as its last byte is reached.

Defined results: a URL that is null or has no ``://`` has empty host and path and matches no rule;
of the rules that match, the longest counts, then the earlier one. Repeated rows are judged each.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from hearthline.llm.textwords import chunks


@dataclass(frozen=True)
class Rule:
    name: str
    verdict: str
    globs: tuple[str, ...]


def host_rule(host: str, path: str, verdict: str) -> Rule:
    """A rule for a host, all its subdomains, and paths that start with ``path``."""
    return Rule(host + path, verdict, (f"{host}#{path}", f"**.{host}#{path}"))


class Automaton:
    """Masks of all rules. Bits of one glob are consecutive; no bit leaks into the next glob."""

    def __init__(self, rules: list[Rule]):
        cells: list[tuple[int | None, np.ndarray]] = []  # byte (None: any), bytes that may stay
        first, last, owner = [], [], []
        none, any_byte = np.zeros(256, bool), np.ones(256, bool)
        host_byte = any_byte.copy()
        host_byte[ord("#")] = False
        for number, rule in enumerate(rules):
            for glob in rule.globs:
                stay, text = none, glob.encode()
                if text.startswith(b"**."):
                    stay, text = host_byte, text[2:]
                while text.startswith(b"*"):
                    stay, text = any_byte, text[1:]
                first.append(len(cells))
                cells.append((None, stay))  # the place before the first byte
                for part, byte in enumerate(text):
                    if byte == ord("*"):
                        cells[-1] = (cells[-1][0], any_byte)
                    else:
                        cells.append((byte, none))
                last.append(len(cells) - 1)
                owner.append(number)
        self.words = max(1, -(-len(cells) // 64))
        self.move = np.zeros((256, self.words), np.uint64)
        self.stay = np.zeros((256, self.words), np.uint64)
        self.start = np.zeros(self.words, np.uint64)
        for at, (byte, stay) in enumerate(cells):
            word, bit = divmod(at, 64)
            if byte is not None:
                self.move[byte, word] |= np.uint64(1 << bit)
            self.stay[stay, word] |= np.uint64(1 << bit)
        for at in first:
            self.start[at // 64] |= np.uint64(1 << (at % 64))
        self.last, self.owner, self.rules = last, owner, rules

    def run(self, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """A row of accepted places for each text; texts are ``data[starts[i]:starts[i + 1]]``."""
        length = np.diff(starts)
        order = np.argsort(-length, kind="stable")  # those that have ended stand at the end
        begin, length = starts[:-1][order], length[order]
        state = np.broadcast_to(self.start, (len(length), self.words)).copy()
        seen = state.copy()
        one, top = np.uint64(1), np.uint64(63)
        for step in range(int(length[0]) if len(length) else 0):
            n = int(np.searchsorted(-length, -step, "left"))  # texts longer than this step
            byte = data[begin[:n] + step]
            now = state[:n]
            moved = now << one
            moved[:, 1:] |= now[:, :-1] >> top
            state[:n] = (moved & self.move[byte]) | (now & self.stay[byte])
            seen[:n] |= state[:n]
        out = np.empty_like(seen)
        out[order] = seen
        return out

    def best(self, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """The number of the longest rule that matches each text, or -1."""
        seen = self.run(data, starts)
        found = np.full(len(seen), -1)
        size = np.full(len(seen), -1)
        for at, number in zip(self.last, self.owner):
            hit = (seen[:, at // 64] >> np.uint64(at % 64)) & np.uint64(1)
            longer = hit.astype(bool) & (len(self.rules[number].name) > size)
            found[longer], size[longer] = number, len(self.rules[number].name)
        return found


def canonical(url: str):
    """Columns ``host`` and ``path`` of a URL column."""
    col = F.coalesce(F.col(url), F.lit(""))
    rest = F.when(col.contains("://"), F.expr(f"substr(`{url}`, instr(`{url}`, '://') + 3)")).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.translate(host, upper, lower), path


def judge(pages: DataFrame, rules: list[Rule], url: str = "url", keep: list[str] | None = None,
          default: str = "allow", no_host: str = "block") -> DataFrame:
    """``keep`` columns with ``host``, ``path``, ``rule`` and ``verdict``, which replace kept ones.

    A URL that no rule fits gets ``default``, or ``no_host`` if it names no host.
    """
    keep = [c for c in (pages.columns if keep is None else keep) if c not in ("host", "path", "rule", "verdict")]
    host, path = canonical(url)
    source = pages.select(*[F.col(c) for c in keep], host.alias("__host"), path.alias("__path"))
    schema = T.StructType([*source.schema.fields, T.StructField("__rule", T.IntegerType())])
    n = len(keep)

    def match(batches):
        automaton = Automaton(rules)
        for batch in batches:
            whole = pc.binary_join_element_wise(
                batch.column(n).cast(pa.large_string()), batch.column(n + 1).cast(pa.large_string()), pa.scalar("#", pa.large_string())
            )
            found = [automaton.best(c.data, c.starts) for c in chunks(whole)]
            number = np.concatenate(found) if found else np.zeros(0, int)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(number, pa.int32())], names=schema.fieldNames()
            )

    names = F.array(*[F.lit(r.name) for r in rules]) if rules else F.array().cast("array<string>")
    verdicts = F.array(*[F.lit(r.verdict) for r in rules]) if rules else F.array().cast("array<string>")
    other = F.when(F.col("__host") == "", no_host).otherwise(default)
    return source.mapInArrow(match, schema).select(
        *keep,
        F.col("__host").alias("host"),
        F.col("__path").alias("path"),
        F.get(names, F.col("__rule")).alias("rule"),
        F.coalesce(F.get(verdicts, F.col("__rule")), other).alias("verdict"),
    )
