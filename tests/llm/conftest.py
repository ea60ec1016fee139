from __future__ import annotations

import re

import pytest

from hearthline.llm.queries import importable

_LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.fixture(autouse=True, scope="session")
def _workers(spark):
    importable(spark)


def spaced(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(_LOW))


def plain(text: str | None) -> list[str]:
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(_LOW))


def prose(random, n: int, words: int = 400) -> str:
    return " ".join(f"w{random.randrange(words)}" for _ in range(n))
