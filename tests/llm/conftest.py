from __future__ import annotations

import re

import pytest

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SMALL = "/root/testdata/sf0.001"

# Texts of every odd kind; the ids repeat, and one is missing. Extra columns carry the names that operators use inside.
ODD = [
    (1, None),
    (2, ""),
    (3, "  \t\n "),
    (4, "word"),
    (5, "one two three four five six seven eight nine ten eleven twelve"),
    (5, "one two three four five six seven eight nine ten eleven twelve"),
    (6, "Éà ÜBER straße 日本語  x y \U0001f600‍ end"),
    (7, "a" * 3000 + " " + "b, " * 3000),
    (8, "<|endoftext|> don't  stop\n\n\n'll 123 <|endoftext|>"),
    (None, "a text without an id, but with words"),
]
EXTRA = {"id": 0, "body": "b", "key": 1, "copy": 2, "n": 3, "k0": "k", "score": 0.5, "row": 9, "kinds": "k", "w": "w", "block": 7}


@pytest.fixture(scope="session")
def odd(spark):
    rows = [(i, t, *EXTRA.values()) for i, t in ODD]
    kinds = {int: "long", str: "string", float: "double"}
    schema = "doc_id long, text string, " + ", ".join(f"{n} {kinds[type(v)]}" for n, v in EXTRA.items())
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(scope="session")
def texts(documents):
    return {row.doc_id: row.text or "" for row in documents.select("doc_id", "text").collect()}


def words(text: str | None) -> list[str]:
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def spaced(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
