"""What the operators share: the registry, tables, words and bounded memos."""

from __future__ import annotations

import re
import sys
import types
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

_ALNUM_WORDS = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under ``name``, with its SQL twin if there is one."""
    def add(run: Query) -> Query:
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return add


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Columns of a supplied table."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def carried(df: DataFrame, **named: Column) -> DataFrame:
    """All columns of ``df`` as the struct ``_row``, next to the named ones.

    Columns of the caller cannot clash with those of an operator; ``select("_row.*")`` brings them back.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns]) if df.columns else F.struct(F.lit(1).alias("_"))
    return df.select(row.alias("_row"), *[c.alias(n) for n, c in named.items()])


def encoded(text: str | None) -> bytes:
    """UTF-8 of a text; null is empty, and lone surrogates become question marks."""
    return (text or "").encode("utf-8", "replace")


def space_words(raw: bytes) -> list[bytes]:
    """Words between ASCII white space.

    ``bytes.split`` splits at the same six characters.
    """
    return raw.split()


def alnum_words(raw: bytes) -> list[bytes]:
    """ASCII letters, digits and all non-ASCII characters, in runs."""
    return _ALNUM_WORDS.findall(raw)


class Memo(dict):
    """Results by key, of which at most twice ``limit`` are held.

    When ``limit`` keys are there they become the old generation, from which those
    that come again are taken over; what was old before goes.
    """

    def __init__(self, compute: Callable, limit: int = 200_000) -> None:
        super().__init__()
        self.compute, self.limit, self.old = compute, limit, {}

    def __missing__(self, key):
        if len(self) >= self.limit:
            self.old = self.copy()
            self.clear()
        value = self.old.get(key)
        if value is None:
            value = self.compute(key)
        self[key] = value
        return value


    def fill(self, keys: Iterable, many: Callable) -> None:
        """Hold the results of ``keys``; those that are new come from ``many``, which takes all of them at once."""
        missing = [k for k in keys if k not in self]
        if len(self) + len(missing) > self.limit:
            self.old = self.copy()
            self.clear()
            missing = list(keys)
        new = []
        for k in missing:
            value = self.old.get(k)
            if value is None:
                new.append(k)
            else:
                self[k] = value
        self.update(zip(new, many(new), strict=True))


def groups_of(texts: Iterable[str], size: int = 1 << 19) -> Iterator[list[str]]:
    """Texts in groups of about ``size`` characters; a longer one is a group of its own."""
    group, held = [], 0
    for t in texts:
        if group and held + len(t) > size:
            yield group
            group, held = [], 0
        group.append(t)
        held += len(t)
    if group:
        yield group


def per_worker(name: str, make: Callable):
    """What ``make`` builds, built once in each Python worker and kept for its later tasks."""
    module = sys.modules.setdefault("_clickroll_llm_worker", types.ModuleType("_clickroll_llm_worker"))
    if name not in module.__dict__:
        module.__dict__[name] = make()
    return module.__dict__[name]


def word_hashes(seed: int = 0) -> Memo:
    """64-bit hashes of words."""
    return Memo(lambda w: xxhash.xxh3_64_intdigest(w, seed))


def hashes_of(words: list[bytes], memo: Memo) -> np.ndarray:
    return np.fromiter(map(memo.__getitem__, words), np.uint64, len(words))


def rows_of(batches: Iterable, *names: str) -> Iterator[tuple]:
    """Rows of Arrow batches, one at a time, so one long text is held at once."""
    for batch in batches:
        columns = [batch.column(batch.schema.get_field_index(n)) for n in names]
        for i in range(batch.num_rows):
            yield tuple(c[i].as_py() for c in columns)
