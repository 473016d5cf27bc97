"""Small helpers that several operators of this subpackage share."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.operators.storage import stored

__all__ = ["stored", "text_of", "content_key", "clean_text", "plain", "release_memory", "releasing"]


def plain(name: str) -> Column:
    """The column of exactly this name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def clean_text(name: str = "text") -> Column:
    """The text, with NULL as an empty one."""
    return F.coalesce(plain(name).cast("string"), F.lit(""))


def content_key(name: str = "text") -> Column:
    """A 128-bit key of the text: equal texts, and only they, share it."""
    return F.unhex(F.md5(clean_text(name)))


def text_of(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Just the two columns that operators read, under fixed names; other columns cannot clash with anything."""
    return docs.select(plain(doc_id).alias("doc_id"), clean_text(text).alias("text"))


def release_memory() -> None:
    """Gives what a Python worker no longer uses back to the system; workers live on after their tasks."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass  # not the C library that has it


def releasing(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """The same work on a partition's batches, with the worker's free memory given back at its end."""

    def and_release(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            release_memory()

    return and_release
