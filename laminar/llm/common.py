"""Shared pieces of the text operators: tables, words, scratch tables.

A word is a maximal run of characters other than space and U+0009..U+000D
(``[^\\x20\\x09-\\x0D]+``). ``bytes.split()`` splits on exactly those characters, and
``WORD_BREAK`` is the same class as a Java regular expression.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from laminar.session import configure as base_configure
from laminar.session import new_area

WORD_BREAK = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialise(df: DataFrame, label: str, compression: str = "snappy") -> DataFrame:
    """Write ``df`` as a table under the shared storage root and read it back.

    The written table cuts the lineage: a lost executor recomputes from these files,
    not from the operator's input.
    """
    spark = df.sparkSession
    path = new_area(spark, label)
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def words(text: Column) -> Column:
    """The words of a text as an array (empty for NULL)."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), WORD_BREAK), "")


@dataclass
class Words:
    kinds: pa.Array            # the different words
    which: np.ndarray          # of every word, its place in ``kinds``
    sizes: np.ndarray          # words of every text


def split_words(texts: pa.Array) -> Words:
    """The words of a batch of texts (none for null)."""
    lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    sizes = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten()
    empty = pc.equal(pc.binary_length(flat), 0)            # beside white space at a text's ends
    if pc.any(empty).as_py():
        owner = np.repeat(np.arange(len(sizes)), sizes)
        keep = pc.invert(empty)
        flat, sizes = flat.filter(keep), np.bincount(owner[keep.to_numpy(zero_copy_only=False)], minlength=len(sizes))
    coded = flat.dictionary_encode()
    return Words(coded.dictionary, coded.indices.to_numpy(), sizes)


def bounded_batches(batches, max_bytes: int = 4 << 20):
    """Slices of Arrow record batches of about ``max_bytes`` at most (one row at least)."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        step = max(1, int(batch.num_rows * max_bytes / max(batch.nbytes, 1)))
        for at in range(0, batch.num_rows, step):
            yield batch.slice(at, step)


def configure(spark: SparkSession) -> SparkSession:
    """The warehouse's settings, and Arrow batches of fewer rows: rows here are texts, and
    a batch of ten thousand long ones would not fit beside the executor's heap."""
    base_configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    return spark


def forget(prefix: str) -> None:
    """Drop the worker's objects whose name starts with ``prefix``."""
    import sys
    kept = getattr(sys.modules.get("_laminar_worker_state"), "__dict__", {})
    for name in [n for n in kept if n.startswith(prefix)]:
        del kept[name]


def worker_state(name: str, make):
    """An object that outlives the task: made once per Python worker and kept in a module of
    its own, as functions of this subpackage arrive by value with every task."""
    import sys
    import types
    kept = sys.modules.setdefault("_laminar_worker_state", types.ModuleType("_laminar_worker_state")).__dict__
    if name not in kept:
        kept[name] = make()
    return kept[name]
