"""Helpers the training-data operators share: words, splits, written tables, Arrow slices.

A word is a run of characters other than the ASCII blanks (space, tab to carriage return). Only
A-Z is lower-cased, so that no operator depends on a Unicode version.
"""

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoptrail.session import work_folder

WORD = r"([^\x20\x09-\x0D]+)"
BLANKS = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Text handled at once inside a Python task; bounds its memory whatever a partition holds.
SLICE_BYTES = 5_000_000


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def word_count(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def remainder(doc_id: Column, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % divisor


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once per row, also where ``use`` needs it inside a lambda."""
    return F.element_at(F.transform(F.array(value), use), 1)


def training_rows(docs: DataFrame, labels: DataFrame, label: str, divisor: int, held_out: int, limit: int) -> DataFrame:
    """``doc_id``, ``text`` and 0/1 ``label`` of labelled documents whose id's remainder is not ``held_out``.

    At most ``limit`` labels are used, the first by hash of their id. Null ids and labels are left out; of
    repeated labels of a document the largest counts, and of rows of one id the one whose text has the least hash,
    so there are at most ``limit`` rows.
    """
    known = labels.select("doc_id", F.col(label).cast("int").alias("label")).dropna()
    known = known.filter(remainder(F.col("doc_id"), divisor) != held_out)
    known = known.groupBy("doc_id").agg(F.max("label").alias("label")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    found = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id")
    one = F.min_by(F.struct("text"), F.struct(F.xxhash64("text"), "text"))["text"].alias("text")
    return found.groupBy("doc_id", "label").agg(one)


def written(table: DataFrame, name: str = "llm") -> DataFrame:
    """``table`` as Parquet in the shared folder, read back: cuts lineage, survives lost executors."""
    folder = work_folder(table.sparkSession, name)
    table.write.parquet(folder)
    return table.sparkSession.read.schema(table.schema).parquet(folder)


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``limit`` bytes of text (one row at least)."""
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All lower-cased words of some texts (null: none), and where each text's words start and end."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    offsets = lists.offsets.to_numpy()
    words = lists.values.slice(offsets[0], offsets[-1] - offsets[0]) if len(texts) else lists.values
    offsets = offsets - offsets[0]
    # Blanks at an end leave empty strings.
    real = pc.greater(pc.binary_length(words), 0).to_numpy(zero_copy_only=False)
    counts = np.concatenate(([0], np.cumsum(real)))
    return words.filter(pa.array(real)), counts[offsets]


def word_hashes(words: pa.Array) -> np.ndarray:
    """A 64-bit hash of each word; each distinct word is hashed once."""
    import pandas as pd

    coded = words.dictionary_encode()
    if not len(coded.dictionary):
        return np.empty(0, np.uint64)
    known = pd.util.hash_array(coded.dictionary.to_numpy(zero_copy_only=False), categorize=False)
    return known[coded.indices.to_numpy()]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, so that close numbers become unrelated."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
