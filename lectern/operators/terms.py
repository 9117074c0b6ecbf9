"""Terms of whole texts."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StringType, StructField, StructType

from lectern.functions.text import TERMS, terms_of

SLICE_CHARS = 250_000


def text_terms(df: DataFrame, text: str = "text", names: list[str] = TERMS) -> DataFrame:
    """``df`` without ``text``, and the lists unigrams, bigrams, trigrams, properNouns and stems of it, or those of ``names``
    alone, each distinct and in the order of the text. As many columns as there are terms would fill a worker from one batch of texts, so
    results leave it by slices of some ``SLICE_CHARS`` characters; a longer text is one by itself. Null texts have no
    terms; columns of the new names are replaced."""
    return _by_slices(df, text, names, ArrayType(StringType()), lambda found: pa.array(found, pa.list_(pa.string())))


def joined_terms(df: DataFrame, text: str = "text", names: list[str] = TERMS, by: str = "|", alphabetical: bool = True) -> DataFrame:
    """The lists of ``text_terms``, each joined to one string in the worker, in order of the alphabet (of code points) or of the
    text: a list's thousands of strings aren't handed over and sorted one by one."""
    order = sorted if alphabetical else list
    return _by_slices(df, text, names, StringType(), lambda found: pa.array([by.join(order(x)) for x in found], pa.string()))


def _by_slices(df: DataFrame, text: str, names: list[str], kind: DataType, packed: Callable[[list[list[str]]], pa.Array]) -> DataFrame:
    kept = [c for c in df.columns if c != text and c not in names]
    plain = [f"c{i}" for i in range(len(kept))]
    rows = df.select(*[F.col(f"`{c}`").alias(p) for c, p in zip(kept, plain, strict=True)], F.col(f"`{text}`").alias("text"))
    schema = StructType(rows.schema.fields[:-1] + [StructField(n, kind) for n in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            start = 0
            while start < batch.num_rows:
                stop, size, found = start, 0, []
                while stop < batch.num_rows and (size < SLICE_CHARS or stop == start):
                    own = batch.column(len(kept))[stop].as_py()
                    found.append(terms_of(own, names))
                    size += len(own or "")
                    stop += 1
                others = [batch.column(i).slice(start, stop - start) for i in range(len(kept))]
                lists = [packed([x[k] for x in found]) for k in range(len(names))]
                yield pa.RecordBatch.from_arrays(others + lists, names=[*plain, *names])
                start = stop

    return rows.mapInArrow(run, schema).toDF(*kept, *names)
