"""Cleaning whole pages: one Arrow pass per row, no shuffle."""

from typing import Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T

from . import markup
from .nodes import cleaned_markup, dom_nodes

CLEANED = T.StructType(
    [
        T.StructField("cleaned", T.StringType()),
        T.StructField("tier", T.StringType()),
        T.StructField("tag", T.StringType()),
        T.StructField("text_len", T.IntegerType()),
        T.StructField("error", T.StringType()),
    ]
)


@F.pandas_udf(CLEANED)
def clean_markup(content: pd.Series) -> pd.DataFrame:
    """(cleaned, tier, tag, text_len, error); on an error the input comes back unchanged."""
    rows = []
    for value in content:
        if value is None:
            rows.append((None, None, None, None, None))
            continue
        try:
            rows.append((*markup.clean(value), None))
        except Exception as e:
            text = value if isinstance(value, str) else bytes(value).decode("utf-8", "replace")
            rows.append((text, None, None, None, f"{type(e).__name__}: {e}"))
    out = pd.DataFrame(rows, columns=["cleaned", "tier", "tag", "text_len", "error"])
    return out.astype({"text_len": "Int32"})


#: Pages are cleaned in parts of so many bytes, or one page if it is longer.
PART_BYTES = 1 << 20
_ARROW = pa.schema([("cleaned", pa.string()), ("tier", pa.string()), ("tag", pa.string()), ("text_len", pa.int32()), ("error", pa.string())])


def parts(batch: pa.Array, most: int = PART_BYTES) -> Iterator[pa.Array]:
    """Slices of a batch, in order, that end before they pass ``most`` bytes."""
    start = n_bytes = 0
    for i, size in enumerate(pc.fill_null(pc.binary_length(batch), 0).to_numpy(zero_copy_only=False)):
        if i > start and n_bytes + size > most:
            yield batch.slice(start, i - start)
            start, n_bytes = i, 0
        n_bytes += int(size)
    if start < len(batch):
        yield batch.slice(start)


@F.arrow_udf(CLEANED)
def clean_in_parts(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """``clean_markup`` part by part: of a batch that Spark sends, only a part is held in further copies."""
    for batch in batches:
        for part in parts(batch):
            rows = clean_markup.func(part.to_pandas())
            yield pa.RecordBatch.from_pandas(rows, _ARROW, preserve_index=False).to_struct_array()


# Parsing is the costly step: marked so that the optimizer keeps one evaluation per row instead
# of repeating it in a filter and in a projection.
clean_markup, clean_in_parts = clean_markup.asNondeterministic(), clean_in_parts.asNondeterministic()


def with_cleaned(df: DataFrame, content: Column | str) -> DataFrame:
    """Adds ``cleaned`` and ``clean_error`` columns next to the others."""
    return (
        df.withColumn("_clean", clean_in_parts(content))
        .withColumn("cleaned", F.col("_clean.cleaned"))
        .withColumn("clean_error", F.col("_clean.error"))
        .drop("_clean")
    )


def clean_pages(pages: DataFrame, html="html") -> DataFrame:
    """Page columns without the raw markup, plus the cleaned markup and how it was chosen."""
    kept = [c for c in pages.columns if c != html]
    return pages.select(*kept, clean_in_parts(html).alias("_clean")).select(*kept, "_clean.*")


def clean_pages_by_nodes(pages: DataFrame, key="page_id", html="html") -> DataFrame:
    """The same result from the element table, for when that table exists anyway.

    Every row is a page of its own, so captures that share a key, or have none, stay apart.
    """
    row = F.struct(F.monotonically_increasing_id().alias("row"), F.col(key).alias("key")).alias("_page")
    cleaned = cleaned_markup(dom_nodes(pages.select(row, html), "_page", html, with_markup=True), "_page")
    return cleaned.select(F.col("_page.key").alias(key), *[c for c in cleaned.columns if c != "_page"])
