"""Helpers shared by the operators: words, batches, stable row keys."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Lower-cases A-Z and turns every ASCII byte that is no letter or digit into a space.
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)

#: Rows of a batch that are worked on together.
ROWS = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: bytes) -> list[bytes]:
    """Words of letters, digits and non-ASCII characters, A-Z lower-cased."""
    return text.translate(WORD_BYTES).split()


def tokens(text: bytes) -> list[bytes]:
    """Words between ASCII white space, A-Z lower-cased."""
    return text.lower().split()


def binary_column(batch: pa.RecordBatch, name: str) -> list[bytes]:
    """The UTF-8 bytes of a text column; null counts as empty."""
    column = batch.column(name)
    if not pa.types.is_null(column.type):
        column = column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary())
    return [x or b"" for x in column.to_pylist()]


def map_arrow(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[dict]], schema: str) -> DataFrame:
    """``mapInArrow`` for a function that yields dicts of columns, in the order of ``schema``."""
    names = [part.strip().split()[0] for part in schema_fields(schema)]
    arrow = to_arrow(df.sparkSession, schema)

    def run(batches):
        try:
            for columns in fn(portions(batches)):
                yield pa.RecordBatch.from_arrays([as_array(columns[n], arrow.field(n).type) for n in names], schema=arrow)
        finally:
            # workers live on; what the task held goes back to the system
            pa.default_memory_pool().release_unused()

    return df.mapInArrow(run, schema)


def portions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of at most ``ROWS`` rows, so that what is made of one stays small."""
    for batch in batches:
        for a in range(0, batch.num_rows, ROWS):
            yield batch.slice(a, ROWS)


def as_array(values, kind: pa.DataType) -> pa.Array:
    return values.cast(kind) if isinstance(values, pa.Array) else pa.array(values, kind)


def schema_fields(schema: str) -> list[str]:
    """The fields of a DDL string, cut at commas outside brackets."""
    out, depth = [""], 0
    for c in schema:
        depth += (c == "<") - (c == ">")
        if c == "," and not depth:
            out.append("")
        else:
            out[-1] += c
    return out


def to_arrow(spark: SparkSession, schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(schema))


def slices(sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows with at most ``most`` bytes each, one row at least."""
    start = total = 0
    for i, size in enumerate(sizes):
        if i > start and total + size > most:
            yield start, i
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield start, len(sizes)


def row_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """A key that equal rows share and different rows do not: the id with a digest of the text."""
    return F.sha2(
        F.concat_ws("\x00", F.coalesce(F.col(doc_id).cast("string"), F.lit("null")), F.coalesce(F.col(text), F.lit(""))), 256
    )


def remainder(doc_id: Column | str, divisor: int) -> Column:
    """crc32 of the id as text, modulo; a null id counts as an empty text."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")) % divisor


def checked_broadcast(spark: SparkSession, value, size: int, most: int, what: str):
    """Broadcast a value whose size was measured; above the bound the caller must go in blocks."""
    if size > most:
        raise ValueError(f"{what}: {size} bytes are more than the bound of {most}; pass it in blocks")
    return spark.sparkContext.broadcast(value)
