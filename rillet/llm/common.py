"""What the operators share: table access, written tables, batch slicing."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillet.session import apply_session_conf, delete_path, scratch_path

#: Columns of the documents table, which the pipeline's stages hand on.
DOC_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: A word: a run without the space and the five ASCII controls 0x09-0x0D.
#: ``bytes.split()`` cuts UTF-8 at exactly these characters.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
#: Rows of an Arrow batch sent to Python (texts may be long).
ARROW_ROWS = 1000


def prepare(spark: SparkSession) -> None:
    """Session settings that the registered queries rely on."""
    apply_session_conf(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts_of(docs: DataFrame, *more: str) -> DataFrame:
    """``doc_id`` as a long and ``text`` (null: empty); other columns go unless named."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text"), F.lit("")).alias("text"), *more)


def written(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back.

    The lineage ends here: a later loss of executors re-reads files instead of
    repeating the work, and two readers see the same rows.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path, compression=compression)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.written_path = path
    return out


def drop_written(*tables: DataFrame) -> None:
    """Remove tables of :func:`written` that no returned result reads."""
    for t in tables:
        delete_path(t.sparkSession, t.written_path)


def slices(batch: pa.RecordBatch, column: str, most_bytes: int) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that each part holds about ``most_bytes`` of ``column`` (one row at least)."""
    size, begin = 0, 0
    lengths = pc.binary_length(batch.column(column)).fill_null(0).to_pylist()
    for i, n in enumerate(lengths):
        if size and size + n > most_bytes:
            yield batch.slice(begin, i - begin)
            begin, size = i, 0
        size += n
    if begin < batch.num_rows:
        yield batch.slice(begin)


def text_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 of a string column, without decoding; null: empty."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [b"" if x is None else x for x in column.cast(kind).to_pylist()]
