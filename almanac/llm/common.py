"""What the operators share: reading tables, the word pattern, column guards."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"


#: Bytes of an Arrow batch, which JVM and worker both hold; and Spark's setting for it with its default.
BATCH_BYTES = "4m"
_BATCH, _BATCH_DEFAULT = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b"

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give tasks a copy of this package, once per application, so that workers import it and keep their caches.

    Rows go to the workers in batches of BATCH_BYTES, unless the session says otherwise than Spark's default.
    """
    context = spark.sparkContext
    if spark.conf.get(_BATCH) == _BATCH_DEFAULT:
        spark.conf.set(_BATCH, BATCH_BYTES)
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent.parent
    if package.is_dir():
        archive = Path(tempfile.mkdtemp(prefix="ship-")) / f"{package.name}.zip"
        with zipfile.ZipFile(archive, "w") as out:
            for file in sorted(package.rglob("*.py")):
                out.write(file, file.relative_to(package.parent))
        context.addPyFile(str(archive))
    _shipped.add(context.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def remainder(doc_id: str, modulus: int) -> Column:
    """crc32 of the id's text, modulo: which part of the labels a row belongs to."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % modulus


def slices(batches: Iterator[pa.RecordBatch], column: str, most_bytes: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in pieces of about `most_bytes` of `column`, at least a row each; bounds what a task holds."""
    for batch in batches:
        if not batch.num_rows:
            continue
        values = batch.column(batch.schema.get_field_index(column))
        if values.nbytes <= most_bytes:
            yield batch
            continue
        start, held = 0, 0
        for row, size in enumerate(_byte_lengths(values)):
            if held and held + size > most_bytes:
                yield batch.slice(start, row - start)
                start, held = row, 0
            held += size
        yield batch.slice(start)


def _byte_lengths(values: pa.Array) -> list[int]:
    import pyarrow.compute as pc

    return pc.fill_null(pc.binary_length(values), 0).to_pylist()
