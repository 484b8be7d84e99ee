"""Incremental chunking and incremental derivation with Structured Streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.chunking import chunk_documents
from ..operators.derive import Method, Run
from ..schemas import DOCUMENT


def document_stream(spark: SparkSession, folder: str, files_per_trigger: int = 64) -> DataFrame:
    """Documents of the JSON Lines files that appear in a folder."""
    return spark.readStream.schema(DOCUMENT).option("maxFilesPerTrigger", files_per_trigger).json(folder)


def chunk_stream(docs: DataFrame, out: str, checkpoint: str, *, target: int = 350, overlap: int = 50) -> StreamingQuery:
    """Appends the chunks of new documents as Parquet; each file is read once. Stateless, so nothing is kept in memory."""
    chunks = chunk_documents(docs, target, overlap)
    return chunks.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def derive_stream(docs: DataFrame, run_path: str, method: Method, checkpoint: str) -> StreamingQuery:
    """Derives from new documents; a repeated micro-batch finds its rows done and does nothing."""

    def each(batch: DataFrame, _: int) -> None:
        from pyspark.sql import functions as F

        Run(batch.sparkSession, run_path).execute(batch.withColumn("pos", F.monotonically_increasing_id()), method)

    return docs.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def append_pages(pages: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Appends the pages of a catalogue's stream as Parquet, each once; started again, it goes on from the checkpoint."""
    return pages.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).start()
