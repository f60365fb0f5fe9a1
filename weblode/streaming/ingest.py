"""Pages indexed as they arrive, in micro-batches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from weblode.config import Site
from weblode.operators.index import REPLACES, read_table
from weblode.plans.records import page_records
from weblode.plans.site import new_records, save_files, upsert_records


def read_page_stream(spark: SparkSession, landing: str, schema, files_per_batch: int = 1000) -> DataFrame:
    """New parquet files of stored pages in a landing folder."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(landing)


def ingest_stream(
    pages: DataFrame,
    site: Site,
    index_path: str,
    checkpoint: str,
    files_path: str | None = None,
    countries: Sequence[tuple[str, str]] = (),
    gazetteer: DataFrame | None = None,
    arrival: Sequence[str] = ("url",),
    buckets: int = 64,
    by_identity: bool = False,
) -> StreamingQuery:
    """Index every page that arrives and append its record to the files; stops when all is read.

    Of records with one identity the first batch's is indexed, and of those in one batch the first by ``arrival``; records that
    share only the URL are one document. With ``by_identity`` every identity is a document (column ``id``), and it holds the first
    record by ``arrival`` of all batches and streams, in whatever order they come; the ``arrival`` columns are indexed for that. Files
    get a record when its identity is first seen, and are not written again if an earlier one comes later.

    A batch's new records are stored under the stream's id and its number before they are used, so a batch that is
    replayed writes the same files, and no other stream's. A commit of the index bears the same name and is made
    once. A stream that starts anew has a new id; what it reads again is in the index already.
    """

    def ingest(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        # The checkpoint holds the id that the stream keeps over restarts.
        stream_id = spark.read.schema("id string").json(f"{checkpoint}/metadata").first()["id"]
        name = f"{stream_id}-{batch_id}"
        kept = f"{index_path}/batches/{name}"
        extra = [c for c in arrival if c != "url"]
        if read_table(spark, f"{kept}/done") is None:
            extracted = page_records(batch, site, countries, gazetteer, keep=extra)
            found = new_records(extracted, site, index_path, arrival, by_identity)
            found.write.mode("overwrite").parquet(f"{kept}/records")
            spark.range(1).write.mode("overwrite").parquet(f"{kept}/done")
        fresh = spark.read.parquet(f"{kept}/records")
        if files_path:
            unseen = fresh.where(~F.col(REPLACES)) if by_identity else fresh
            save_files(unseen.drop(*extra, REPLACES), site, files_path, f"batch-{name}")
        upsert_records(fresh, site, index_path, extra, buckets, name, by_identity)

    return (
        pages.writeStream.foreachBatch(ingest)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
