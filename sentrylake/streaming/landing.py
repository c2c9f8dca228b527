"""Landing folders as a stream: each run takes the pages that no run has taken, and upserts them into silver.

The checkpoint knows which files are done; the feed's own high-water mark stays with whoever fetches.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..functions.clock import utc_now
from ..operators import capture, shape
from ..operators import upsert as U
from ..plans.store import TableStore
from ..schemas import CVE_PAGE
from ..sources.feeds import cve_texts


def stream_pages(store: TableStore, folder: str, checkpoint: str, clock: Callable[[], datetime] = utc_now) -> StreamingQuery:
    """Takes all pages under ``folder`` that are new, then stops. A batch that is repeated after a failure changes nothing twice:
    silver is upserted, and its bronze rows are appended under the batch's own id only if that id is new."""
    pages = store.spark.readStream.schema(CVE_PAGE).option("multiLine", True).option("recursiveFileLookup", True).option("pathGlobFilter", "page_*.json").json(folder)

    def take(batch: DataFrame, number: int) -> None:
        loaded, name = clock(), f"stream-{number:012d}"
        rows = capture.bronze_cves(cve_texts(batch), source_uri=folder, load_type="INCREMENTAL", batch_id=name, loaded=loaded).persist()
        if not store.read("bronze_nvd_raw").where(f"batch_id = '{name}'").limit(1).count():
            store.append(rows, "bronze_nvd_raw")
        valid, rejected = shape.silver_cves(shape.parsed(rows), loaded)
        store.upsert(valid, "silver_cve", U.newer)
        store.insert_new(rejected, "silver_quarantine")
        rows.unpersist()

    return pages.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
