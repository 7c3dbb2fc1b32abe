"""Keeping the store current from a landing folder.

Raw files (``EXP_2024.csv``, ``IMP_2024.csv``, possibly split in several
parts) are dropped into a landing folder, and the current year's file is
published again under its name every month.  A refresh compares the folder's listing
(path, modification time, length; no content is read) with the listing that the last load
recorded in the checkpoint folder, so late, old-dated and republished files all
count as changed, and so do withdrawn ones.  It reloads every (flow, year) with a changed file from **all** landing
files of that flow and year, replaces those years in the store whose content differs, deletes years without
any file left, and then records the listing.  A refresh that fails before that is simply done again: the same
years are written with the same content.

``run_ingest_once`` does one refresh.  ``start_ingest`` keeps watching the folder: a
``binaryFile`` stream, without an age limit, notices arriving names, and each micro-batch runs the same
refresh (so files that were republished meanwhile are loaded too).
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tradeflow.plans.store import load_flow, remove_years
from tradeflow.sources.raw import route_columns

# The fixed schema of Spark's binaryFile source; ``content`` is never selected, so never read.
BINARY_FILE_SCHEMA = T.StructType(
    [
        T.StructField("path", T.StringType(), False),
        T.StructField("modificationTime", T.TimestampType(), False),
        T.StructField("length", T.LongType(), False),
        T.StructField("content", T.BinaryType(), True),
    ]
)


def new_files(spark: SparkSession, landing: str, glob: str = "*.csv*", max_files: int | None = None) -> DataFrame:
    """Streaming frame of files arriving in ``landing``: path, modificationTime, length.

    The default glob also takes compressed raw files (``EXP_2024.csv.gz``).
    """
    reader = (
        spark.readStream.format("binaryFile")
        .schema(BINARY_FILE_SCHEMA)
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", "true")
        .option("maxFileAge", "36500d")  # the default drops files a week older than the newest one
    )
    if max_files:
        reader = reader.option("maxFilesPerTrigger", int(max_files))
    return reader.load(landing).select("path", "modificationTime", "length")


LISTING = "path string, modificationTime timestamp, length long"


def listing(spark: SparkSession, landing: str, glob: str = "*.csv*") -> DataFrame:
    """path, modificationTime and length of the files in ``landing``; contents are not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true")
    return files.load(landing).select("path", "modificationTime", "length")


def _versions(spark: SparkSession, state: str) -> list[int]:
    """Completely written listings below ``state``, ascending."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(state)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return []
    done = fs.globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{state}/v*/_SUCCESS"))
    return sorted(int(s.getPath().getParent().getName()[1:]) for s in done)


def touched_years(changed: DataFrame) -> dict[str, list[int]]:
    """flow -> years named by the changed files: at most one row for each flow and year reaches the driver."""
    name = F.regexp_replace(F.substring_index("path", "/", -1), "%[0-9A-Fa-f]{2}", "_")
    rows = changed.select(*route_columns(name)).where("flow is not null and file_year is not null").distinct().collect()
    out: dict[str, list[int]] = {}
    for flow, year in sorted((r.flow, r.file_year) for r in rows):
        out.setdefault({"exp": "export", "imp": "import"}[flow], []).append(year)
    return out


def refresh_from_landing(spark: SparkSession, landing: str, base: str, state: str, layout: str = "auto") -> dict[str, list[int]]:
    """Reload, or remove, the (flow, year)s whose files changed since the listing recorded below ``state``; returns them."""
    versions = _versions(spark, state)
    number = versions[-1] + 1 if versions else 0
    now = listing(spark, landing)
    # Written first, and read back: the folder may change while the years are loaded.
    seen = f"{state}/next-{number}"
    now.write.mode("overwrite").parquet(seen)
    now = spark.read.schema(LISTING).parquet(seen)
    known = spark.read.schema(LISTING).parquet(f"{state}/v{versions[-1]}") if versions else spark.createDataFrame([], LISTING)
    version = ["path", "modificationTime", "length"]
    # New, republished and withdrawn files: the difference of the two listings, either way.
    work = touched_years(now.join(known, version, "left_anti").unionByName(known.join(now, version, "left_anti")))
    left = touched_years(now)
    gone = {flow: sorted(set(years) - set(left.get(flow, []))) for flow, years in work.items()}
    if work:
        # the flows are independent jobs; submit them together, as create_store does
        load = inheritable_thread_target(spark)(load_flow)
        with ThreadPoolExecutor(max_workers=len(work)) as pool:
            futures = [
                pool.submit(load, spark, landing, base, flow, None, sorted(set(years) - set(gone[flow])), layout) for flow, years in work.items()
            ]
            for f in futures:
                f.result()  # re-raise a failure: nothing is recorded, so the next refresh does it again
        for flow, years in gone.items():
            remove_years(spark, base, flow, years)  # all files of these years were withdrawn
    now.write.mode("overwrite").parquet(f"{state}/v{number}")
    return work


def ingest_batch(landing: str, base: str, state: str, layout: str = "auto"):
    """``foreachBatch`` function: refresh the store from the landing folder."""

    def run(batch: DataFrame, batch_id: int) -> None:
        refresh_from_landing(batch.sparkSession, landing, base, state, layout)

    return run


def start_ingest(
    spark: SparkSession,
    landing: str,
    base: str,
    checkpoint: str,
    available_now: bool = True,
    processing_time: str | None = None,
    max_files: int | None = None,
) -> StreamingQuery:
    """Start the landing-folder ingest; ``checkpoint`` must be on a shared file system."""
    writer = new_files(spark, landing, max_files=max_files).writeStream.foreachBatch(ingest_batch(landing, base, f"{checkpoint}/listings"))
    writer = writer.option("checkpointLocation", f"{checkpoint}/stream")
    if processing_time:
        writer = writer.trigger(processingTime=processing_time)
    elif available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def run_ingest_once(spark: SparkSession, landing: str, base: str, checkpoint: str) -> dict[str, list[int]]:
    """Load everything that has changed since the last run, then return; ``checkpoint`` must be shared."""
    return refresh_from_landing(spark, landing, base, f"{checkpoint}/listings")
