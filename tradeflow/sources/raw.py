"""Raw customs files: one ';'-separated, Latin-1 CSV per flow and year.

Columns are picked **by header name**, per file, so files with extra or
reordered columns are read correctly (a schema given to Spark's CSV reader is
matched by position, which would silently shift values).  Every value is read
as a string and then cast: under ANSI mode a malformed or fractional number
raises instead of becoming null or being truncated.

The flow and the year of a file come from its name (``EXP_2024.csv``,
``IMP_2024.csv``); only the file name is used, never the directories above it.
"""

from __future__ import annotations

import re
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from functools import reduce
from urllib.parse import unquote

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradeflow.schemas import FLOWS, RAW_COLUMNS, RAW_TYPES

CSV_OPTIONS = {
    "sep": ";",
    "header": "true",
    "encoding": "ISO-8859-1",
    "nullValue": "NA",
    "emptyValue": "",
    "inferSchema": "false",
    "enforceSchema": "false",
    "mode": "FAILFAST",
    "escape": '"',  # a doubled quote inside a quoted field is one quote
}

FLOW_TOKEN = {"export": "EXP", "import": "IMP"}
_ROUTE = re.compile(r"(EXP|IMP)")
_YEAR = re.compile(r"[0-9]{4}")


def list_files(spark: SparkSession, paths: str | list[str]) -> list[str]:
    """Expand paths, directories and globs to data files (file listing only, no data is read)."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    listed = spark.read.format("text").option("recursiveFileLookup", "true").load(paths).inputFiles()
    return sorted(unquote(f) for f in listed)  # Spark lists URIs; names are used as they are stored


def literal_path(path: str) -> str:
    """A listed path as a read path: characters that would start a glob are escaped."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def file_name(path: str) -> str:
    return path.rstrip("/").rsplit("/", 1)[-1]


def route_of(path: str) -> tuple[str | None, int | None]:
    """(flow, year) from a file name, as ``with_file_route`` computes them in Spark."""
    name = file_name(path)
    f = _ROUTE.search(name)
    y = _YEAR.search(name)
    flow = {"EXP": "export", "IMP": "import"}[f.group(0)] if f else None
    return flow, int(y.group(0)) if y else None


def route_columns(file_col: str | Column) -> list[Column]:
    """``flow`` ('exp' / 'imp') and ``file_year`` from a file-name column."""
    c = F.col(file_col) if isinstance(file_col, str) else file_col
    flow = F.lower(F.regexp_extract(c, "EXP|IMP", 0))
    year = F.regexp_extract(c, "[0-9]{4}", 0)
    return [
        F.when(flow != "", flow).alias("flow"),
        F.when(year != "", year.cast("int")).alias("file_year"),
    ]


def with_file_route(df: DataFrame, file_col: str = "source_file") -> DataFrame:
    """Add ``flow`` and ``file_year`` taken from the file name in ``file_col``."""
    if file_col not in df.columns:
        raise ValueError(f"The '{file_col}' column does not exist.")
    return df.select("*", *route_columns(file_col))


def _typed(name: str) -> Column:
    """Without blanks at either end; blank numbers and product codes -> null, then an exact cast."""
    t = RAW_TYPES[name]
    c = F.trim(F.col(f"`{name}`"))
    if t.simpleString() != "string" or name == "CO_NCM":  # a product code is a number in the published files
        c = F.nullif(c, F.lit(""))
    return c.cast(t).alias(name)


def bare_names(df: DataFrame) -> DataFrame:
    """Column names without a leading byte-order mark or surrounding blanks."""
    names = []
    for c in df.columns:
        for bom in _BOMS:
            if c.startswith(bom):
                c = c[len(bom):]
        names.append(c.strip())
    return df if names == df.columns else df.toDF(*names)


def _read_csv(spark: SparkSession, paths, options: dict | None = None, schema=None) -> DataFrame:
    opts = dict(CSV_OPTIONS)
    opts.update(options or {})
    reader = spark.read.options(**opts)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(paths)


# A header is looked for in so many bytes; where they hold no line end, Spark reads the file's header itself.
HEADER_PROBE_BYTES = 65536


def header_lines(spark: SparkSession, files: list[str], encoding: str = "ISO-8859-1") -> dict[str, str | None]:
    """First line of each file, read through the Hadoop file system (a few bytes per file).

    Compressed files are read through Hadoop's codec for their suffix.  None: no
    line end within the probe, or no codec; such a file's header is left to Spark.
    Files are opened concurrently (object stores have high per-request latency);
    only the header lines reach the driver.
    """
    jvm = spark._jvm
    conf = spark._jsc.hadoopConfiguration()
    Path = jvm.org.apache.hadoop.fs.Path
    codecs = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf)

    def first_line(f: str) -> str | None:
        p = Path(f)
        codec = codecs.getCodec(p)
        if codec is None and f.lower().endswith(COMPRESSED_SUFFIXES):
            return None
        stream = p.getFileSystem(conf).open(p)
        try:
            source = stream if codec is None else codec.createInputStream(stream)
            head = bytes(source.readNBytes(HEADER_PROBE_BYTES))  # bounded, whatever the file holds
        finally:
            stream.close()
        if b"\n" not in head and len(head) == HEADER_PROBE_BYTES:
            return None
        return head.decode(encoding, errors="replace").split("\n", 1)[0].rstrip("\r")

    if len(files) <= 4:
        return {f: first_line(f) for f in files}
    with ThreadPoolExecutor(max_workers=min(16, len(files))) as pool:
        return dict(zip(files, pool.map(inheritable_thread_target(spark)(first_line), files)))


# A UTF-8 byte-order mark, as it reads in UTF-8 and in Latin-1.
_BOMS = ("\ufeff", "\u00ef\u00bb\u00bf")


# Spark decompresses these when it reads them (gzip files are not splittable, so each
# is read by one task; uncompressed or bzip2 files are split).
COMPRESSED_SUFFIXES = (".gz", ".bz2", ".zst", ".deflate", ".lz4", ".snappy", ".xz", ".br", ".zip")


def group_by_header(spark: SparkSession, files: list[str]) -> list[tuple[str | None, list[str]]]:
    """(header line, files) groups: files with the same header line are read in one scan.

    A file whose header was not found forms its own group (Spark reads its header).
    """
    groups: dict[str, list[str]] = {}
    unknown: list[tuple[str | None, list[str]]] = []
    for f, h in header_lines(spark, files).items():
        if h is None:
            unknown.append((None, [f]))
            continue
        for bom in _BOMS:  # Spark's CSV parser skips a byte-order mark too
            if h.startswith(bom):
                h = h[len(bom):]
        groups.setdefault(h.strip(), []).append(f)
    return list(groups.items()) + unknown


def header_schema(header: str, sep: str = ";") -> T.StructType | None:
    """All-string schema named after a plain header line; None when the line needs real CSV parsing.

    Spark still compares every file's header with these names (``enforceSchema=false``),
    so a wrong guess raises instead of shifting values.
    """
    names = [n.strip() for n in header.split(sep)]
    if not names or any((not n) or '"' in n or "'" in n for n in names) or len(set(names)) != len(names):
        return None
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def read_raw(
    spark: SparkSession,
    paths: str | list[str],
    flow: str,
    layout: str = "auto",
    keep_file: bool = False,
    options: dict | None = None,
) -> DataFrame:
    """Scan raw trade files of one flow and keep its 8 (export) or 10 (import) columns, typed.

    ``layout='auto'`` groups the files by their header line and reads each
    group in one scan, then unions the groups by name: files may differ in
    column order or extra columns, and the usual case (one layout) is a single
    scan.  ``layout='per_file'`` reads each file on its own; ``layout='shared'``
    reads all files in one scan.  In every case Spark checks each file's
    header against its scan's schema (``enforceSchema=false``) and fails on a
    difference instead of misreading values by position.

    A file lacking a needed column (for example an HTML error page saved in its
    place) raises ``ValueError`` naming the file.  With ``keep_file`` the
    result has a ``source_file`` column (the file name), for ``with_file_route``.
    """
    if flow not in FLOWS:
        raise ValueError(f"flow must be one of {FLOWS}, got {flow!r}")
    wanted = RAW_COLUMNS[flow]
    # Files named for the other flow are not read; files without a flow in their name are.
    files = [f for f in list_files(spark, paths) if route_of(f)[0] in (None, flow)]
    if not files:
        raise ValueError(f"no {flow} files found at {paths!r}")
    if layout == "auto" and getattr(spark, "_jvm", None) is None:
        layout = "per_file"  # no JVM gateway (Spark Connect): let Spark read each file's header
    if layout == "auto":
        sep = (options or {}).get("sep", CSV_OPTIONS["sep"])
        groups = [(header_schema(h, sep) if h is not None else None, g) for h, g in group_by_header(spark, files)]
    elif layout == "shared":
        groups = [(None, files)]
    elif layout == "per_file":
        groups = [(None, [f]) for f in files]
    else:
        raise ValueError("layout must be 'auto', 'per_file' or 'shared'")
    frames = []
    for schema, group in groups:
        df = bare_names(_read_csv(spark, [literal_path(f) for f in group], options, schema))
        missing = [c for c in wanted if c not in df.columns]
        if missing:
            where = group[0] if len(group) == 1 else f"{len(group)} files starting with {group[0]}"
            raise ValueError(f"{where}: not a raw {flow} file, missing column(s) {missing}; header {df.columns[:12]}")
        cols = [_typed(c) for c in wanted]
        if keep_file:
            cols.append(F.col("_metadata.file_name").alias("source_file"))
        frames.append(df.select(*cols))
    return reduce(lambda a, b: a.unionByName(b), frames)


def select_files(files: list[str], flow: str, start_year: int | None = None, years=None) -> list[str]:
    """Files of one flow (by name) whose year is wanted; a plain filter over paths."""
    wanted = set(int(y) for y in years) if years is not None else None
    out = []
    for f in files:
        fl, y = route_of(f)
        if fl != flow or y is None:
            continue
        if start_year is not None and y < start_year:
            continue
        if wanted is not None and y not in wanted:
            continue
        out.append(f)
    return out


#: A writing task keeps so many files open, one for each year; it sorts the rows of any further years.
OPEN_YEARS = 64


@contextmanager
def _open_files(spark: SparkSession, number: int):
    """Writes inside the block may keep ``number`` files open in a task; the session's setting is put back after it."""
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name, None)
    spark.conf.set(name, str(number))
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def write_raw_files(df: DataFrame, landing: str, flow: str, compression: str | None = None) -> list[str]:
    """Lay out rows with raw header names as the portal publishes them: ``<FLOW>_<year>[_<k>].csv``.

    With ``compression`` (a codec name of Spark's CSV writer) the files have the codec's suffix, as ``.csv.gz``.

    Executors write the CSV parts (one folder per year) straight from the frame's partitions: a task keeps a
    file open for each of its years, so no row is shuffled or sorted.  The parts are then
    renamed into ``landing`` through the Hadoop file system (metadata only).
    Used to build test inputs from the driver's tables.
    """
    spark = df.sparkSession
    token = FLOW_TOKEN[flow]
    staging = f"{landing.rstrip('/')}/_staging_{token}"
    with _open_files(spark, OPEN_YEARS):
        (
            df.withColumn("_file_year", F.col("CO_ANO"))
            .write.mode("overwrite")
            .partitionBy("_file_year")
            .options(sep=";", header="true", encoding="ISO-8859-1", nullValue="NA", compression=compression or "none")
            .csv(staging)
        )
    jvm = spark._jvm
    conf = spark._jsc.hadoopConfiguration()
    Path = jvm.org.apache.hadoop.fs.Path
    fs = Path(staging).getFileSystem(conf)
    written = []
    parts = sorted(
        (str(s.getPath().toString()) for s in fs.globStatus(Path(f"{staging}/_file_year=*/part-*"))),
    )
    counters: dict[str, int] = {}
    for p in parts:
        year = re.search(r"_file_year=([0-9]+)", p).group(1)
        k = counters.get(year, 0)
        counters[year] = k + 1
        target = f"{landing.rstrip('/')}/{token}_{year}" + (f"_{k}" if k else "") + p[p.rindex(".csv"):]
        if not fs.rename(Path(p), Path(target)):
            raise OSError(f"could not move {p} to {target} (does it exist already?)")
        written.append(target)
    fs.delete(Path(staging), True)
    return written
