"""Files as tables: interval catalog, storage inventory, links, archives."""

from __future__ import annotations

import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeloom.functions.scalar import parse_day

# Fixed value: what the name of an observation file looks like.
FILE_PATTERN = r".*_(\d{8})_(\d{8})_(\d+)\.txt$"


def list_files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Name, folder and size of files; their content is not read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(path)
        .select(
            "path",
            F.element_at(F.split("path", "/"), -1).alias("file_name"),
            F.element_at(F.split("path", "/"), -2).alias("folder"),
            "length",
        )
    )


def interval_catalog(files: DataFrame, name: str = "file_name") -> DataFrame:
    """Station and announced interval out of file names that follow the pattern."""
    part = lambda i: F.regexp_extract(F.col(name), FILE_PATTERN, i)
    kept = [c for c in files.columns if c != name]
    # The parts are columns of their own, so each is cut out of the name once.
    parts = files.filter(F.col(name).rlike(FILE_PATTERN)).withColumns(
        {"station_id": part(3), "_start": part(1), "_end": part(2)}
    )
    return parts.select(
        *kept,
        "station_id",
        parse_day(F.col("_start")).alias("start_date"),
        parse_day(F.col("_end")).alias("end_date"),
        name,
    )


def catalog_rejects(files: DataFrame, name: str = "file_name") -> DataFrame:
    """Files whose name does not follow the pattern."""
    return files.filter(~F.col(name).rlike(FILE_PATTERN))


def storage_inventory(files: DataFrame, group: str = "fold", length: str = "length") -> DataFrame:
    """Number of files and gigabytes per group."""
    return files.groupBy(group).agg(
        F.count(F.lit(1)).alias("file_count"), (F.sum(length) / F.lit(1024.0**3)).alias("storage_gb")
    )


# What matters within an anchor tag: a link with its value, other quoted text, the end of the tag. Every loop is over
# single characters and gives nothing back, so tags of any length need no stack.
TAG_PARTS = r"""\s(?i:href)\s*+=\s*+(?:"[^"]++"|'[^']++'|[^\s"'>]++)|"[^"]*+"|'[^']*+'|>"""


def extract_links(pages: DataFrame, suffix: str = ".zip", html: str = "html") -> DataFrame:
    """Targets of the anchors of a page that end in ``suffix``, in page order.

    A target may stand in double, single or no quotes; comments hold no anchors. The first link
    before the end of a tag counts, and > within quotes ends no tag. A tag that is never closed
    reaches to the next anchor.
    """
    shown = F.regexp_replace(html, r"(?s)<!--.*?(-->|$)", " ")
    rests = F.split(shown, r"(?i)<a(?=\s)")

    def target(rest: Column) -> Column:
        parts = F.regexp_extract_all(rest, F.lit(TAG_PARTS), F.lit(0))
        first = F.get(F.filter(parts, lambda t: ~t.startswith('"') & ~t.startswith("'")), F.lit(0))
        return F.when(first != ">", F.regexp_replace(first, r"""^\s(?i:href)\s*+=\s*+["']?|["']$""", ""))

    targets = F.filter(F.transform(F.slice(rests, F.lit(2), F.size(rests)), target), lambda t: t.isNotNull())
    return (
        pages.select(*[c for c in pages.columns if c != html], F.posexplode(targets).alias("position", "link"))
        .filter(F.col("link").endswith(suffix))
    )


def expand_archives(archives: DataFrame, first_only: bool = False, flush_bytes: int = 4 << 20) -> DataFrame:
    """Members of zip archives ``(archive, content)``, one row per member.

    ``first_only`` keeps the first member of every archive and, of members with
    the same name, the one of the first archive by name. Archives are opened one by one where they
    lie in their batch, and members leave a task in batches of about ``flush_bytes``.
    """
    kinds = [pa.string(), pa.int32(), pa.string(), pa.binary()]
    columns = ["archive", "member_idx", "member", "content"]

    def batch_of(pending: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*pending), kinds)], columns)

    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pending: list[tuple] = []
        size = 0
        for batch in batches:
            for archive, content in zip(batch.column("archive"), batch.column("content")):
                with zipfile.ZipFile(pa.BufferReader(content.as_buffer())) as z:
                    names = [i for i in z.infolist() if not i.is_dir()]
                    for index, info in enumerate(names[:1] if first_only else names):
                        pending.append((archive.as_py(), index, info.filename, z.read(info)))
                        size += info.file_size
                        if size >= flush_bytes or len(pending) >= 4096:
                            yield batch_of(pending)
                            pending, size = [], 0
        if pending:
            yield batch_of(pending)

    rows = archives.select("archive", "content").mapInArrow(
        members, "archive string, member_idx int, member string, content binary"
    )
    if not first_only:
        return rows
    winners = rows.groupBy("member").agg(F.min("archive").alias("archive"))
    return rows.join(winners, ["member", "archive"], "left_semi")
