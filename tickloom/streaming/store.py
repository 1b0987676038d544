"""A folder of Parquet batches that several streams and jobs write to and any number of readers read.

Every finished batch is a folder ``batches=<first>-<last>``: both are its arrival number, counted over all writers,
or, where batches were folded into one, the first and last number it stands for. A batch is written
elsewhere and renamed in one step, so that readers only ever list whole ones; a folder that lies inside another
one's numbers is no longer read. The name of a writer is the identity that Spark keeps in a stream's
checkpoint: a restart of the same stream skips what it has finished, and a new stream never meets old numbers.

Renaming a folder has to be atomic and to fail where the target exists, as on HDFS and local disks.
"""

import json
import uuid
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Order of arrival of stored rows: the batch, then the position inside it.
ARRIVAL = "arrival"


class Batch(NamedTuple):
    """A finished batch: the arrival numbers it stands for and its folder's name."""

    first: int
    last: int
    name: str


def _path(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def _files(spark: SparkSession, folder: str):
    return _path(spark, folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _all(spark: SparkSession, folder: str) -> list[Batch]:
    """All batch folders, those inside others too, by arrival."""
    files = _files(spark, folder)
    if not files.exists(_path(spark, folder)):
        return []
    names = [status.getPath().getName() for status in files.listStatus(_path(spark, folder))]
    numbers = [(*map(int, n.removeprefix("batches=").split("-")), n) for n in names if n.startswith("batches=")]
    return sorted(Batch(*b) for b in numbers)


def _visible(batches: list[Batch]) -> list[Batch]:
    """The batches that are not inside another one; ``batches`` are sorted."""
    out: list[Batch] = []
    for b in sorted(batches, key=lambda b: (b.first, -b.last)):
        if not out or b.last > out[-1].last:
            out.append(b)
    return out


def finished(spark: SparkSession, folder: str) -> list[Batch]:
    """The batches a reader would read now, by arrival."""
    return _visible(_all(spark, folder))


def _about(spark: SparkSession, folder: str, batch: Batch) -> dict:
    """``writers``, the last batch of each writer that a folder stands for, and the ``schema`` of its rows."""
    stream = _files(spark, folder).open(_path(spark, f"{folder}/{batch.name}/_about.json"))
    try:
        text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return json.loads(text)


def last_batch(spark: SparkSession, folder: str, writer: str) -> int:
    """The number of a writer's last finished batch, or -1."""
    for batch in reversed(finished(spark, folder)):
        number = _about(spark, folder, batch)["writers"].get(writer)
        if number is not None:
            return number
    return -1


def _finish(rows: DataFrame, folder: str, writers: dict[str, int], name: Callable[[], str], by: list[str]) -> str:
    """Write ``rows`` aside and rename them to ``name()``; if that is taken, to the next name, if it gives another."""
    spark = rows.sparkSession
    work = f"{folder}/_work/{uuid.uuid4().hex}"
    # Few files per value of ``by``, hot values over several tasks.
    writer = rows.hint("rebalance", *by).write.partitionBy(*by) if by else rows.write
    writer.parquet(work)
    files, jvm = _files(spark, folder), spark.sparkContext._jvm
    about = {"writers": writers, "schema": rows.schema.jsonValue()}
    out = files.create(_path(spark, f"{work}/_about.json"))
    out.write(bytearray(json.dumps(about).encode()))
    out.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        files.makeQualified(_path(spark, folder)).toUri(), spark.sparkContext._jsc.hadoopConfiguration()
    )
    none = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    taken = None
    while (target := name()) != taken:
        try:
            context.rename(
                files.makeQualified(_path(spark, work)), files.makeQualified(_path(spark, f"{folder}/{target}")), none
            )
            return target
        except Exception as error:
            # Another writer may have finished first; it is an error if the name is still free.
            if not files.exists(_path(spark, f"{folder}/{target}")):
                raise error
            taken = target
    # An equal fold is there already.
    files.delete(_path(spark, work), True)
    return target


def append(rows: DataFrame, folder: str, writer: str | None = None, number: int = 0, by: list[str] | None = None) -> bool:
    """Store ``rows`` as the next batch to arrive; False if the writer has finished this number already.

    Without ``writer`` the batch is a one-off, such as a repair. ``by`` are columns to lay files out by.
    """
    spark = rows.sparkSession
    if writer is None:
        writer, number = uuid.uuid4().hex, 0
    elif last_batch(spark, folder, writer) >= number:
        return False

    def next_name() -> str:
        arrival = 1 + max((b.last for b in _all(spark, folder)), default=0)
        return f"batches={arrival}-{arrival}"

    _finish(rows, folder, {writer: number}, next_name, by or [])
    return True


def read(spark: SparkSession, folder: str, batches: list[Batch] | None = None) -> DataFrame:
    """All rows of the finished batches (or of ``batches``), with their ``arrival``: a later batch has a larger one.

    Columns and types are those of the newest batch; what an older one lacks is null.
    """
    batches = finished(spark, folder) if batches is None else batches
    if not batches:
        raise FileNotFoundError(f"no finished batches in {folder}")
    # With the stored schema no file is opened to infer one, and text in folder names stays text.
    schema = StructType.fromJson(_about(spark, folder, batches[-1])["schema"])
    reader = spark.read.schema(schema.add("batches", "string")).option("basePath", folder)
    rows = reader.parquet(*[f"{folder}/{b.name}" for b in batches])
    arrival = F.substring_index("batches", "-", -1).cast("long")
    return rows.withColumn(ARRIVAL, arrival).drop("batches")


def sizes(spark: SparkSession, folder: str) -> dict[Batch, int]:
    """Bytes of each finished batch."""
    files = _files(spark, folder)
    return {
        b: files.getContentSummary(_path(spark, f"{folder}/{b.name}")).getLength() for b in finished(spark, folder)
    }


def groups_to_fold(found: dict[Batch, int], target_bytes: int, fan: int) -> list[list[Batch]]:
    """The largest complete blocks of batches that fit into ``target_bytes``; larger batches stay as they are.

    Blocks are ``fan``, ``fan``**2, ... arrival numbers from fixed places, so that any two of them are nested or
    apart, whoever folds them and when.
    """
    last = max((b.last for b in found), default=0)

    def within(first: int, span: int) -> list[list[Batch]]:
        members = [b for b in found if first <= b.first and b.last < first + span]
        if len(members) < 2:
            return []
        if first + span - 1 <= last and sum(found[b] for b in members) <= target_bytes:
            return [members]
        return [g for i in range(fan) for g in within(first + i * (span // fan), span // fan)] if span > 1 else []

    span = fan
    while span < last:
        span *= fan
    return within(1, span)


def fold(
    spark: SparkSession,
    folder: str,
    merge: Callable[[DataFrame], DataFrame],
    target_bytes: int = 128 << 20,
    by: list[str] | None = None,
    fan: int = 8,
) -> list[Batch]:
    """Rewrite blocks of small batches as one each; the batches written.

    ``merge`` gets the rows of a block with their ``arrival`` and returns them as they are to be stored, such as
    the last of each key; it must not drop what later batches need. Readers see the old batches or the new
    one. Several folds at the same time are harmless, as equal blocks have equal names. At most ``fan`` batches of
    a size are left, so that a store of n batches is read from about fan * log(n) folders besides the large ones.
    """
    written = []
    for group in groups_to_fold(sizes(spark, folder), target_bytes, fan):
        name = f"batches={group[0].first}-{group[-1].last}"
        writers: dict[str, int] = {}
        for batch in group:
            writers.update(_about(spark, folder, batch)["writers"])
        merged = merge(read(spark, folder, group)).drop(ARRIVAL)
        merged = merged if by else merged.hint("rebalance")
        _finish(merged, folder, writers, lambda name=name: name, by or [])
        written.append(Batch(group[0].first, group[-1].last, name))
    return written


def prune(spark: SparkSession, folder: str, keep: int = 1) -> int:
    """Delete batches that were folded, but for the newest ``keep`` folds, which readers may still be at.

    Returns how many folders went.
    """
    everything = _all(spark, folder)
    folds = [b for b in _visible(everything) if b.first < b.last]
    gone = 0
    for outer in folds[: len(folds) - keep] if keep else folds:
        for b in everything:
            if b != outer and outer.first <= b.first and b.last <= outer.last:
                gone += bool(_files(spark, folder).delete(_path(spark, f"{folder}/{b.name}"), True))
    return gone
