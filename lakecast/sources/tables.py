"""Tables: partitioned facts, quarantine, warehouse formats, and replacing a table by a query on itself."""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _path_in(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def table_exists(spark: SparkSession, path: str, fmt: str = "parquet") -> bool:
    """Is there a table at ``path``? Only "not there" gives False; any other failure is raised.

    Parquet: some data file below the path. Delta: its log folder.
    """
    target, fs = _path_in(spark, path)
    if not fs.exists(target):
        return False
    if fmt == "delta":
        return fs.exists(_path_in(spark, f"{path.rstrip('/')}/_delta_log")[0])
    files = fs.listFiles(target, True)
    while files.hasNext():
        name = files.next().getPath().getName()
        if not name.startswith(("_", ".")):
            return True
    return False


def delete_folder(spark: SparkSession, path: str) -> None:
    target, fs = _path_in(spark, path)
    fs.delete(target, True)


def publish_folder(spark: SparkSession, staged: str, path: str) -> None:
    """Make a written folder the table at ``path``, which holds no table yet, by one rename."""
    target, fs = _path_in(spark, path)
    # What an earlier attempt left there without data files would turn the rename into a move below it.
    fs.delete(target, True)
    fs.mkdirs(target.getParent())
    if not fs.rename(_path_in(spark, staged)[0], target):
        raise OSError(f"{staged} could not be renamed to {path}")


def scan_table(
    spark: SparkSession, path: str, fmt: str = "parquet", **options: str
) -> DataFrame:
    return spark.read.format(fmt).options(**options).load(path)


def write_partitioned(
    df: DataFrame,
    path: str,
    partition: str = "year",
    mode: str = "overwrite",
    fmt: str = "parquet",
    spread: bool = False,
) -> None:
    """Full load by partition column, without a shuffle.

    That suits input in rough time order, where a task meets one or two partitions. For
    input in any order ``spread`` shuffles by partition first, splitting hot ones, so that
    files stay few and even.
    """
    rows = df.hint("rebalance", partition) if spread else df
    rows.write.format(fmt).mode(mode).partitionBy(partition).save(path)


def write_quarantine(
    good: DataFrame, bad: DataFrame, good_path: str, bad_path: str, batch: str | None = None
) -> None:
    """Write both sides; no shuffle, no cache, each side is one filtered scan.

    Rows of a named ``batch`` replace what an earlier run of it left; they are in a folder
    of their own, which reads as the column ``batch``. Without a name they are appended.
    """
    for rows, path in ((good, good_path), (bad, bad_path)):
        if batch is None:
            rows.write.mode("append").parquet(path)
        else:
            rows.write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch={batch}")


def scan_warehouse(
    spark: SparkSession, name: str, fmt: str | None = None, **options: str
) -> DataFrame:
    """Catalog table ``name``, or any connector ``fmt`` on the classpath with its options."""
    if fmt is None:
        return spark.table(name)
    return spark.read.format(fmt).options(table=name, **options).load()


def write_warehouse(
    df: DataFrame, name: str, mode: str, fmt: str | None = None, **options: str
) -> None:
    """Write ``overwrite`` or ``append`` to a catalog table, or through connector ``fmt``."""
    if mode not in ("overwrite", "append"):
        raise ValueError(f"mode must be 'overwrite' or 'append', not {mode!r}")
    if fmt is None:
        df.write.mode(mode).saveAsTable(name)
    else:
        df.write.format(fmt).options(table=name, **options).mode(mode).save()


def create_or_replace_as(df: DataFrame, path: str, fmt: str = "parquet") -> DataFrame:
    """Materialise one step and read it back, so later steps start from files."""
    df.write.format(fmt).mode("overwrite").save(path)
    return df.sparkSession.read.format(fmt).load(path)


_POINTER = "CURRENT"
_HISTORY = "_pointers"
_VERSION = "version"


def current_folders(spark: SparkSession, root: str) -> list[str]:
    """The folders below ``root`` that make up a replaceable table now: whole versions or single partitions of them."""
    return [r[0] for r in spark.read.text(f"{root.rstrip('/')}/{_POINTER}").collect()]


def read_current(spark: SparkSession, root: str) -> DataFrame:
    """A replaceable table as its pointer names it; files of it stay as they are until versions are removed."""
    root = root.rstrip("/")
    names = current_folders(spark, root)
    if len(names) == 1 and "/" not in names[0]:
        return spark.read.parquet(f"{root}/{names[0]}")
    return _folders(spark, root, names).drop(_VERSION)


def _folders(spark: SparkSession, root: str, names: list[str]) -> DataFrame:
    return spark.read.option("basePath", root).parquet(*(f"{root}/{n}" for n in names))


def _write_version(df: DataFrame, root: str, partition_by: list[str]) -> str:
    if _VERSION in (c.lower() for c in df.columns):
        raise ValueError(f"a replaceable table keeps the name {_VERSION!r} for itself")
    version = f"{_VERSION}={uuid.uuid4().hex}"
    rows = df.hint("rebalance", *partition_by) if partition_by else df
    rows.write.partitionBy(*partition_by).parquet(f"{root}/{version}")
    return version


def _point_to(spark: SparkSession, root: str, names: list[str]) -> None:
    """Makes ``names`` the table: noted in the pointer's history, then renamed over the old pointer."""
    name = f"{time.time_ns():020d}-{uuid.uuid4().hex}"
    for path in (f"{root}/{_HISTORY}/{name}", f"{root}/_{name}"):
        target, fs = _path_in(spark, path)
        out = fs.create(target, True)
        try:
            out.write(bytearray("\n".join(names), "utf-8"))
        finally:
            out.close()
    _rename_over(spark, target, _path_in(spark, f"{root}/{_POINTER}")[0])


def replace_self(df: DataFrame, root: str, partition_by: Sequence[str] = (), keep: int | None = None) -> DataFrame:
    """Replace a table by a query that may read it, for instance a union with itself.

    The new rows go to a fresh version folder while the old one stays readable; only then
    a new pointer is written and renamed over the old one. A job that dies at any point leaves
    the old version or the new one in place. With ``keep``, only so many last states of the
    table stay (``remove_versions``). One writer at a time.
    """
    spark, root = df.sparkSession, root.rstrip("/")
    _point_to(spark, root, [_write_version(df, root, list(partition_by))])
    if keep is not None:
        remove_versions(spark, root, keep)
    return read_current(spark, root)


def append_to_current(df: DataFrame, root: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Adds rows to a replaceable table in a folder of their own; no stored row is read or written.

    Columns are matched by name. Without a table, the rows become one.
    """
    spark, root = df.sparkSession, root.rstrip("/")
    target, fs = _path_in(spark, f"{root}/{_POINTER}")
    names = current_folders(spark, root) if fs.exists(target) else []
    rows = df.select(*(F.col(f"`{c}`") for c in read_current(spark, root).columns)) if names else df
    _point_to(spark, root, [*names, _write_version(rows, root, list(partition_by))])
    return read_current(spark, root)


def compact(spark: SparkSession, root: str, target_bytes: int = 128 * 1024 * 1024) -> list[str]:
    """Merges small files of a replaceable table; returns the partitions that were rewritten.

    A partition is rewritten if it has at least twice the files that its bytes need at ``target_bytes``
    each; others are neither read nor written, the new pointer names their folders where they are. Readers of the
    state before keep their files. Partition values are what Spark reads from folder names.
    """
    root = root.rstrip("/")
    files: dict[str, list[int]] = {}
    folders: dict[str, set[str]] = {}
    for name in current_folders(spark, root):
        target, fs = _path_in(spark, f"{root}/{name}")
        base = fs.makeQualified(target).toString()
        found = fs.listFiles(target, True)
        while found.hasNext():
            status = found.next()
            if status.getPath().getName().startswith(("_", ".")):
                continue
            folder = f"{name}{status.getPath().getParent().toString()[len(base) :]}"
            partition = folder.partition("/")[2]
            files.setdefault(partition, []).append(status.getLen())
            folders.setdefault(partition, set()).add(folder)
    crowded = sorted(p for p, sizes in files.items() if len(sizes) >= 2 * max(1, -(-sum(sizes) // target_bytes)))
    if not crowded:
        return []
    rows = _folders(spark, root, sorted(f for p in crowded for f in folders[p])).drop(_VERSION)
    keys = [level.partition("=")[0] for level in crowded[0].split("/")] if crowded[0] else []
    if keys:
        version = _write_version(rows, root, keys)
    else:
        version = _write_version(rows.coalesce(max(1, -(-sum(files[""]) // target_bytes))), root, [])
    others = sorted(f for p in files.keys() - set(crowded) for f in folders[p])
    _point_to(spark, root, [version, *others])
    return crowded


def remove_versions(spark: SparkSession, root: str, keep: int = 2) -> int:
    """Deletes what the last ``keep`` states of a replaceable table do not name; returns the number of folders deleted.

    The current state always stays. Readers of older states must have ended, and nothing may be written meanwhile.
    """
    if keep < 1:
        raise ValueError("the current state has to stay")
    root = root.rstrip("/")
    history, fs = _path_in(spark, f"{root}/{_HISTORY}")
    states = sorted(s.getPath().getName() for s in fs.listStatus(history)) if fs.exists(history) else []
    states = [s for s in states if not s.startswith((".", "_"))]
    live = set(current_folders(spark, root))
    # The newest states count; older pointers go with their folders.
    for state in states[-keep:]:
        live.update(r[0] for r in spark.read.text(f"{root}/{_HISTORY}/{state}").collect())
    gone = 0
    pending = [s.getPath() for s in fs.globStatus(_path_in(spark, f"{root}/{_VERSION}=*")[0]) or []]
    start = len(fs.makeQualified(_path_in(spark, root)[0]).toString()) + 1
    while pending:
        path = pending.pop()
        name = path.toString()[start:]
        if name in live:
            continue
        if any(other.startswith(f"{name}/") for other in live):
            # Some partitions of this folder are named on their own.
            pending.extend(s.getPath() for s in fs.listStatus(path) if s.isDirectory())
        else:
            fs.delete(path, True)
            gone += 1
    for state in states[:-keep]:
        fs.delete(_path_in(spark, f"{root}/{_HISTORY}/{state}")[0], False)
    return gone


def remove_batches(spark: SparkSession, path: str, keep: int) -> int:
    """Deletes all but the ``keep`` newest batches of a quarantine table; returns how many went. Ties go by name."""
    found = _path_in(spark, f"{path.rstrip('/')}/batch=*")
    batches = sorted(found[1].globStatus(found[0]) or [], key=lambda s: (s.getModificationTime(), s.getPath().getName()))
    old = batches[: max(0, len(batches) - keep)]
    for status in old:
        found[1].delete(status.getPath(), True)
    return len(old)


def _rename_over(spark: SparkSession, source, target) -> None:
    """Rename a file over another, which stays if the rename fails."""
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    how = gateway.new_array(kind, 1)
    how[0] = kind.OVERWRITE
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(source.toUri(), conf).rename(source, target, how)


def latest_in_partitions(
    spark: SparkSession, path: str, time: str, partition: str = "year", fmt: str = "parquet"
):
    """Largest ``time`` of a table partitioned by a rising function of it; None when empty.

    The partition folders come from the file listing, so only the newest one is scanned.
    """
    target, fs = _path_in(spark, f"{path.rstrip('/')}/{partition}=*")
    found = [s.getPath().getName().split("=", 1)[1] for s in fs.globStatus(target) or []]
    table = scan_table(spark, path, fmt)
    for value in sorted((int(v) for v in found if v.lstrip("-").isdigit()), reverse=True):
        top = table.where(F.col(partition) == value).agg(F.max(time)).first()[0]
        if top is not None:
            return top
    return table.agg(F.max(time)).first()[0]


def as_rows(df: DataFrame, order_by: list[str | Column], n: int) -> list[dict]:
    """At most ``n`` rows for display, ordered."""
    return [row.asDict() for row in df.orderBy(*order_by).limit(n).collect()]
