"""The files of a case: listed by Hadoop, so that a case may lie in any store that Spark reads."""

from __future__ import annotations

from pyspark.sql import SparkSession

from evidentia.plans import maps


def listed(spark: SparkSession, folder: str) -> list[str]:
    """All files below a folder, in order; hidden ones and those of other tools' bookkeeping (a leading . or _) are left out."""
    context = spark.sparkContext
    root = context._jvm.org.apache.hadoop.fs.Path(folder)
    store = root.getFileSystem(context._jsc.hadoopConfiguration())
    found, entries = [], store.listFiles(root, True)
    start = store.makeQualified(root).toString().rstrip("/") + "/"
    while entries.hasNext():
        path = entries.next().getPath().toString()
        if not any(p.startswith((".", "_SUCCESS", "_temporary")) for p in path.removeprefix(start).split("/")):
            found.append(path)
    return sorted(found)


def files(spark: SparkSession, folder: str) -> list[tuple[str, str, str | None]]:
    """(source, path, default host) of the files of a case that can be read: <folder>/<source>/.../<file>.

    A source's files may lie in further folders, one for each tool. Files that no route knows are left out, but for .jsonl files,
    which may be containers. Only names are listed on the driver.
    """
    context = spark.sparkContext
    root = context._jvm.org.apache.hadoop.fs.Path(folder)
    start = root.getFileSystem(context._jsc.hadoopConfiguration()).makeQualified(root).toString().rstrip("/") + "/"
    out = []
    for path in listed(spark, folder):
        source, _, rest = path.removeprefix(start).partition("/")
        if rest and (maps.route(path) or (path.endswith(".jsonl") and not maps.known(path))):
            out.append((source, path, None))
    return out
