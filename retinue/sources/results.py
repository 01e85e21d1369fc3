"""Results that are kept for as long as their sources do not change."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable
from urllib.parse import unquote, urlparse

from pyspark.sql import DataFrame, SparkSession

from retinue.sources.stored import StoredTable


def fingerprint(spark: SparkSession, question: str, sources: Iterable[DataFrame]) -> str:
    """A key of the question and of the names, sizes and times of all files behind the sources."""
    files = sorted({unquote(f) for df in sources for f in df.inputFiles()})
    conf = spark._jsc.hadoopConfiguration()
    digest = hashlib.sha256(question.encode())
    # Folders are listed once each, as Spark does when it plans a scan.
    for folder in sorted({f.rsplit("/", 1)[0] for f in files}):
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        found = {s.getPath().getName(): s for s in path.getFileSystem(conf).listStatus(path)}
        for file in (f for f in files if f.rsplit("/", 1)[0] == folder):
            status = found[file.rsplit("/", 1)[1]]
            line = f"{urlparse(file).path}|{status.getLen()}|{status.getModificationTime()}"
            digest.update(line.encode())
    return digest.hexdigest()


def remembered(
    spark: SparkSession, folder: str, question: str, sources: Iterable[DataFrame], compute: Callable[[], DataFrame]
) -> DataFrame:
    """The result of ``compute``, or what an earlier call of any session has kept in ``folder``.

    ``question`` names the result with all its parameters. A source file that was added,
    removed or written again makes another entry; nothing of the old one is read then.
    """
    table = StoredTable(spark, f"{folder.rstrip('/')}/{fingerprint(spark, question, sources)}")
    if not table.exists():
        table.replace(compute())
    return table.read()
