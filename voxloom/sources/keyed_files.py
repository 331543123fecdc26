"""One file per key, published in two phases.

Spark's own writers make a folder per value and files named by task. Here the rows of a key meet in one task,
which streams them into a file of its own attempt; the commit, once every task has ended well, moves the files of the
attempts that count to their names. A failed or repeated attempt leaves nothing behind, and readers never see half a file.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from urllib.parse import quote, unquote

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from ..operators.filters import Split
from .stores import locate

# Files moved at a time by the commit.
_MOVERS = 16


def file_name(key: str) -> str:
    """A key as a file name: marks that folders or hidden files would take otherwise are escaped, all else stays."""
    safe = quote(key, safe=" !#$&'()+,;=@[]{}~^-._" + "".join(c for c in key if c > "\x7f"))
    return "%" + format(ord(safe[0]), "02X") + safe[1:] if safe[:1] in ("_", ".") else safe


def key_of(name: str) -> str:
    return unquote(name)


@dataclass
class Attempt(WriterCommitMessage):
    """Where one attempt of a task has left its files."""

    folder: str
    files: int


class KeyedWriter(DataSourceArrowWriter):
    """Writes (name, content) rows, those of a name in a row, each name to a file."""

    def __init__(self, path: str, overwrite: bool):
        self.path, self.overwrite = path.rstrip("/"), overwrite
        self.work = f"{self.path}/_attempts-{uuid.uuid4().hex}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Attempt:
        task = TaskContext.get()
        own = f"{self.work}/{task.partitionId()}-{task.taskAttemptId()}" if task else f"{self.work}/{uuid.uuid4().hex}"
        store, folder = locate(own)
        name, out, files = None, None, 0
        try:
            for batch in iterator:
                for key, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                    if key != name:
                        if out is not None:
                            out.close()
                        if not files:
                            store.create_dir(folder)
                        place = f"{folder}/{file_name(key)}"
                        if store.get_file_info(place).type != fs.FileType.NotFound:
                            raise ValueError(f"the rows of {key!r} are not in one stretch")
                        name, out, files = key, store.open_output_stream(place), files + 1
                    if content.is_valid:
                        out.write(content.as_buffer())
        finally:
            if out is not None:
                out.close()
        return Attempt(own, files)

    def commit(self, messages: Sequence[Attempt | None]) -> None:
        store, target = locate(self.path)
        store.create_dir(target)
        work = locate(self.work)[1]
        if self.overwrite:
            for old in store.get_file_info(fs.FileSelector(target)):
                if old.path.rstrip("/") != work:
                    (store.delete_dir if old.type == fs.FileType.Directory else store.delete_file)(old.path)
        with ThreadPoolExecutor(_MOVERS) as pool:
            for message in messages:
                if message is not None and message.files:
                    found = store.get_file_info(fs.FileSelector(locate(message.folder)[1]))
                    list(pool.map(lambda f: store.move(f.path, f"{target}/{f.base_name}"), found))
        self._clear(store, work)

    def abort(self, messages: Sequence[Attempt | None]) -> None:
        store, work = locate(self.work)
        self._clear(store, work)

    @staticmethod
    def _clear(store: fs.FileSystem, work: str) -> None:
        if store.get_file_info(work).type == fs.FileType.Directory:
            store.delete_dir(work)


class KeyedFiles(DataSource):
    """The sink as a format: columns name and content, option ``path``."""

    @classmethod
    def name(cls) -> str:
        return "keyed_files"

    def schema(self) -> str:
        return "name string, content binary"

    def writer(self, schema, overwrite: bool) -> KeyedWriter:
        return KeyedWriter(self.options["path"], overwrite)


def write_keyed(df: DataFrame, path: str, name: Column, content: Column, order: Sequence[str] = (), mode: str = "overwrite") -> DataFrame:
    """One file below ``path`` for each ``name``, of the contents in ``order``; returns the rows without a name, which are not written.

    Contents are binary, or strings, which are written in UTF-8. With ``mode="append"`` other files stay, and a name that
    is written again is replaced. The rows of a name are streamed, so a file may be larger than a task's memory.
    """
    rows = df.withColumns({"_name": name.cast("string"), "_content": content.cast("binary")})
    # The number is given, or adaptive execution would put any number of short files into one task by their bytes.
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    named = rows.filter("length(_name) > 0").repartition(parts, "_name").sortWithinPartitions("_name", *order)
    df.sparkSession.dataSource.register(KeyedFiles)
    named.select(F.col("_name").alias("name"), F.col("_content").alias("content")).write.format("keyed_files").mode(mode).option("path", path).save()
    return rows.filter("_name IS NULL OR length(_name) = 0").select(*df.columns)


def write_subtitle_files(df: DataFrame, path: str, key: str = "video_id", mode: str = "overwrite") -> Split:
    """``<id>.txt`` for each id of (id, text, start, duration), a line per row by start, as ``parse_subtitles`` reads them.

    Times that are missing cannot be read back; such rows, and rows without an id, are rejects.
    """

    def quoted(c: str) -> Column:
        text = F.coalesce(F.col(c), F.lit(""))
        for mark, escape in (("\\", "\\\\"), ("'", "\\'"), ("\n", "\\n"), ("\r", "\\r")):
            text = F.replace(text, F.lit(mark), F.lit(escape))
        return F.concat(F.lit("'"), text, F.lit("'"))

    reason = F.when(F.coalesce(F.length(F.col(key).cast("string")), F.lit(0)) == 0, "no_id").when(F.col("start").isNull() | F.col("duration").isNull(), "no_time")
    tagged = df.withColumn("reason", reason)
    good = tagged.filter("reason IS NULL").drop("reason")
    line = F.concat(
        F.lit("{'text': "), quoted("text"), F.lit(", 'start': "), F.col("start").cast("string"), F.lit(", 'duration': "), F.col("duration").cast("string"), F.lit("},\n")
    )
    write_keyed(good, path, F.concat(F.col(key).cast("string"), F.lit(".txt")), line, ["start", "duration", "text"], mode)
    return Split(good, tagged.filter("reason IS NOT NULL"))
