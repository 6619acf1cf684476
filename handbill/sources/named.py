"""Text files of given names: a writer in two phases, and a folder of one JSON file a key as a cache."""

from __future__ import annotations

import json
import os
import time
import uuid
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

FORMAT = "named_text"


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    return fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{os.path.abspath(path)}")


@dataclass
class Written(WriterCommitMessage):
    """Files that a task has written beside the folder's own, by name."""

    staged: dict[str, str]


class NamedTextWriter(DataSourceWriter):
    """Tasks write to a hidden folder of the job; when all are done the driver moves files to their names.

    An attempt that fails, or that runs twice, leaves nothing but its part of the hidden folder, which goes with the job.
    """

    def __init__(self, path: str):
        self.path, self.job = path.rstrip("/"), f".writing-{uuid.uuid4().hex}"

    def write(self, iterator) -> Written:
        task = TaskContext.get()
        system, folder = file_system(self.path)
        own = f"{folder}/{self.job}/{task.partitionId()}-{task.taskAttemptId()}"
        system.create_dir(own, recursive=True)
        staged: dict[str, str] = {}
        for k, (name, body) in enumerate(iterator):
            if not name or "/" in name or name.startswith("."):
                raise ValueError(f"no name of a file: {name!r}")
            if name in staged:
                raise ValueError(f"two rows of one name: {name}")
            staged[name] = f"{own}/{k}"
            with system.open_output_stream(staged[name]) as out:
                out.write((body or "").encode())
        return Written(staged)

    def commit(self, messages: list[Written | None]) -> None:
        system, folder = file_system(self.path)
        names = Counter(n for m in messages if m for n in m.staged)
        twice = [n for n, k in names.items() if k > 1]
        if twice:
            self.abort(messages)
            raise ValueError(f"two rows of one name: {twice[0]}")
        for m in messages:
            for name, staged in m.staged.items() if m else ():
                system.move(staged, f"{folder}/{name}")
        self.abort(messages)

    def abort(self, messages: list[Written | None]) -> None:
        system, folder = file_system(self.path)
        if system.get_file_info(f"{folder}/{self.job}").type != fs.FileType.NotFound:
            system.delete_dir(f"{folder}/{self.job}")


class NamedText(DataSource):
    """Rows (name, body) as one UTF-8 text file each, in the folder that `path` names."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "name string, body string"

    def writer(self, schema, overwrite: bool) -> NamedTextWriter:
        if overwrite:
            raise ValueError("named files are added to a folder, or take the place of files of their names: use the mode append")
        return NamedTextWriter(self.options["path"])


def write_named(rows: DataFrame, folder: str) -> None:
    """One file for each of rows(name, body): files of other names stay, one of that name is replaced.

    Names are plain (no folders, not hidden), and none may come twice: the job fails then, as it does with any task, and leaves the
    folder as it was. A null body is an empty file. The folder is one that all executors reach.
    """
    rows.sparkSession.dataSource.register(NamedText)
    rows.select("name", "body").write.format(FORMAT).option("path", folder).mode("append").save()


def cached_files(spark: SparkSession, folder: str) -> DataFrame:
    """(cache_key, raw) of a cache that holds one JSON file for each key; empty where there is no such folder yet."""
    system, path = file_system(folder)
    system.create_dir(path, recursive=True)
    read = spark.read.option("pathGlobFilter", "*.json").text(folder, wholetext=True)
    return read.select(F.regexp_replace(F.col("_metadata.file_name"), r"\.json$", "").alias("cache_key"), F.col("value").alias("raw"))


def pretty_json(text: str) -> str | None:
    """JSON indented by two, characters as they are; None for what isn't JSON."""
    try:
        return json.dumps(json.loads(text), ensure_ascii=False, indent=2)
    except ValueError:
        return None


def fetch_claimed(folder: str, key: str, payload: str, provider: Callable[[str], str], wait: float, stale: float) -> str | None:
    """The answer for a key: from its file, or from the provider if this call claims the key first.

    A claim is a file that only one can create. Whoever comes second waits for the answer, up to `wait` seconds; a claim older than `stale`
    is of a run that was lost, and is taken over. An answer that isn't JSON is returned but not kept.
    """
    file, claim = f"{folder}/{key}.json", f"{folder}/.{key}.claim"
    until = time.monotonic() + wait
    while True:
        if os.path.exists(file):
            with open(file, encoding="utf-8") as f:
                return f.read()
        try:
            os.close(os.open(claim, os.O_CREAT | os.O_EXCL))
            break
        except FileExistsError:
            try:
                if time.time() - os.path.getmtime(claim) > stale:
                    os.rename(claim, f"{claim}-{uuid.uuid4().hex}")  # only one of those who see it succeeds
                    continue
            except FileNotFoundError:
                continue
        if time.monotonic() > until:
            return None
        time.sleep(0.05)
    try:
        if os.path.exists(file):
            with open(file, encoding="utf-8") as f:
                return f.read()
        answer = provider(payload)
        kept = pretty_json(answer)
        if kept is not None:
            part = f"{folder}/.{key}.{uuid.uuid4().hex}"
            with open(part, "w", encoding="utf-8") as f:
                f.write(kept)
            os.replace(part, file)
            return kept
        return answer
    finally:
        os.unlink(claim)


def read_through_files(asked: DataFrame, folder: str, provider: Callable[[str], str] | None = None, wait: float = 60.0, stale: float = 600.0) -> DataFrame:
    """asked(payload, cache_key, ...) with raw: from the cache folder, or fetched once for each key and kept there.

    The folder is a mounted one that all executors share, in the layout of one JSON file a key. Two runs over one folder don't fetch a key
    twice: see fetch_claimed. Without a provider what the cache lacks stays null, as does what another run still fetches.
    """
    spark = asked.sparkSession
    if provider is not None:
        missing = asked.select("payload", "cache_key").dropDuplicates(["cache_key"]).join(cached_files(spark, folder), "cache_key", "left_anti")
        path = file_system(folder)[1]

        def fetched(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for rows in batches:
                found = [fetch_claimed(path, k, p, provider, wait, stale) for k, p in zip(rows["cache_key"], rows["payload"], strict=True)]
                yield pd.DataFrame({"cache_key": rows["cache_key"], "found": [x is not None for x in found]})

        missing.mapInPandas(fetched, "cache_key string, found boolean").write.format("noop").mode("overwrite").save()
    return asked.join(cached_files(spark, folder), "cache_key", "left")


def compact(spark: SparkSession, folder: str, table: str) -> None:
    """Adds to the cache table at `table` (as sources.search reads it) the keys that only the folder has: one scan instead of a file a key."""
    from handbill.sources.search import cached

    cached_files(spark, folder).join(cached(spark, table), "cache_key", "left_anti").write.mode("append").parquet(table)
