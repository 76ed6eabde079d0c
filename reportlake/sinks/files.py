"""Many small text files by folder, as a Spark data source: the files of module CSVs.

Spark's own writer goes through Hadoop's local file system, which starts a process for every
folder and every file it makes (to set their permissions), some 40 ms of a task for a module.  Here a
task makes them by plain system calls.  Its files are hidden and beside their final place until
all tasks are done; the commit only renames them, and a job that fails leaves nothing.
"""

from __future__ import annotations

from urllib.parse import unquote, urlsplit

from pyspark.sql import SparkSession

#: Threads that rename files at the commit of a job.
COMMIT_THREADS = 16


def local_path(spark: SparkSession, base: str) -> str | None:
    """``base`` as a path of the mounted file system; None if another file system holds it."""
    try:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(base)
        fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        full = str(fs.makeQualified(path).toUri())
    except Exception:  # noqa: BLE001 -- no SparkContext on Spark Connect
        return None
    parts = urlsplit(full)
    return unquote(parts.path) if parts.scheme == "file" else None


def module_files() -> type:
    """The data source ``reportlake_module_files``; its rows are three folder names and a line of text (null: no line).

    Rows must come sorted by folder within a task.  Options: ``folder``, ``header`` (the first line of
    every file), ``job`` (unique, part of the file names).  ``overwrite`` replaces the
    files of the folders that are written, and of no others.  (A class made here travels to the workers by value, so they
    need not have this library.)
    """
    import os
    from concurrent.futures import ThreadPoolExecutor
    from contextlib import suppress
    from dataclasses import dataclass

    from pyspark import TaskContext
    from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

    threads = COMMIT_THREADS

    @dataclass
    class Written(WriterCommitMessage):
        listed: str  # a file with the folders that hold a hidden file of the task
        name: str

    class FolderWriter(DataSourceWriter):
        def __init__(self, options, overwrite):
            self.folder, self.header, self.job = options["folder"], options.get("header", ""), options["job"]
            self.overwrite = overwrite
            self.notes = f"{self.folder}/_temporary-{self.job}"

        def write(self, iterator):
            at = TaskContext.get()
            name = f"part-{at.partitionId():05d}-{self.job}.csv"
            os.makedirs(self.notes, exist_ok=True)
            listed = f"{self.notes}/{at.partitionId():05d}-{at.taskAttemptId()}"
            # hidden files of two attempts of a task are told apart by the attempt
            hidden = f".{name}-{at.taskAttemptId()}"
            last, out = None, None
            try:
                with open(listed, "w", encoding="utf-8") as note:
                    try:
                        for *keys, line in iterator:
                            if keys != last:
                                if out is not None:
                                    out.close()
                                where = "/".join(f"{k}={v}" for k, v in zip(("__report_dir", "__report", "__module"), keys))
                                os.makedirs(f"{self.folder}/{where}", exist_ok=True)
                                note.write(where + "\n")
                                out = open(f"{self.folder}/{where}/{hidden}", "w", encoding="utf-8", newline="")
                                out.write(self.header + "\n")
                                last = keys
                            if line is not None:
                                out.write(line + "\n")
                    finally:
                        if out is not None:
                            out.close()
            except BaseException:
                self.each([listed], self.drop)
                raise
            return Written(listed, name)

        def each(self, lists, do):
            """Call ``do`` for every folder in ``lists``, by some threads, one list of a task at a time in each."""
            def one(path):
                with open(path, encoding="utf-8") as note:
                    for where in note:
                        do(f"{self.folder}/{where[:-1]}", os.path.basename(path))
                os.remove(path)

            with ThreadPoolExecutor(threads) as pool:
                for _ in pool.map(one, lists):
                    pass

        def drop(self, folder, at):
            name = f".part-{at.split('-')[0]}-{self.job}.csv-{at.split('-')[1]}"
            with suppress(FileNotFoundError):
                os.remove(f"{folder}/{name}")

        def commit(self, messages):
            done = {m.listed: m.name for m in messages if m is not None}

            def publish(folder, at):
                name = f"part-{at.split('-')[0]}-{self.job}.csv"
                if self.overwrite:
                    for old in os.listdir(folder):
                        if self.job not in old:
                            with suppress(FileNotFoundError):  # the files of a module may be of several tasks
                                os.remove(f"{folder}/{old}")
                os.rename(f"{folder}/.{name}-{at.split('-')[1]}", f"{folder}/{name}")

            self.each(sorted(done), publish)
            self.clear()
            open(f"{self.folder}/_SUCCESS", "w").close()

        def abort(self, messages):
            self.clear()

        def clear(self):
            """Take away the hidden files of attempts that are not part of the result."""
            with suppress(OSError):  # a task that is not stopped yet takes its own away, and may be about to
                self.each([f"{self.notes}/{n}" for n in os.listdir(self.notes)], self.drop)
                os.rmdir(self.notes)

    class ModuleFiles(DataSource):
        @classmethod
        def name(cls):
            return "reportlake_module_files"

        def schema(self):
            return "__report_dir string, __report string, __module string, __line string"

        def writer(self, schema, overwrite):
            return FolderWriter(dict(self.options), overwrite)

    return ModuleFiles
