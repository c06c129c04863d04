"""Files of a folder as a data source with its own listing (A1, A6), by URI.

Paths are local or of the schemes that Arrow's file systems know (file, hdfs,
s3, gs, abfs). Every file counts: also those whose name, or whose folder's name,
begins with a dot or an underscore, those without a byte, and names with blanks
or percent signs, which come out as they are.
"""

from __future__ import annotations

import os

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SOURCE = "folder_files"
PARTITION_BYTES = 32 << 20
PARTITION_FILES = 4096


def file_system(path: str):
    """(file system, path within it)."""
    from pyarrow import fs

    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    if "://" in path:
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), os.path.abspath(path)


class Some(InputPartition):
    """Files, or folders that are listed by the task that gets them."""

    def __init__(self, files: list[tuple[str, int]], folders: list[str]):
        super().__init__(0)
        self.files, self.folders = files, folders


class FolderReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.suffixes = options["path"], tuple(options.get("suffixes", "").split(","))
        self.recursive = options.get("recursive", "false") == "true"
        self.content = options.get("content", "false") == "true"

    def partitions(self) -> list[Some]:
        """Files of the folder in runs of bounded size; each of its folders is listed by a task."""
        from pyarrow import fs

        system, root = file_system(self.path)
        found = sorted(system.get_file_info(fs.FileSelector(root)), key=lambda i: i.path)
        out, files, size = [], [], 0
        for i in found:
            if i.type == fs.FileType.File and i.base_name.endswith(self.suffixes):
                if files and (size + i.size > PARTITION_BYTES or len(files) == PARTITION_FILES):
                    out.append(Some(files, []))
                    files, size = [], 0
                files.append((i.path, i.size))
                size += i.size
        out.append(Some(files, []))
        if self.recursive:
            out += [Some([], [i.path]) for i in found if i.type == fs.FileType.Directory]
        return out

    def read(self, partition: Some):
        from pyarrow import fs

        system, root = file_system(self.path)
        files = list(partition.files)
        for folder in partition.folders:
            files += sorted((i.path, i.size) for i in system.get_file_info(fs.FileSelector(folder, recursive=True))
                            if i.type == fs.FileType.File and i.base_name.endswith(self.suffixes))
        for path, size in files:
            data = None
            if self.content:
                with system.open_input_stream(path) as f:
                    data = f.read()
            yield pa.RecordBatch.from_arrays(
                [pa.array([path.removeprefix(root.rstrip("/") + "/")]), pa.array([size], pa.int64()),
                 pa.array([data], pa.binary())], ["path", "size", "content"])


class FolderFiles(DataSource):
    """Files of a folder: path (within it), size, content; options: path, suffixes, recursive, content."""

    @classmethod
    def name(cls) -> str:
        return SOURCE

    def schema(self) -> str:
        return "path string, size long, content binary"

    def reader(self, schema) -> FolderReader:
        return FolderReader(self.options)


def folder_files(spark: SparkSession, path: str, suffixes: tuple[str, ...], recursive: bool = False,
                 content: bool = False) -> DataFrame:
    """path (within the folder), size, and the bytes if asked for."""
    spark.dataSource.register(FolderFiles)
    return (spark.read.format(SOURCE).option("suffixes", ",".join(suffixes)).option("recursive", str(recursive).lower())
            .option("content", str(content).lower()).load(path))
