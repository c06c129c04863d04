"""JSON array files: a committed sink of one array per (split, document), and a reader that splits large arrays.

Sink (A7). :class:`ArrayFiles` is a data source writer. A task streams its
groups into files of a staging folder of its own, lists their names in a file
there and reports the folder; the driver moves what the committed tasks listed to
the final names ``<split>-<document>-synthetic-data-<run>.json``, so many names at
a time. A failed or repeated task so adds no file, and a run that is written again
replaces its files (and clears what a killed task may have left in the staging
folder).

Reader (A8). There may be two files for each document, so the folder is listed by
a task, its files are cut into splits there, and the splits are read by many tasks;
no file's name passes the driver. (Folders that Arrow's file systems don't know are
listed and read by Spark's text source.) A split begins after a comma and ends at
one, so one file feeds as many tasks as it has splits. Whether a comma ends an element
depends on what came before: on being within a string and on the depth of
brackets. Each split is summed up for both cases of beginning within a string or
not (:func:`_summaries`); running sums over the splits of a file then give every
split's state at its beginning, and a second pass cuts the elements
(:func:`_elements`). Elements that go over splits are put together by a
group-by. A task holds a batch and an element, however large the file is.
"""

from __future__ import annotations

import hashlib
import io
import json
import os
import re
import unicodedata
import uuid
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from .files import file_system

SINK = "qa_array_files"
SINK_SCHEMA = "split string, document_name string, part int, record string"


class Written(WriterCommitMessage):
    """A task's staging folder, null if it wrote no file; its list ``names`` has the final name of file 0, 1, ..."""

    def __init__(self, folder: str | None):
        self.folder = folder


NAMES = 8192  # names that are held at once


def _listing(system, root: str):
    """(path, name, is it a folder) of what lies directly inside a folder; of a local one nothing is held."""
    from pyarrow import fs

    if isinstance(system, fs.LocalFileSystem):
        try:
            with os.scandir(root) as found:
                for i in found:
                    yield i.path, i.name, i.is_dir()
        except FileNotFoundError:
            pass
        return
    for i in system.get_file_info(fs.FileSelector(root, allow_not_found=True)):
        yield i.path, i.base_name, i.type == fs.FileType.Directory


def _digest(name: str) -> bytes:
    return hashlib.blake2b(name.encode(), digest_size=16).hexdigest().encode()


class ArrayFilesWriter(DataSourceArrowWriter):
    def __init__(self, options: dict):
        self.path, self.run, self.job = options["path"].rstrip("/"), options["run"], uuid.uuid4().hex

    def _name(self, split: str, document: str, part: int) -> str:
        name = f"{split}-{document}".replace("/", "%2F")
        return f"{name}{self._ending(part)}"

    def _ending(self, part: int) -> str:
        return f"-synthetic-data-{self.run}" + (f".part-{part}" if part else "") + ".json"

    def _staging(self, root: str) -> str:
        return f"{root}/_staging-{self.run}-{self.job}"

    def write(self, iterator) -> Written:
        """Sorted rows (split, document_name, part, record): an array for each group; a null record adds nothing."""
        system, root = file_system(self.path)
        folder = f"{self._staging(root)}/{uuid.uuid4().hex}"
        n, key, out, empty, names = 0, None, None, True, None
        try:
            for b in iterator:
                for split, document, part, record in zip(*(b.column(i).to_pylist() for i in range(4))):
                    if (split, document, part) != key:
                        if out is not None:
                            out.write(b"\n]")
                            out.close()
                        else:
                            system.create_dir(folder, recursive=True)
                            names = system.open_output_stream(f"{folder}/names")
                        key, empty = (split, document, part), True
                        names.write(json.dumps(self._name(*key)).encode() + b"\n")
                        out = system.open_output_stream(f"{folder}/{n}")
                        n += 1
                        out.write(b"[")
                    if record is not None:
                        out.write((b"\n" if empty else b",\n") + record.encode())
                        empty = False
            if out is not None:
                out.write(b"\n]")
                out.close()
                names.close()
        except BaseException:
            if out is not None:
                out.close()
                names.close()
                system.delete_dir(folder)
            raise
        return Written(folder if n else None)

    def commit(self, messages: list) -> None:
        from concurrent.futures import ThreadPoolExecutor

        system, root = file_system(self.path)
        system.create_dir(root, recursive=True)
        mark = f"-synthetic-data-{self.run}."
        before = any(mark in name and not folder for _, name, folder in _listing(system, root))
        now = []
        with ThreadPoolExecutor(16) as pool:
            for folder in (m.folder for m in messages if m is not None and m.folder):
                with system.open_input_stream(f"{folder}/names") as stream:
                    lines = enumerate(map(json.loads, io.BufferedReader(stream)))
                    while some := list(islice(lines, NAMES)):
                        list(pool.map(lambda f: system.move(f"{folder}/{f[0]}", f"{root}/{f[1]}"), some))
                        if before:
                            now.append(np.array([_digest(name) for _, name in some]))
        if before:  # what an earlier writing of this run left and this one didn't write
            now = np.sort(np.concatenate([np.zeros(0, "S32"), *now]))
            for path, name, folder in _listing(system, root):
                if mark in name and not folder:
                    at = np.searchsorted(now, _digest(name))
                    if at == len(now) or now[at] != _digest(name):
                        system.delete_file(path)
        self._clear(system, root)

    def abort(self, messages: list) -> None:
        system, root = file_system(self.path)
        self._clear(system, root)

    def _clear(self, system, root: str) -> None:
        """Deletes the staging folders of this run, also of an earlier try that was killed."""
        for path, name, folder in _listing(system, root):
            if folder and name.startswith(f"_staging-{self.run}-"):
                system.delete_dir(path)


class ArrayFiles(DataSource):
    """Sink of JSON array files; options: path, run."""

    @classmethod
    def name(cls) -> str:
        return SINK

    def schema(self) -> str:
        return SINK_SCHEMA

    def writer(self, schema, overwrite: bool) -> ArrayFilesWriter:
        return ArrayFilesWriter(self.options)


def write_arrays(rows: DataFrame, path: str, run: str) -> None:
    """Writes rows (split, document_name, part, record), which lie together in order, as array files."""
    spark = rows.sparkSession
    spark.dataSource.register(ArrayFiles)
    rows.write.format(SINK).mode("append").option("run", run).save(path)


# --- reader -------------------------------------------------------------------------
SPLIT_BYTES = 32 << 20
OPEN_BYTES = 32 << 10  # what opening a file counts as
READ_BYTES = 1 << 20
_SPLITS = "file string, path string, size long, block long, until long"
_PIECES = "file string, block long, value string, size long"


def _quoted(name: str) -> str:
    """A file's name as in the paths that Spark's sources give."""
    return "".join(c if c.isalnum() and c.isascii() or c in "_-!.~'()*;:@&=+$," or (not c.isascii() and unicodedata.category(c)[0] != "Z" and unicodedata.category(c) != "Cc")
                   else "".join(f"%{x:02X}" for x in c.encode()) for c in name)


def _splits(path: str, base: str, split_bytes: int):
    """The splits of a folder's files, listed by the task that gets a row. Hidden files are left out, as by Spark's sources."""
    def run(batches):
        def batch(rows):
            return pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], ["file", "path", "size", "block", "until"])

        for b in batches:
            if not b.num_rows:
                continue
            system, root = file_system(path)
            rows = []
            for at, name, folder in _listing(system, root):
                if folder or not name.endswith(".json") or name.startswith(".") or (name.startswith("_") and "=" not in name):
                    continue
                size = system.get_file_info(at).size
                for begin in range(0, size, split_bytes):
                    rows.append((f"{base}/{_quoted(name)}", at, size, begin, min(size, begin + split_bytes)))
                    if len(rows) == NAMES:
                        yield batch(rows)
                        rows = []
            if rows:
                yield batch(rows)
    return run


def _read_split(f, begin: int, until: int):
    """The text of a split, cut at commas: from the first comma of the split to the first one behind it."""
    f.seek(begin)
    started, at, held = begin == 0, begin, []
    while chunk := f.read(READ_BYTES):
        a, at = at, at + len(chunk)
        if not started:
            i = chunk.find(b",", 0, until - a)
            if i < 0:
                if at >= until:
                    return
                continue
            started, a, chunk = True, a + i + 1, chunk[i + 1:]
        if at > until:
            i = chunk.find(b",", max(0, until - a))
            if i >= 0:
                yield b"".join([*held, chunk[:i]])
                return
        i = chunk.rfind(b",")
        if i >= 0:
            yield b"".join([*held, chunk[:i]])
            held = []
        held.append(chunk[i + 1:])
    if started:
        yield b"".join(held)


def _read_splits(path: str):
    """Rows of :func:`_splits` to their pieces, a batch of about ``READ_BYTES`` at a time."""
    def run(batches):
        def batch(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                zip(*rows), (pa.string(), pa.int64(), pa.string(), pa.int64()))], ["file", "block", "value", "size"])

        system, _ = file_system(path)
        rows, held = [], 0
        for b in batches:
            for r in b.to_pylist():
                with system.open_input_file(r["path"]) as f:
                    for value in _read_split(f, r["block"], r["until"]):
                        rows.append((r["file"], r["block"], value.decode(), r["size"]))
                        held += len(value)
                        if held >= READ_BYTES or len(rows) == NAMES:
                            yield batch(rows)
                            rows, held = [], 0
        if rows:
            yield batch(rows)
    return run


def _pieces(spark: SparkSession, path: str, split_bytes: int | None) -> DataFrame | None:
    """file, block, value, size: pieces of a folder's files, in the order of each split; null if Arrow can't list it."""
    from pyarrow import fs

    try:
        system, root = file_system(path)
        if system.get_file_info(root).type != fs.FileType.Directory:
            return None
    except (OSError, ValueError, pa.ArrowException):
        return None
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder = folder.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(folder).getPath()
    base = re.sub("^file:/+", "file:/", folder.toUri().toString()).rstrip("/")
    splits = _kept(spark.range(0, 1, 1, 1).mapInArrow(_splits(path, base, split_bytes or SPLIT_BYTES), _SPLITS))
    cost = splits.agg(F.sum(F.col("until") - F.col("block") + OPEN_BYTES)).first()[0] or 0
    splits = splits.repartition(max(1, -(-cost // SPLIT_BYTES)), "file", "block")
    return splits.mapInArrow(_read_splits(path), _PIECES)


_QUOTE, _SLASH, _COMMA, _OPEN, _CLOSE = 34, 92, 44, (91, 123), (93, 125)


class _Scan:
    """Structure of consecutive bytes: quotes that aren't escaped, brackets and commas."""

    def __init__(self):
        self.pending = False  # whether the next byte is escaped

    def special(self, data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places of quotes, brackets and commas; their bytes; the number of quotes up to each (modulo 2)."""
        b = np.frombuffer(data, np.uint8)
        slash = np.flatnonzero(b == _SLASH)
        if self.pending and len(slash) and slash[0] == 0:
            slash = slash[1:]
        escaped = np.zeros(len(b) + 1, bool)
        escaped[0] = self.pending
        if len(slash):
            first = np.r_[True, np.diff(slash) > 1]
            run = np.maximum.accumulate(np.where(first, np.arange(len(slash)), 0))
            odd = (np.arange(len(slash)) - run) % 2 == 0  # a backslash that escapes what follows
            escaped[slash[odd] + 1] = True
        if len(b):
            self.pending = bool(escaped[len(b)])
        kind = np.zeros(256, bool)
        kind[[_QUOTE, _COMMA, *_OPEN, *_CLOSE]] = True
        at = np.flatnonzero(kind[b] & ~escaped[:-1])
        return at, b[at], np.cumsum(b[at] == _QUOTE) & 1


def _steps(kind: np.ndarray, outside: np.ndarray) -> np.ndarray:
    """+1 at opening and -1 at closing brackets outside strings."""
    return (np.isin(kind, _OPEN).astype(np.int64) - np.isin(kind, _CLOSE)) * outside


def _segments(b: pa.RecordBatch):
    """(file, block, first row, row after the last) of the rows of one split that follow each other."""
    files, blocks = b.column(0).to_pylist(), b.column(1).to_pylist()
    a = 0
    for i in range(1, len(files) + 1):
        if i == len(files) or (files[i], blocks[i]) != (files[a], blocks[a]):
            yield files[a], blocks[a], a, i
            a = i


def _summaries(batches):
    """Rows (file, block, value, size of the file) in the order of the files to one row a split."""
    names = ["file", "block", "bytes", "size", "head", "parity", "delta", "commas"]
    key = None

    def out():
        return pa.RecordBatch.from_pylist([{
            "file": key[0], "block": key[1], "bytes": length, "size": size, "head": head, "parity": parity, "delta": delta,
            "commas": [[{"depth": d, "n": n} for d, n in sorted(c.items())] for c in commas]}], schema=schema)

    pair = pa.struct([("depth", pa.int64()), ("n", pa.int64())])
    schema = pa.schema([("file", pa.string()), ("block", pa.int64()), ("bytes", pa.int64()), ("size", pa.int64()),
                        ("head", pa.string()), ("parity", pa.int64()),
                        ("delta", pa.list_(pa.int64())), ("commas", pa.list_(pa.list_(pair)))])
    assert schema.names == names
    for b in batches:
        values = b.column(2).to_pylist()
        for file, block, a, z in _segments(b):
            text = ",".join(values[a:z])
            if (file, block) != key:
                if key:
                    yield out()
                key, head, parity, delta, commas, scan = (file, block), None, 0, [0, 0], [{}, {}], _Scan()
                length, size = 0, b.column(3)[a].as_py()
                text = text if block == 0 else "," + text
            else:
                text = "," + text
            if block == 0 and head is None:
                head = text.lstrip()[:1] or None
            data = text.encode()
            length += len(data)
            _, kind, quotes = scan.special(data)
            for case in (0, 1):  # the split begins outside or within a string
                outside = (quotes ^ parity ^ case) == 0
                depth = delta[case] + np.cumsum(_steps(kind, outside))
                for d, n in zip(*np.unique(depth[(kind == _COMMA) & outside], return_counts=True)):
                    commas[case][int(d)] = commas[case].get(int(d), 0) + int(n)
                delta[case] = int(depth[-1]) if len(depth) else delta[case]
            parity ^= int(quotes[-1]) if len(quotes) else 0
    if key:
        yield out()


def _elements(batches):
    """Sorted rows (file, block, side, value, within, depth, element): a split's state (side 0), then its pieces.

    Gives (file, element, block, fragment, whole, stray): stray is text outside the array.
    """
    names = ["file", "element", "block", "fragment", "whole", "stray"]
    key, held = None, None

    def rows(found):
        cols = list(zip(*found))
        types = (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.bool_())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names)

    def rest():
        """The fragment that the split leaves unfinished."""
        if key and held["open"]:
            yield rows([(key[0], held["element"], key[1], b"".join(held["parts"]).decode(), False, False)])

    for b in batches:
        side, values = b.column(2).to_pylist(), b.column(3).to_pylist()
        state = [b.column(i).to_pylist() for i in (4, 5, 6)]
        for file, block, a, z in _segments(b):
            if side[a] == 0:
                yield from rest()
                key = file, block
                held = {"within": state[0][a], "depth": state[1][a], "element": state[2][a], "open": state[1][a] >= 1,
                        "began": False, "parts": [], "scan": _Scan(), "first": block == 0}
                a += 1
            if a == z or (file, block) != key:
                continue
            data = (("" if held["first"] else ",") + ",".join(values[a:z])).encode()
            at, kind, quotes = held["scan"].special(data)
            outside = (quotes ^ held["within"]) == 0
            step = _steps(kind, outside)
            depth = held["depth"] + np.cumsum(step)
            cut = outside & (((kind == _COMMA) & (depth == 1)) | ((step > 0) & (depth == 1)) | ((step < 0) & (depth == 0)))
            found, begin = [], 0
            for place in at[cut].tolist():
                text, what = data[begin:place], data[place]
                begin = place + 1
                if what in _OPEN:
                    if not held["first"] or text.strip() or held["began"] or what != 91:
                        found.append((file, None, block, None, True, True))
                    held.update(open=True, began=True, parts=[])
                    continue
                held["parts"].append(text)
                found.append((file, held["element"], block, b"".join(held["parts"]).decode(), held["began"], False))
                held["parts"], held["began"], held["open"] = [], True, what == _COMMA
                held["element"] += what == _COMMA
            if held["open"]:
                held["parts"].append(data[begin:])
            elif data[begin:].strip():
                found.append((file, None, block, None, True, True))
            held["within"] ^= int(quotes[-1]) if len(quotes) else 0
            held["depth"], held["first"] = int(depth[-1]) if len(depth) else held["depth"], False
            if found:
                yield rows(found)
    yield from rest()


def read_arrays(spark: SparkSession, path: str, split_bytes: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Elements and files of the ``*.json`` files directly inside a folder.

    elements: file, element (from 0), entry (its text), of files that begin with a bracket.
    files: file, is_array, complete: one closed array and nothing beside it. Files
    without any text are not among them.
    """
    pieces = _pieces(spark, path, split_bytes)
    r = spark.read.option("pathGlobFilter", "*.json").option("lineSep", ",")
    if split_bytes:  # (as the files are listed, so an option of the session)
        before = spark.conf.get("spark.sql.files.maxPartitionBytes")
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(split_bytes))
    try:
        if pieces is None:
            pieces = r.text(path).select(F.col("_metadata.file_path").alias("file"),
                                         F.col("_metadata.file_block_start").alias("block"), "value",
                                         F.col("_metadata.file_size").alias("size"))
        summed = pieces.mapInArrow(
            _summaries, "file string, block long, bytes long, size long, head string, parity long, delta array<long>, "
                        "commas array<array<struct<depth:long,n:long>>>")
        summed = _kept(summed)
        order = Window.partitionBy("file").orderBy("block")
        before_it = order.rowsBetween(Window.unboundedPreceding, -1)
        s = summed.withColumn("within", (F.coalesce(F.sum("parity").over(before_it), F.lit(0)) % 2).cast("long"))
        s = s.withColumn("step", F.get("delta", F.col("within").cast("int")))
        s = s.withColumn("depth", F.coalesce(F.sum("step").over(before_it), F.lit(0)).cast("long"))
        ends = F.filter(F.get("commas", F.col("within").cast("int")), lambda c: c["depth"] == 1 - F.col("depth"))
        s = s.withColumn("n", F.coalesce(F.get(ends, 0)["n"], F.lit(0)))
        s = s.withColumn("element", F.coalesce(F.sum("n").over(before_it), F.lit(0)).cast("long"))
        files = s.groupBy("file").agg(
            F.coalesce(F.max(F.when(F.col("block") == 0, F.col("head"))) == "[", F.lit(False)).alias("is_array"),
            # the text source gives no piece after a comma at the very end; then a byte is missing
            ((F.sum("parity") % 2 == 0) & (F.sum("step") == 0) & (F.sum("bytes") == F.max("size"))).alias("closed"))
        arrays = files.where("is_array").select("file")
        side0 = s.join(arrays, "file", "left_semi").select(
            "file", "block", F.lit(0).alias("side"), F.lit(0).cast("long").alias("place"), F.lit("").alias("value"),
            "within", "depth", "element")
        none = F.lit(0).cast("long")
        side1 = pieces.withColumn("place", F.monotonically_increasing_id()).join(arrays, "file", "left_semi").select(
            "file", "block", F.lit(1).alias("side"), "place", "value", none.alias("within"), none.alias("depth"),
            none.alias("element"))
        rows = side0.unionByName(side1).repartition("file", "block").sortWithinPartitions("file", "block", "side", "place")
        found = _kept(rows.drop("place").mapInArrow(
            _elements, "file string, element long, block long, fragment string, whole boolean, stray boolean"))
    finally:
        if split_bytes:
            spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    cut = found.where(~F.col("whole")).groupBy("file", "element").agg(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("block", "fragment"))), lambda x: x["fragment"]), "").alias("entry"))
    elements = found.where(F.col("whole") & ~F.col("stray")).select("file", "element", F.col("fragment").alias("entry")) \
        .unionByName(cut)
    stray = found.where("stray").select("file").distinct().withColumn("stray", F.lit(True))
    files = files.join(stray, "file", "left").select(
        "file", "is_array", (F.col("closed") & F.col("stray").isNull()).alias("complete"))
    return elements, files


def _kept(df: DataFrame) -> DataFrame:
    """Written to the session's shared folder and read again: a split's rows depend on the order of its pieces."""
    from ..session import scratch_path

    path = scratch_path(df.sparkSession, f"arrays-{uuid.uuid4().hex[:12]}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
