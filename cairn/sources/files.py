"""Sizes, digests and chosen texts of the files below a folder, read once.

One task lists the root, other tasks the folders below it, and the listing is spread over tasks that read the bytes of
each file once, in pieces, so a file of any size is one small row.  No listing and no file goes through the driver.
"""

import hashlib
import re
from collections.abc import Iterable, Iterator, Mapping
from fnmatch import fnmatchcase

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.session import stored

PIECE = 8 << 20  # bytes read at once
TASK_BYTES = 256 << 20  # tasks take files of about so many bytes, or so many files, on average
TASK_FILES = 1000
ROWS = 4096  # of a batch, or about a piece of bytes
LISTED = "path string, bytes bigint"
SCHEMA = "path string, bytes bigint, content_checksum string, md5 string, ord bigint, content binary"


def _opened(root: str):
    """The file system of a folder, and its path there."""
    from pyarrow.fs import FileSystem

    fs, base = FileSystem.from_uri(re.sub(r"^file:/+", "/", root))
    return fs, base.rstrip("/")


def _arrow(rows: Iterable[tuple], schema) -> Iterator:
    """Rows as Arrow batches, cut by rows and bytes."""
    import pyarrow as pa

    batch, size = [], 0
    cut = lambda: pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*batch), schema, strict=True)], schema=schema)
    for row in rows:
        batch.append(row)
        size += sum(len(v) for v in row if isinstance(v, bytes))
        if len(batch) >= ROWS or size >= PIECE:
            yield cut()
            batch, size = [], 0
    if batch:
        yield cut()


class Lines:
    """Cuts pieces of bytes into lines, which end with LF, CR or both."""

    def __init__(self):
        self.rest = b""

    def feed(self, piece: bytes) -> list[bytes]:
        data = self.rest + piece
        held = data[-1:] if data.endswith(b"\r") else b""  # a line feed may follow in the next piece
        lines = data[: len(data) - len(held)].replace(b"\r\n", b"\n").replace(b"\r", b"\n").split(b"\n")
        self.rest = lines.pop() + held
        return lines

    def close(self) -> list[bytes]:
        return [self.rest.removesuffix(b"\r")] if self.rest else []


class Elements:
    """Cuts pieces of bytes into the outermost XML elements of a name; comments and CDATA are no markup."""

    def __init__(self, name: str):
        n = re.escape(name.encode())
        tag = rb"""(?=[\s/>])(?:[^>"']|"[^"]*"|'[^']*')*>"""
        self.token = re.compile(rb"(?P<skip><!--|<!\[CDATA\[)|(?P<open><" + n + tag + rb")|</" + n + rb"\s*>")
        self.data, self.at, self.until = bytearray(), 0, None
        self.begin, self.depth = 0, 0

    def feed(self, piece: bytes) -> list[bytes]:
        self.data += piece
        data, out = self.data, []
        while True:
            if self.until:
                end = data.find(self.until, self.at)
                if end < 0:
                    self.at = max(self.at, len(data) - 2)
                    break
                self.at, self.until = end + 3, None
                continue
            m = self.token.search(data, self.at)
            if m is None:  # a token may begin at the end
                begun = data.rfind(b"<", self.at)
                self.at = len(data) if begun < 0 else begun
                break
            self.at, text = m.end(), m.group()
            if m["skip"]:
                self.until = b"-->" if text == b"<!--" else b"]]>"
            elif m["open"]:
                if not text.endswith(b"/>"):
                    self.begin = self.begin if self.depth else m.start()
                    self.depth += 1
            elif self.depth:
                self.depth -= 1
                if not self.depth:
                    out.append(bytes(data[self.begin : self.at]))
        done = self.begin if self.depth else self.at
        del data[:done]
        self.at, self.begin = self.at - done, 0
        return out

    def close(self) -> list[bytes]:
        return []


def _listed(fs, folder: str, recursive: bool) -> list:
    from pyarrow.fs import FileSelector

    return fs.get_file_info(FileSelector(folder, recursive=recursive))


def list_files(spark: SparkSession, root: str) -> DataFrame:
    """``path`` and ``bytes`` of every file below ``root``, a folder or one file, on any file system that Arrow opens.

    One task lists the root's own entries, many tasks the folders among them.
    """
    from pyarrow.fs import FileType

    fs, base = _opened(root)
    if fs.get_file_info(base).type == FileType.NotFound:
        raise FileNotFoundError(root)

    def arrow(rows):
        import pyarrow as pa

        return _arrow(rows, pa.schema([("path", pa.string()), ("bytes", pa.int64())]))

    def top(batches):
        fs, base = _opened(root)
        for _ in batches:
            info = fs.get_file_info(base)
            found = [info] if info.type == FileType.File else _listed(fs, base, False)
            yield from arrow((f.path, f.size if f.type == FileType.File else None) for f in found)

    def below(batches):
        fs, _ = _opened(root)
        for b in batches:
            for folder in b["path"].to_pylist():
                yield from arrow((f.path, f.size) for f in _listed(fs, folder, True) if f.type == FileType.File)

    entries = stored(spark.range(0, 1, 1, 1).mapInArrow(top, LISTED))
    folders = entries.filter("bytes is null")
    tasks = folders.count() // TASK_FILES + spark.sparkContext.defaultParallelism
    return entries.filter("bytes is not null").unionByName(folders.repartition(tasks, "path").mapInArrow(below, LISTED))


def read_files(spark: SparkSession, root: str, texts: Mapping[str, str | None] | None = None) -> DataFrame:
    """Each file below ``root`` read once: a row of ``path``, ``bytes``, ``content_checksum`` (SHA-256) and ``md5``.

    ``texts`` names, by pattern of the file name, the files of which the content comes too, in further rows of
    ``path, ord, content``: their lines, or the elements of the given XML name.  ``ord`` is NULL in the row of the file.
    """
    listed = stored(list_files(spark, root))
    whole = listed.agg(F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("bytes")).first()
    tasks = 1 + max(whole["n"] // TASK_FILES, (whole["bytes"] or 0) // TASK_BYTES)
    texts = dict(texts or {})

    def rows(fs, base, path):
        name = path.rsplit("/", 1)[1]
        shown = name if path == base else path[len(base) + 1 :]
        cut = next(([Lines() if tag is None else Elements(tag)] for p, tag in texts.items() if fnmatchcase(name, p)), [])
        sha, md5, n, at = hashlib.sha256(), hashlib.md5(), 0, 0
        with fs.open_input_stream(path) as stream:
            while True:
                piece = stream.read(PIECE)
                sha.update(piece)
                md5.update(piece)
                n += len(piece)
                for c in cut:
                    for content in c.feed(piece) if piece else c.close():
                        yield shown, None, None, None, at, content
                        at += 1
                if not piece:
                    break
        yield shown, n, sha.hexdigest(), md5.hexdigest(), None, None

    def read(batches):
        import pyarrow as pa

        fs, base = _opened(root)
        schema = pa.schema([
            ("path", pa.string()), ("bytes", pa.int64()), ("content_checksum", pa.string()), ("md5", pa.string()),
            ("ord", pa.int64()), ("content", pa.binary()),
        ])
        for b in batches:
            yield from _arrow((row for path in b["path"].to_pylist() for row in rows(fs, base, path)), schema)

    return listed.repartition(tasks, "path").mapInArrow(read, SCHEMA)


def file_digests(spark: SparkSession, root: str) -> DataFrame:
    """``path`` (below ``root``), ``bytes``, ``content_checksum`` (SHA-256) and ``md5`` of every file."""
    return read_files(spark, root).drop("ord", "content")


def write_files(files: DataFrame, root: str) -> None:
    """Write each row's ``content`` to its ``path`` below ``root``; a repeated task writes the same bytes again."""

    def write(batches):
        import pyarrow as pa

        fs, base = _opened(root)
        n = 0
        for b in batches:
            made = set()
            for path, content in zip(b["path"].to_pylist(), b["content"].to_pylist(), strict=True):
                target = f"{base}/{path}"
                folder = target.rsplit("/", 1)[0]
                if folder not in made:
                    fs.create_dir(folder, recursive=True)
                    made.add(folder)
                with fs.open_output_stream(target) as out:
                    out.write(content)
                n += 1
        yield pa.RecordBatch.from_pydict({"n": [n]}, schema=pa.schema([("n", pa.int64())]))

    files.selectExpr("path", "cast(content as binary) as content").mapInArrow(write, "n bigint").agg({"n": "sum"}).collect()
