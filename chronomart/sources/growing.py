"""Lines of files that grow, as a stream or a batch.

A capture process appends to one file per table and day. Spark's file source reads a
file once, so what is appended later is lost to it. This source keeps how far each file
was read: its offset is a map of path to bytes, so a restart goes on where the last
committed batch ended, and a repeated batch reads the very same bytes.

A line counts once its newline is there; a half-written last line waits. Long stretches
are cut into pieces of bounded size, read by tasks of their own: a line belongs to the
piece that its first byte is in. Folders are read by ``pyarrow.fs``, so a path may name
any store that it knows.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

#: Bytes of a file that one task reads.
PIECE = 64 << 20
#: Bytes that are asked for at once.
BLOCK = 1 << 20
#: Lines of a record batch.
LINES = 10_000


class Piece(InputPartition):
    def __init__(self, path: str, start: int, stop: int, first: int) -> None:
        """Lines of ``path`` that start in [start, stop); the stretch begins at ``first``, which starts a line."""
        super().__init__((path, start, stop, first))
        self.path, self.start, self.stop, self.first = path, start, stop, first


def _opened(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


def files_below(path: str, suffixes: list[str]) -> dict[str, int]:
    """Path and size of the files below a folder, hidden ones left out; none when there is no folder."""
    from pyarrow import fs

    store, base = _opened(path)
    found = store.get_file_info(fs.FileSelector(base, recursive=True, allow_not_found=True))
    wanted = (f for f in found if f.is_file and f.base_name[0] not in "_." and f.base_name.endswith(tuple(suffixes)))
    return {f.path: f.size for f in wanted}


def last_line_end(path: str, name: str, size: int) -> int:
    """Bytes of ``name`` up to its last newline."""
    store, _ = _opened(path)
    with store.open_input_file(name) as file:
        end = size
        while end > 0:
            start = max(0, end - BLOCK)
            at = file.read_at(end - start, start).rfind(b"\n")
            if at >= 0:
                return start + at + 1
            end = start
    return 0


def pieces(begins: dict[str, int], ends: dict[str, int], piece: int) -> list[Piece]:
    out = []
    for name, end in sorted(ends.items()):
        begin = begins.get(name, 0)
        if end < begin:
            raise ValueError(f"{name} has shrunk below what was read of it")
        out += [Piece(name, at, min(at + piece, end), begin) for at in range(begin, end, piece)]
    return out


def lines_of(path: str, piece: Piece) -> Iterator[tuple[int, bytes]]:
    """(position, line) of a piece. A line that begins before it is skipped, one that ends after it is read to its end."""
    store, _ = _opened(path)
    with store.open_input_file(piece.path) as file:
        # From one byte earlier: a newline there means that the piece begins a line.
        position = at = piece.start - (piece.start > piece.first)
        skip = position < piece.start
        open_line: list[bytes] = []
        while position < piece.stop:
            block = file.read_at(BLOCK, at)
            if not block:
                return
            at += len(block)
            first, *others = block.split(b"\n")
            open_line.append(first)
            if not others:
                continue
            for line in [b"".join(open_line), *others[:-1]]:
                if not skip:
                    yield position, line
                skip = False
                position += len(line) + 1
                if position >= piece.stop:
                    return
            open_line = [others[-1]]


def _batches(path: str, piece: Piece):
    import pyarrow as pa

    def batch(values: list[bytes], places: list[int]):
        text = pa.array([v.decode("utf-8", "replace").removesuffix("\r") for v in values], pa.string())
        return pa.RecordBatch.from_arrays([text, pa.array([piece.path] * len(values), pa.string()), pa.array(places, pa.int64())], ["value", "path", "position"])

    values: list[bytes] = []
    places: list[int] = []
    for position, line in lines_of(path, piece):
        values.append(line)
        places.append(position)
        if len(values) == LINES:
            yield batch(values, places)
            values, places = [], []
    if values:
        yield batch(values, places)


class _Lines:
    def __init__(self, options: dict) -> None:
        self.path = options["path"]
        self.suffixes = options.get("suffixes", ".json,.jsonl").split(",")
        self.piece = int(options.get("pieceBytes", PIECE))
        self.known: dict[str, tuple[int, int]] = {}

    def ends(self) -> dict[str, int]:
        """How far each file can be read; only files that grew are opened."""
        for name, size in files_below(self.path, self.suffixes).items():
            if self.known.get(name, (-1, 0))[0] != size:
                self.known[name] = (size, last_line_end(self.path, name, size))
        return {name: end for name, (_, end) in self.known.items()}

    def read(self, partition: Piece):
        return _batches(self.path, partition)


class GrowingStream(_Lines, DataSourceStreamReader):
    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        return self.ends()

    def partitions(self, start: dict, end: dict) -> list[Piece]:
        return pieces(start, end, self.piece)


class GrowingBatch(_Lines, DataSourceReader):
    def partitions(self) -> list[Piece]:
        return pieces({}, self.ends(), self.piece)


class GrowingLines(DataSource):
    """Format ``growing_lines``. Options: path, suffixes (comma list), pieceBytes."""

    @classmethod
    def name(cls) -> str:
        return "growing_lines"

    def schema(self) -> str:
        return "value string, path string, position bigint"

    def reader(self, schema: StructType) -> GrowingBatch:
        return GrowingBatch(dict(self.options))

    def streamReader(self, schema: StructType) -> GrowingStream:
        return GrowingStream(dict(self.options))


def read_growing(spark: SparkSession, path: str, stream: bool = True, **options: str) -> DataFrame:
    """Complete lines of the files below ``path``: value, path, position (of the line's first byte in its file)."""
    spark.dataSource.register(GrowingLines)
    reader = spark.readStream if stream else spark.read
    return reader.format("growing_lines").options(path=path, **options).load()
