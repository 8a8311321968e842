"""The lines of a batch as a stream, and files that appear whole."""

from __future__ import annotations

import io
import shutil
import uuid
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
import pyarrow.compute as pc
from pyarrow.fs import FileSystem

REJECTED_ROW = "rejected row in batch"


class Refused(ValueError):
    """A batch holds a row that must not be sent."""


class BatchStream(io.RawIOBase):
    """The lines of one batch, read from the task's Arrow chunks as the target asks for them.

    Nothing is kept but the chunk at hand. A rejected row raises ``Refused``, so
    that the transaction it would be in is rolled back. After ``drain`` all
    rows of the batch are counted in ``rows``, the rejected ones in ``rejected``.
    """

    def __init__(self, batch_id: int, parts: Iterator[pa.RecordBatch]):
        self.batch_id, self.parts = batch_id, parts
        self.rows, self.rejected, self.left = 0, 0, memoryview(b"")

    @property
    def refused(self) -> bool:
        return self.rejected > 0

    def _next(self) -> pa.RecordBatch | None:
        part = next(self.parts, None)
        if part is not None:
            self.rows += len(part)
            self.rejected += pc.sum(part.column(2)).as_py() or 0
        return part

    def readable(self) -> bool:
        return True

    def readinto(self, room) -> int:
        while not self.left:
            part = self._next()
            if self.refused:
                raise Refused(REJECTED_ROW)
            if part is None:
                return 0
            # Lines are joined by Arrow, not one by one.
            lines = part.column(1).cast(pa.large_string())
            whole = pa.ListArray.from_arrays(pa.array([0, len(part)], pa.int32()), lines)
            joined = pc.binary_join(whole, pa.scalar("\n", pa.large_string()))[0].as_buffer()
            self.left = memoryview(joined.to_pybytes() + b"\n")
        n = min(len(room), len(self.left))
        room[:n] = self.left[:n]
        self.left = self.left[n:]
        return n

    def drain(self) -> None:
        while self._next() is not None:
            pass


class FileStream(io.RawIOBase):
    """A staged file as a batch: opened when the target first asks for bytes, read in pieces, unpacked by its name's ending."""

    refused = False

    def __init__(self, batch_id: int, file: str, rows: int):
        self.batch_id, self.file, self.rows, self.source = batch_id, file, rows, None

    def readable(self) -> bool:
        return True

    def readinto(self, room) -> int:
        if self.source is None:
            fs, place = FileSystem.from_uri(self.file)
            self.source = fs.open_input_stream(place, compression="detect")
        data = self.source.read(len(room))
        room[: len(data)] = data
        return len(data)

    def drain(self) -> None:
        """Nothing has to be read for the next file to be found."""

    def close(self) -> None:
        if self.source is not None:
            self.source.close()
        super().close()


def whole_batches(iterator: Iterator[pa.RecordBatch], split: bool = False) -> Iterator[BatchStream]:
    """A stream for each run of equal batch ids; what the caller leaves of one is skipped.

    A batch that comes back after another one is an error, unless batches may be ``split``.
    """
    seen: set[int] = set()
    ahead: list[tuple[int, pa.RecordBatch]] = []
    source = (
        (value, chunk.slice(start, length)) for chunk in iterator for value, length, start in _runs(chunk.column(0))
    )

    def parts(batch_id: int) -> Iterator[pa.RecordBatch]:
        while True:
            found = ahead.pop() if ahead else next(source, None)
            if found is None:
                return
            if found[0] != batch_id:
                ahead.append(found)
                return
            yield found[1]

    while True:
        if not ahead:
            found = next(source, None)
            if found is None:
                return
            ahead.append(found)
        batch_id = ahead[0][0]
        if not split:
            if batch_id in seen:
                raise ValueError(f"batch {batch_id} is not in one piece")
            seen.add(batch_id)
        batch = BatchStream(batch_id, parts(batch_id))
        yield batch
        batch.drain()


def _runs(ids: pa.Array) -> Iterator[tuple[int, int, int]]:
    """``value, length, start`` of the runs in a column."""
    encoded = pc.run_end_encode(ids)
    start = 0
    for value, end in zip(encoded.values.to_pylist(), encoded.run_ends.to_pylist(), strict=True):
        yield value, end - start, start
        start = end


def put_whole(fs: FileSystem, path: str, data: BinaryIO, compression: str | None = None) -> None:
    """Write a file that appears whole or not at all."""
    folder, _, name = path.rpartition("/")
    # Spark does not read files whose names begin like this.
    draft = f"{folder}/.{name}.{uuid.uuid4().hex}"
    try:
        with fs.open_output_stream(draft, compression=compression) as file:
            shutil.copyfileobj(data, file, 1 << 20)
    except Refused:
        fs.delete_file(draft)
        raise
    fs.move(draft, path)
