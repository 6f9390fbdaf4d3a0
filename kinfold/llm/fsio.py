"""Files that executors write to and read from the shared folder, through pyarrow's file systems."""

from __future__ import annotations

from pyarrow import fs
from pyspark import TaskContext


def located(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith(("/", "file:")) else (fs.LocalFileSystem(), uri)


class Published:
    """An output stream that appears under its name only once it is complete.

    Each task attempt writes a file of its own and moves it into place, so an
    attempt that is lost, repeated or run twice leaves whole files only.
    """

    def __init__(self, uri: str):
        self.fs, self.path = located(uri)
        self.fs.create_dir(self.path.rpartition("/")[0], recursive=True)
        context = TaskContext.get()
        self.temp = f"{self.path}.attempt-{context.taskAttemptId() if context else 0}"
        self.out = self.fs.open_output_stream(self.temp, compression=None)
        self.at = 0

    def write(self, data: bytes) -> int:
        """Write and return the offset at which the data starts."""
        start, self.at = self.at, self.at + len(data)
        self.out.write(data)
        return start

    def close(self) -> None:
        self.out.close()
        self.fs.move(self.temp, self.path)

    def abandon(self) -> None:
        self.out.close()
        self.fs.delete_file(self.temp)


def chunks(uri: str, size: int = 1 << 20):
    """The file's bytes in pieces."""
    at, path = located(uri)
    with at.open_input_stream(path, compression=None) as f:
        while data := f.read(size):
            yield data


def read_range(uri: str, offset: int, length: int) -> bytes:
    at, path = located(uri)
    with at.open_input_file(path) as f:
        f.seek(offset)
        return f.read(length)
