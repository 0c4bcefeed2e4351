"""Binary files in the shared folder, written and read by tasks; any file system pyarrow knows."""

from __future__ import annotations

from pyarrow import fs
from pyspark import TaskContext


def opened(uri: str) -> tuple[fs.FileSystem, str]:
    system, path = fs.FileSystem.from_uri(uri)
    return system, path


class TaskFile:
    """A file that appears under its name only when it is whole.

    Every attempt of a task writes to a name of its own and moves the file at the end, so that a
    repeated or speculative attempt replaces it with the same bytes.
    """

    def __init__(self, uri: str):
        self.fs, self.path = opened(uri)
        context = TaskContext.get()
        self.draft = f"{self.path}.draft-{context.taskAttemptId() if context else 0}"
        self.fs.create_dir(self.path.rsplit("/", 1)[0], recursive=True)
        self.stream = self.fs.open_output_stream(self.draft)

    def write(self, data) -> int:
        self.stream.write(data)
        return memoryview(data).nbytes

    def commit(self) -> None:
        self.stream.close()
        self.fs.move(self.draft, self.path)
