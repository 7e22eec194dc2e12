"""Files in the shared folder, written from tasks under temporary names and moved to their final, deterministic names."""

from __future__ import annotations

import hashlib
import uuid

from pyarrow import fs

BLOCK = 1 << 20


def resolve(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder, as Arrow opens them (``file:``, ``hdfs:``, object stores, or a plain path)."""
    if uri.startswith("file:") and not uri.startswith("file://"):
        uri = uri.removeprefix("file:")
    return fs.FileSystem.from_uri(uri)


class Committed:
    """A file that appears under its name only when complete. A repeated task writes the same bytes to the same name."""

    def __init__(self, folder: str, name: str):
        self.fs, root = resolve(folder)
        self.path, self.name = f"{root}/{name}", name
        self.fs.create_dir(f"{root}/uncommitted", recursive=True)
        self.temporary = f"{root}/uncommitted/{name}.{uuid.uuid4().hex}"
        self.out = self.fs.open_output_stream(self.temporary, compression=None)
        self.size, self.digest = 0, hashlib.sha1()

    def write(self, data: bytes) -> None:
        self.out.write(data)
        self.size += len(data)
        self.digest.update(data)

    def commit(self) -> None:
        """Give the file its name, unless another attempt of the task has done so with the same bytes.

        A complete file is never taken away: one of the same size and digest stays and the temporary one goes, so an attempt
        that ends late, or dies on the way, does no harm. Only what differs, left by an earlier run, is replaced.
        """
        self.out.close()
        if self.fs.get_file_info(self.path).type != fs.FileType.NotFound:
            if self._same():
                self.fs.delete_file(self.temporary)
                return
            self.fs.delete_file(self.path)  # not every file system replaces
        self.fs.move(self.temporary, self.path)

    def _same(self) -> bool:
        if self.fs.get_file_info(self.path).size != self.size:
            return False
        digest = hashlib.sha1()
        with self.fs.open_input_stream(self.path, compression=None) as stream:
            while data := stream.read(BLOCK):
                digest.update(data)
        return digest.digest() == self.digest.digest()


def reader(folder: str, name: str):
    """A sequential stream over a committed file."""
    system, root = resolve(folder)
    return system.open_input_stream(f"{root}/{name}", compression=None)
