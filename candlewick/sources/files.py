"""Files below a root on any file system that ``pyarrow.fs`` knows: a local path, or a URI of HDFS or an object store."""

from __future__ import annotations

import hashlib

from pyarrow.fs import FileSelector, FileSystem, FileType, LocalFileSystem


class Folder:
    """Paths given and returned begin with ``root`` as it was given, so Spark reads them as they are."""

    def __init__(self, root: str):
        self.root = root.rstrip("/") or "/"
        self.fs, base = FileSystem.from_uri(root) if "://" in root else (LocalFileSystem(), root)
        self._base = base.rstrip("/") or "/"

    def join(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), *parts])

    def relative(self, path: str) -> str:
        """The part below the root; of a path elsewhere, all of it."""
        head = self.root.rstrip("/") + "/"
        return path[len(head) :] if path.startswith(head) else path

    def at(self, path: str) -> str:
        """The path as ``fs`` takes it. One that is absolute stays."""
        name = self.relative(path)
        return name if name.startswith("/") else f"{self._base.rstrip('/')}/{name}"

    def list(self, path: str, recursive: bool = True) -> list[str]:
        """Files below ``path``, in order; none if it isn't there."""
        top = self.at(path).rstrip("/")
        found = self.fs.get_file_info(FileSelector(top, recursive=recursive, allow_not_found=True))
        return sorted(path.rstrip("/") + f.path[f.path.index(top) + len(top) :] for f in found if f.type == FileType.File)

    def exists(self, path: str) -> bool:
        return self.fs.get_file_info(self.at(path)).type == FileType.File

    def move(self, path: str, to: str) -> None:
        """One rename within the file system, replacing what is there; an object store copies."""
        self.fs.create_dir(self.at(to).rsplit("/", 1)[0], recursive=True)
        self.fs.move(self.at(path), self.at(to))

    def remove(self, path: str) -> None:
        self.fs.delete_file(self.at(path))

    def remove_tree(self, path: str) -> None:
        self.fs.delete_dir(self.at(path))

    def digest(self, path: str) -> tuple[int, str]:
        """Size and SHA-256, read in blocks."""
        size, sha = 0, hashlib.sha256()
        with self.fs.open_input_stream(self.at(path)) as f:
            while block := f.read(1 << 20):
                size += len(block)
                sha.update(block)
        return size, sha.hexdigest()
