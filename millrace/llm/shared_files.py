"""Binary files that tasks write to and read from the shared folder."""

from __future__ import annotations

import uuid

from pyspark import TaskContext


def file_system(place: str):
    """The file system of a folder or file, and the path within it."""
    from pyarrow.fs import FileSystem, LocalFileSystem

    if place.startswith("file:") or "://" not in place:
        return LocalFileSystem(), "/" + place.removeprefix("file:").lstrip("/")
    return FileSystem.from_uri(place)


def attempt_name(label: str, ending: str) -> str:
    """A name that sorts by partition and that no other attempt of the task uses."""
    context = TaskContext.get()
    return f"{label}-{context.partitionId() if context else 0:08d}-{uuid.uuid4().hex}.{ending}"
