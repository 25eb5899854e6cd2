"""Binary files in the shared folder, written and read by tasks through Arrow's file systems."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

import pyarrow.fs as pafs


@contextmanager
def new_file(folder: str, stem: str, suffix: str):
    """(path, stream) of a new file; a task that runs again writes another file, and only the one that its task returns is read."""
    system, path = pafs.FileSystem.from_uri(folder)
    system.create_dir(path, recursive=True)
    name = f"{stem}-{uuid.uuid4().hex}{suffix}"
    with system.open_output_stream(f"{path}/{name}", compression=None) as stream:
        yield f"{folder}/{name}", stream


def open_stream(uri: str):
    system, path = pafs.FileSystem.from_uri(uri)
    return system.open_input_stream(path, compression=None)


def open_random(uri: str):
    system, path = pafs.FileSystem.from_uri(uri)
    return system.open_input_file(path)
