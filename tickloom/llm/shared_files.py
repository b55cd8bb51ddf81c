"""Binary files that tasks write to and read from the shared folder."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyarrow import fs


def _located(path: str):
    return fs.FileSystem.from_uri(path)


@contextmanager
def writing(folder: str, stem: str, suffix: str):
    """(path, stream) of a new file.  The name is unique, so a task that runs again never meets the file of an
    attempt that was lost; readers only take paths from rows of tasks that succeeded."""
    path = f"{folder.rstrip('/')}/{stem}-{uuid.uuid4().hex}{suffix}"
    system, place = _located(path)
    system.create_dir(place.rsplit("/", 1)[0], recursive=True)
    with system.open_output_stream(place, compression=None) as stream:
        yield path, stream


def reading(path: str):
    system, place = _located(path)
    return system.open_input_file(place)
