"""Arrays in the shared scratch folder: written by tasks, memory-mapped or read by workers."""

from __future__ import annotations

import io
import os
import uuid
from urllib.parse import urlparse

import numpy as np


def _local(path: str) -> str | None:
    parsed = urlparse(path)
    return parsed.path if parsed.scheme in ("", "file") else None


def write_array(path: str, values: np.ndarray) -> None:
    """Write one .npy file under its final name only when it is whole.

    A task that runs twice writes the same content, so whichever attempt
    comes last changes nothing.
    """
    attempt = f"{path}.{uuid.uuid4().hex}"
    local = _local(path)
    if local is not None:
        attempt = _local(attempt)
        os.makedirs(os.path.dirname(local), exist_ok=True)
        with open(attempt, "wb") as file:
            np.save(file, values)
        os.replace(attempt, local)
        return
    from pyarrow import fs

    system, place = fs.FileSystem.from_uri(path)
    attempt = fs.FileSystem.from_uri(attempt)[1]
    system.create_dir(os.path.dirname(place), recursive=True)
    with system.open_output_stream(attempt) as file:
        np.save(file, values)
    system.move(attempt, place)


def map_array(path: str) -> np.ndarray:
    """A written array, memory-mapped where its folder is mounted.

    From any other store it is read into memory; callers bound what they keep.
    """
    local = _local(path)
    if local is not None:
        return np.load(local, mmap_mode="r")
    from pyarrow import fs

    system, place = fs.FileSystem.from_uri(path)
    with system.open_input_stream(place) as file:
        return np.load(io.BytesIO(file.read()))
