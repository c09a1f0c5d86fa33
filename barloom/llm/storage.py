"""Random access to files in the shared folder, from the driver and from tasks.

Spark writes and reads tables. Container formats of their own (archives, record files) need byte
ranges, which pyarrow's file systems give for local paths, HDFS and object stores alike.
"""

from __future__ import annotations

import ctypes
import re
import sys
import types

import pyarrow
from pyarrow import fs

#: The C library's name for the size from which arrays are mapped on their own.
_MMAP_THRESHOLD = -3


def open_store(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a URI and the path in it; ``file:/x`` and plain paths are local."""
    local = re.match(r"(?:file:/*(?=/))?(/.*)", uri)
    if local:
        return fs.LocalFileSystem(), local[1]
    return fs.FileSystem.from_uri(uri)


def write_once(uri: str, name: str, write) -> None:
    """Calls ``write(stream)`` on a new file below ``uri``; a file of that name appears whole.

    Callers choose a name of their own for every task attempt and pass on only the names of
    attempts that Spark committed, so files of lost attempts are never read.
    """
    store, path = open_store(uri)
    store.create_dir(path, recursive=True)
    with store.open_output_stream(f"{path}/.{name}.tmp") as out:
        write(out)
    store.move(f"{path}/.{name}.tmp", f"{path}/{name}")


def worker_state(name: str) -> dict:
    """A dictionary that lives as long as the Python worker, for tables worth keeping across tasks."""
    holder = sys.modules.setdefault("_worker_state", types.ModuleType("_worker_state"))
    return holder.__dict__.setdefault(name, {})


def return_memory() -> None:
    """From now on this worker's large arrays go back to the system when they are freed.

    By default the C library keeps freed arrays of growing sizes for later, and a worker that handles
    many groups grows far beyond what any of them needs. Where the library has no such switch,
    nothing changes.
    """
    state = worker_state("memory")
    if not state:
        state["done"] = True
        try:
            ctypes.CDLL(None).mallopt(_MMAP_THRESHOLD, 1 << 18)
        except (OSError, AttributeError):
            pass
    pyarrow.default_memory_pool().release_unused()
