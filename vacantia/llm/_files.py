"""Files that tasks write and read by URI in the folder that all executors share.

pyarrow's file systems cover file, hdfs, s3 and gs URIs on the executors, where there is no JVM to ask.
"""

from __future__ import annotations

from pyarrow import fs


def _at(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def make_dir(uri: str) -> None:
    system, path = _at(uri)
    system.create_dir(path, recursive=True)


def create(uri: str):
    """A stream that writes a new file."""
    system, path = _at(uri)
    system.create_dir(path.rsplit("/", 1)[0], recursive=True)
    return system.open_output_stream(path, compression=None)


def open_input(uri: str):
    """A file for range reads."""
    system, path = _at(uri)
    return system.open_input_file(path)


def remove(uri: str) -> None:
    """Removes a file, if it is still there."""
    system, path = _at(uri)
    if system.get_file_info(path).type != fs.FileType.NotFound:
        system.delete_file(path)
