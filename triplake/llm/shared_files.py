"""Files that tasks write to and read from the cluster's shared folder.

Tasks reach the folder by its URI (local path, ``file:``, ``hdfs:``, ``s3:``,
``s3a:``, ``gs:``) through pyarrow's file systems.  Every task attempt writes
under a fresh name and returns that name as a row; only names of successful
attempts reach the manifest, so a lost executor or a repeated attempt leaves
at most an unlisted file.
"""

from __future__ import annotations

import uuid

import pyarrow as pa
import pyarrow.fs as pafs

SCHEMES = ("file", "hdfs", "viewfs", "s3", "gs", "gcs", "abfs", "abfss")


def open_folder(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a folder URI; the folder is created."""
    uri = "s3" + uri[3:] if uri.startswith("s3a:") else uri
    scheme = uri.split(":", 1)[0] if ":" in uri else "file"
    if scheme not in SCHEMES:
        raise ValueError(f"shared folder {uri}: scheme {scheme} is not one of {', '.join(SCHEMES)}, s3a")
    if scheme == "file":
        path = uri.split(":", 1)[1] if ":" in uri else uri
        path = "/" + path.lstrip("/") if ":" in uri else path
        fs: pafs.FileSystem = pafs.LocalFileSystem()
    else:
        fs, path = pafs.FileSystem.from_uri(uri)
    fs.create_dir(path, recursive=True)
    return fs, path


def new_file(folder: str, suffix: str) -> tuple[pa.NativeFile, str]:
    """An output stream under a fresh name in the folder, and the name."""
    fs, path = open_folder(folder)
    name = f"{uuid.uuid4().hex}{suffix}"
    return fs.open_output_stream(f"{path}/{name}", compression=None), name


def read_file(folder: str, name: str) -> pa.NativeFile:
    """An input stream of a file in the folder, read from its start on."""
    fs, path = open_folder(folder)
    return fs.open_input_stream(f"{path}/{name}", compression=None)
