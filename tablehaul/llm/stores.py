"""Files in the shared folder, as tasks open them.

Spark names stores by Hadoop's schemes, the readers and writers of ``pyarrow.fs`` by their own.
"""

from __future__ import annotations

import pyarrow.fs as pafs

# Hadoop's schemes and what pyarrow calls the same store. ``hdfs`` and ``viewfs``
# need Hadoop's native client library on the executors.
SCHEMES = {
    "file": "file", "s3": "s3", "s3a": "s3", "s3n": "s3", "gs": "gs", "hdfs": "hdfs",
    "viewfs": "viewfs", "abfs": "abfs", "abfss": "abfss",
}


def arrow_uri(folder: str) -> str:
    """The address of a Hadoop folder for ``pyarrow.fs``; a plain path is local."""
    scheme, colon, rest = folder.partition(":")
    if not colon or "/" in scheme:
        scheme, rest = "file", folder
    if scheme not in SCHEMES:
        raise ValueError(f"{scheme}: is none of the stores {', '.join(SCHEMES)}")
    if not rest.startswith("//"):
        rest = f"//{rest}"
    return f"{SCHEMES[scheme]}:{rest}"


def opened(folder: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a folder and the folder's path in it."""
    store, path = pafs.FileSystem.from_uri(arrow_uri(folder))
    return store, path.rstrip("/")
