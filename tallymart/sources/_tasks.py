"""Code that runs inside Python workers. Each function handles one file or one archive member at a
time and streams, so memory use does not depend on file size."""

from __future__ import annotations

import csv
import hashlib
import io
import posixpath
import sys
import uuid
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle

COPY_BYTES = 8 << 20


def open_filesystem(uri: str):
    """(filesystem, path) of a file URI or plain path."""
    from pyarrow import fs

    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[len("file:") :].lstrip("/")
    if "://" not in uri:
        return fs.LocalFileSystem(), uri
    for hadoop_name in ("s3a://", "s3n://"):
        if uri.startswith(hadoop_name):
            uri = "s3://" + uri[len(hadoop_name) :]
    return fs.FileSystem.from_uri(uri)


def copy_whole(source, filesystem, final: str) -> int:
    """Copy a stream to ``final`` and return its size.

    The file is written under a hidden name, which Spark's readers skip, and renamed when whole. A
    lost or repeated task therefore leaves either nothing visible or the same file again.
    """
    from pyarrow import fs

    folder, name = posixpath.split(final)
    partial = posixpath.join(folder, f".{name}.{uuid.uuid4().hex}")
    filesystem.create_dir(folder, recursive=True)
    size = 0
    with filesystem.open_output_stream(partial) as sink:
        while block := source.read(COPY_BYTES):
            sink.write(block)
            size += len(block)
    try:
        filesystem.move(partial, final)
    except OSError:
        # Some file systems refuse to replace a file; then another attempt has finished this one.
        if filesystem.get_file_info(final).type != fs.FileType.File:
            raise
        filesystem.delete_file(partial)
    return size


def staged_name(member: str) -> str:
    """Where a member goes below its archive's folder. Spark skips names that start with ``_`` or
    ``.``, so folders get a letter in front; a file name is lineage and stays as it is."""
    parts = [p for p in member.split("/") if p not in ("", ".", "..")]
    if parts[-1].startswith("_"):
        raise ValueError(f"Spark does not read files whose name starts with '_': {member}")
    folders = ["d" + p if p[0] in "._" else p for p in parts[:-1]]
    return posixpath.join(*folders, parts[-1])


def header_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """First CSV record of each file; nothing after it is read."""
    for batch in batches:
        headers = []
        for path in batch["path"]:
            filesystem, local = open_filesystem(path)
            with filesystem.open_input_stream(local) as raw:
                text = io.TextIOWrapper(raw, encoding="utf-8-sig", newline="")
                headers.append(next(csv.reader(text), []))
        yield pd.DataFrame({"path": batch["path"], "header": headers})


def member_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Entries of each archive's central directory; no member is decompressed."""
    for batch in batches:
        for path in batch["path"]:
            filesystem, local = open_filesystem(path)
            with filesystem.open_input_file(local) as raw, zipfile.ZipFile(raw) as archive:
                infos = archive.infolist()
            yield pd.DataFrame(
                {
                    "path": [path] * len(infos),
                    "position": range(len(infos)),
                    "source_zip": [posixpath.basename(path)] * len(infos),
                    "file_name": [i.filename for i in infos],
                    "file_size": [i.file_size for i in infos],
                }
            )


def unpack_rows(target: str):
    """A task that copies archive members to ``target/<archive>/<position>/<member>``; an archive is opened
    once for all its members in a batch."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out, root = open_filesystem(target)
        for batch in batches:
            written = {}
            for path, members in batch.groupby("path", sort=False):
                folder = posixpath.join(root, f"{hashlib.sha256(path.encode()).hexdigest()[:32]}-{posixpath.basename(path)}")
                filesystem, local = open_filesystem(path)
                with filesystem.open_input_file(local) as raw, zipfile.ZipFile(raw) as archive:
                    infos = archive.infolist()
                    for at, position in members["position"].items():
                        with archive.open(infos[position]) as member:
                            final = posixpath.join(folder, str(position), staged_name(infos[position].filename))
                            written[at] = copy_whole(member, out, final)
            yield batch.assign(file_size=pd.Series(written, dtype="int64"))

    return run


# Workers need not have this package installed: its functions travel with the task.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
