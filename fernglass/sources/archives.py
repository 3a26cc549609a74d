"""Members of zip and tar archives, read as streams: a zip's directory alone where that is enough, members one by one else."""

from __future__ import annotations

import hashlib
import tarfile
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fernglass.sources.files import tree

#: Bytes of a member that are held at a time.
PIECE = 1 << 20
ROWS = "path string, member string, bytes long, sha256 string, content binary"


def _opened(path: str):
    """A seekable file of any file system that Arrow knows."""
    from pyarrow import fs

    system, at = fs.FileSystem.from_uri(path if "://" in path or path.startswith("/") else path.replace("file:", "file://", 1))
    return system.open_input_file(at)


def _hashed(stream) -> str:
    digest = hashlib.sha256()
    while piece := stream.read(PIECE):
        digest.update(piece)
    return digest.hexdigest()


def _of_zip(file, skip: frozenset, digest: bool, most: int) -> Iterator[tuple]:
    with zipfile.ZipFile(file) as z:
        for i in z.infolist():
            if not i.is_dir() and i.filename not in skip:
                sha = _hashed(z.open(i)) if digest else None
                yield i.filename, i.file_size, sha, z.read(i) if 0 <= i.file_size <= most else None


def _of_tar(file, skip: frozenset, digest: bool, most: int) -> Iterator[tuple]:
    with tarfile.open(fileobj=file, mode="r|*") as t:  # from front to end, without seeking
        for i in t:
            if i.isfile() and i.name not in skip:
                content = t.extractfile(i).read() if i.size <= most else None
                sha = None
                if digest:
                    sha = hashlib.sha256(content).hexdigest() if content is not None else _hashed(t.extractfile(i))
                yield i.name, i.size, sha, content


def members(spark: SparkSession, root: str, pattern: str = "*.zip", digest: bool = False, content_to: int = -1, done: DataFrame | None = None) -> DataFrame:
    """path, member, bytes, and on demand sha256 and content (of members of up to content_to bytes): a row for each file inside.

    Names and sizes of a zip come from its directory, and members are hashed in pieces, so that no archive is ever held
    whole. done (path, member) are members that an earlier run has taken: they are neither opened nor returned. Archives
    that can't be read give a row without a member, after those that could.
    """
    found = tree(spark, root, pattern).select("path")
    if done is not None:
        taken = done.groupBy("path").agg(F.collect_set("member").alias("done"))  # of one archive: as many as it has members
        found = found.join(taken, "path", "left")
    else:
        found = found.withColumn("done", F.lit(None).cast("array<string>"))

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for path, skip in zip(pdf["path"], pdf["done"]):
                held: list[tuple] = []
                kept = 0
                try:
                    with _opened(path) as file:
                        start = file.read(4)
                        file.seek(0)
                        walk = _of_zip if start[:2] == b"PK" else _of_tar
                        for member in walk(file, frozenset(() if skip is None else skip), digest, content_to):
                            held.append((path, *member))
                            kept += len(member[3] or b"")
                            if len(held) >= 1000 or kept > 16 * PIECE:
                                yield pd.DataFrame(held, columns=["path", "member", "bytes", "sha256", "content"])
                                held, kept = [], 0
                except (zipfile.BadZipFile, tarfile.TarError, EOFError, OSError, RuntimeError, ValueError):
                    held.append((path, None, None, None, None))
                yield pd.DataFrame(held, columns=["path", "member", "bytes", "sha256", "content"]).astype({"bytes": "Int64"})

    out = found.mapInPandas(read, ROWS)
    return out.select("path", "member", "bytes", *(["sha256"] if digest else []), *(["content"] if content_to >= 0 else []))
