"""Archive expansion: one archive in, one row per entry out.

The containers are opened by the standard library inside each task.  Bytes are
read only while the archive is within its caps; the rules themselves are
Column expressions in ``operators.archive``.
"""

from __future__ import annotations

import contextlib
import io
import tarfile
import zipfile
from collections.abc import Iterator
from typing import BinaryIO

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.functions import udtf

from docloom.limits import Limits
from docloom.operators.archive import (
    DIRECTORY, EMPTY, FILE, HARDLINK, SPECIAL, SYMLINK, UNREADABLE,
)
from docloom.operators.outcomes import INPUT_REJECTED, PARSE_FAILED
from docloom.sources import tree

ENTRY_FIELDS = (
    "container string, ordinal bigint, name string, kind string, declared_size bigint, "
    "content binary, error_code string, error string"
)
ENTRY_COLUMNS = [f.split()[0] for f in ENTRY_FIELDS.split(", ")]
ARROW_TYPES = {"string": pa.string(), "bigint": pa.int64(), "binary": pa.binary()}
ENTRY_TYPES = [ARROW_TYPES[f.split()[1]] for f in ENTRY_FIELDS.split(", ")]
FLUSH_BYTES = 4 * 1024 * 1024
FLUSH_ROWS = 1000
UNIX_LINK = 0o120000


class TooLarge(Exception):
    """An entry expands past the ceiling."""


def _zip_kind(info: zipfile.ZipInfo) -> str:
    if info.is_dir():
        return DIRECTORY
    return SYMLINK if (info.external_attr >> 16) & 0o170000 == UNIX_LINK else FILE


def _tar_kind(info: tarfile.TarInfo) -> str:
    if info.isdir():
        return DIRECTORY
    if info.issym() or info.islnk():
        return SYMLINK if info.issym() else HARDLINK
    return FILE if info.isfile() else SPECIAL


def _bounded(source, ceiling: int) -> bytes:
    with source:
        data = source.read(ceiling + 1)
    if len(data) > ceiling:
        raise TooLarge("an entry is longer than it says")
    return data


def _failed(exc: Exception) -> tuple[str, str]:
    if isinstance(exc, TooLarge):
        return INPUT_REJECTED, str(exc)
    return PARSE_FAILED, f"{type(exc).__name__}: {exc}"


def _zip_listing(blob: io.BytesIO, max_members: int):
    archive = zipfile.ZipFile(blob)
    infos = archive.infolist()
    readable = len(infos) <= max_members
    for info in infos:
        opener = (lambda i=info: archive.open(i)) if readable else None
        yield info.filename, _zip_kind(info), info.file_size, opener


def _tar_listing(blob: io.BytesIO, max_members: int):
    with tarfile.open(fileobj=blob) as archive:
        for at, info in enumerate(archive):
            opener = (lambda i=info: archive.extractfile(i)) if at < max_members else None
            yield info.name, _tar_kind(info), info.size, opener
            if at >= max_members:
                return


def read_entries(
    label: str, content: bytes, max_members: int, max_bytes: int
) -> Iterator[tuple]:
    """Rows of ``ENTRY_COLUMNS`` for one archive, in archive order."""
    for row in _entries(label, io.BytesIO(content), max_members, max_bytes, False):
        yield row[:-1]


def _entries(label: str, blob: BinaryIO, max_members: int, max_bytes: int, later: bool) -> Iterator[tuple]:
    """Rows of ``ENTRY_COLUMNS`` and whether the bytes are still to be read.

    Only entries of a zip can be left for ``later``, as each can be opened by itself.
    """
    if zipfile.is_zipfile(blob):
        container, listing = "zip", _zip_listing
    else:
        blob.seek(0)
        try:
            known = tarfile.is_tarfile(blob)
        except (OSError, tarfile.TarError) as exc:
            yield ("none", 0, "", UNREADABLE, 0, None, INPUT_REJECTED, f"archive cannot be opened: {exc}", False)
            return
        if not known:
            text = f"`{label}` opens neither as zip nor as tar"
            yield ("none", 0, "", UNREADABLE, 0, None, INPUT_REJECTED, text, False)
            return
        container, listing = "tar", _tar_listing
    blob.seek(0)
    ordinal, used = 0, 0
    later = later and container == "zip"
    try:
        for name, kind, size, opener in listing(blob, max_members):
            data, code, error = None, None, None
            used += size if kind == FILE else 0
            wanted = kind == FILE and opener is not None and used <= max_bytes
            if wanted and not later:
                data, code, error = _read(opener, max_bytes)
            yield (container, ordinal, name, kind, size, data, code, error, wanted and later)
            ordinal += 1
        if ordinal == 0:
            yield (container, -1, "", EMPTY, 0, None, None, None, False)
    except Exception as exc:  # the container breaks off here
        yield (container, ordinal, "", UNREADABLE, 0, None, *_failed(exc), False)


def _read(opener, ceiling: int) -> tuple[bytes | None, str | None, str | None]:
    try:
        return _bounded(opener(), ceiling), None, None
    except Exception as exc:  # one bad member must not fail the task
        return None, *_failed(exc)


def _frame(rows: list[tuple], *more: str) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=["archive", *ENTRY_COLUMNS, *more])


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = [pa.array(c, t) for c, t in zip(zip(*rows), [pa.string(), *ENTRY_TYPES])]
    return pa.RecordBatch.from_arrays(columns, ["archive", *ENTRY_COLUMNS])


def expand_archives(
    archives: DataFrame,
    max_members: int = Limits.max_archive_members,
    max_bytes: int = Limits.max_archive_bytes,
) -> DataFrame:
    """``path, content`` to ``archive`` plus the entry columns.

    Archives are taken out of Spark's batch one by one and rows are handed back in small
    batches, so a task holds the batch as it came, one archive and a few entries at a time.
    """

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for batch in batches:
            for path, content in zip(*batch.columns):
                path = path.as_py()
                label = path.rsplit("/", 1)[-1]
                for entry in read_entries(label, content.as_py(), max_members, max_bytes):
                    rows.append((path, *entry))
                    held += len(entry[5] or b"")
                    if held >= FLUSH_BYTES or len(rows) >= FLUSH_ROWS:
                        yield _batch(rows)
                        rows, held = [], 0
        if rows:
            yield _batch(rows)

    return archives.select("path", "content").mapInArrow(
        expand, schema=f"archive string, {ENTRY_FIELDS}"
    )


def expand_files(
    listing: DataFrame,
    max_members: int = Limits.max_archive_members,
    max_bytes: int = Limits.max_archive_bytes,
) -> DataFrame:
    """``path, length`` of archive files that tasks can open, to the rows of ``expand_archives``.

    No archive is ever whole in memory.  Of a zip only the directory at its end is read first;
    its members are dealt out to all tasks, and each reads its own bytes.  A tar can only be
    read in order: one task streams it, a member at a time, up to the caps.
    """

    def head(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows, held = [], 0
        for batch in batches:
            for path in batch["path"]:
                with tree.open_file(path) as blob:
                    for entry in _entries(path.rsplit("/", 1)[-1], blob, max_members, max_bytes, True):
                        rows.append((path, *entry))
                        held += len(entry[5] or b"")
                        if held >= FLUSH_BYTES or len(rows) >= FLUSH_ROWS:
                            yield _frame(rows, "later")
                            rows, held = [], 0
        if rows:
            yield _frame(rows, "later")

    def fill(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        with contextlib.ExitStack() as last:
            at = archive = infos = None
            rows, held = [], 0
            for batch in batches:
                for path, *entry, later in batch.itertuples(index=False, name=None):
                    if later:
                        if path != at:
                            last.close()
                            archive = last.enter_context(zipfile.ZipFile(last.enter_context(tree.open_file(path))))
                            at, infos = path, archive.infolist()
                        entry[5:] = _read(lambda i=infos[entry[1]]: archive.open(i), max_bytes)  # noqa: B023
                    rows.append((path, *entry))
                    held += len(entry[5] or b"")
                    if held >= FLUSH_BYTES or len(rows) >= FLUSH_ROWS:
                        yield _frame(rows)
                        rows, held = [], 0
            if rows:
                yield _frame(rows)

    tasks = tree.reading_tasks(listing)
    cores = listing.sparkSession.sparkContext.defaultParallelism
    heads = listing.select("path").repartition(tasks, "path").mapInPandas(
        head, schema=f"archive string, {ENTRY_FIELDS}, later boolean"
    )
    dealt = heads.repartition(max(tasks, cores), "archive", "ordinal").sortWithinPartitions("archive", "ordinal")
    return dealt.mapInPandas(fill, schema=f"archive string, {ENTRY_FIELDS}")


@udtf(returnType=ENTRY_FIELDS, useArrow=True)
class ExpandArchive:
    """``SELECT e.* FROM files, LATERAL expand_archive(path, content) e``.

    The caps on members and bytes may follow as third and fourth argument.
    """

    def eval(self, path: str, content: bytes, max_members: int = None, max_bytes: int = None):
        members = Limits.max_archive_members if max_members is None else int(max_members)
        size = Limits.max_archive_bytes if max_bytes is None else int(max_bytes)
        yield from read_entries(path.rsplit("/", 1)[-1], bytes(content), members, size)


def register_expand_archive(spark: SparkSession, name: str = "expand_archive") -> None:
    spark.udtf.register(name, ExpandArchive)
