"""Zip archives.

Each archive is one row of a Spark listing; the archive itself is opened inside
a task with ``zipfile`` over a seekable ``pyarrow.fs`` stream, so neither the
driver nor a single task ever holds all archives, and members are streamed, not
loaded whole.

Rule (per archive, hidden members such as ``.DS_Store`` or ``__MACOSX/...``
ignored): exactly one member -> ``extracted``; more than one -> ``skipped``
(reported, nothing written); none -> ``rejected``.  An archive that cannot be
read is ``corrupt``; it does not stop the others.
"""

from __future__ import annotations

import io
import lzma
import zipfile
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from tabulon.session import qualified, scratch_path
from tabulon.sources.files import (atomic_output, file_inventory, fs_for, spread_files,
                                   write_file_atomic)

REPORT_SCHEMA = ("archive string, source string, n_members int, member string, "
                 "status string, out_path string, bytes long")
CHUNK = 1 << 20
#: Status of an archive that cannot be read, and what reading one raises (encrypted ones included).
CORRUPT = "corrupt"
UNREADABLE = (zipfile.BadZipFile, zlib.error, lzma.LZMAError, EOFError, NotImplementedError, RuntimeError)


def is_hidden(member: str) -> bool:
    parts = member.rstrip("/").split("/")
    return member.endswith("/") or any(p.startswith(".") or p.startswith("__MACOSX") for p in parts)


def visible_members(zf: zipfile.ZipFile) -> list[str]:
    return [m for m in zf.namelist() if not is_hidden(m)]


def classify(n_members: int) -> str:
    if n_members == 1:
        return "extracted"
    return "skipped" if n_members > 1 else "rejected"


def extracted_name(archive_name: str, member: str) -> str:
    """Where a member lands, relative to the output root.

    The archive's folder is kept (it names the extract, e.g. one fiscal year)
    and the archive's stem prefixes the member, so equal member names from
    different archives never collide.
    """
    folder, _, base = archive_name.rpartition("/")
    stem = base.rsplit(".", 1)[0]
    leaf = f"{stem}__{member.rsplit('/', 1)[-1]}"
    return f"{folder}/{leaf}" if folder else leaf


class _Seekable(io.RawIOBase):
    """A ``pyarrow`` random-access file with the full ``seek`` protocol zipfile uses."""

    def __init__(self, f):
        self._f = f
        self._size = f.size()

    def readable(self) -> bool:
        return True

    def seekable(self) -> bool:
        return True

    def tell(self) -> int:
        return self._f.tell()

    def seek(self, offset: int, whence: int = 0) -> int:
        target = {0: 0, 1: self._f.tell(), 2: self._size}[whence] + offset
        if target < 0:
            raise OSError(22, "negative seek position")
        self._f.seek(target)
        return target

    def readinto(self, buf) -> int:
        data = self._f.read(len(buf))
        buf[: len(data)] = data
        return len(data)

    def close(self) -> None:
        self._f.close()
        super().close()


def _open_zip(uri: str) -> zipfile.ZipFile:
    fs, path = fs_for(uri)
    return zipfile.ZipFile(io.BufferedReader(_Seekable(fs.open_input_file(path))))


def expand_archives(spark: SparkSession, root: str, out_root: str,
                    pattern: str = "*.zip") -> DataFrame:
    """Extract every single-member archive below ``root`` into ``out_root``.

    Members land at ``out_root/<archive folder>/<archive stem>__<member base name>``
    (``extracted_name``).  An archive that cannot be read is reported as
    ``corrupt`` and the others go on.  Runs the extraction job now and returns the per-archive report, staged as Parquet so
    later actions do not repeat the side effect.
    """
    listing = file_inventory(spark, root, pattern).select("path", "file_name", "source", "size")
    out_root = qualified(spark, out_root).rstrip("/")

    def extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for path, name, source in zip(pdf["path"], pdf["file_name"], pdf["source"]):
                try:
                    with _open_zip(path) as zf:
                        members = visible_members(zf)
                        status = classify(len(members))
                        if status != "extracted":
                            rows.append((name, source, len(members), None, status, None, 0))
                            continue
                        member = members[0]
                        target = f"{out_root}/{extracted_name(name, member)}"
                        with zf.open(member) as fh:
                            n = write_file_atomic(target, iter(lambda: fh.read(CHUNK), b""))
                        rows.append((name, source, 1, member, status, target, n))
                except UNREADABLE:
                    rows.append((name, source, None, None, CORRUPT, None, 0))
            yield pd.DataFrame(rows, columns=["archive", "source", "n_members", "member",
                                              "status", "out_path", "bytes"])

    report = spread_files(listing).mapInPandas(extract, REPORT_SCHEMA)
    staged = scratch_path(spark, "archive-report")
    report.write.parquet(staged)
    return spark.read.parquet(staged)


def nth_lines(spark: SparkSession, root: str, n: int = 0, pattern: str = "*.zip") -> DataFrame:
    """Line ``n`` (0-based, terminator removed) of the member of every archive.

    Archives that do not hold exactly one member give a NULL line and their
    status, instead of failing the whole job.
    """
    listing = file_inventory(spark, root, pattern).select("path", "file_name", "source")

    def lines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for path, name, source in zip(pdf["path"], pdf["file_name"], pdf["source"]):
                line = None
                try:
                    with _open_zip(path) as zf:
                        members = visible_members(zf)
                        status = classify(len(members))
                        if status == "extracted":
                            with zf.open(members[0]) as fh:
                                raw = b""
                                for _ in range(n + 1):
                                    raw = fh.readline()
                                    if not raw:
                                        break
                                if raw:
                                    line = raw.rstrip(b"\r\n").decode("utf-8", errors="replace")
                except UNREADABLE:
                    status = CORRUPT
                rows.append((name, source, status, n, line))
            yield pd.DataFrame(rows, columns=["archive", "source", "status", "line_no", "line"])

    return spread_files(listing).mapInPandas(
        lines, "archive string, source string, status string, line_no int, line string")


def write_archives(files: DataFrame, out_root: str) -> DataFrame:
    """Zip files listed in ``files`` (columns ``path``, ``archive``, ``members``).

    ``members`` is an array of ``(name, kind)`` structs: kind ``data`` streams the
    listed file into the member, ``hidden`` writes a small marker.  An empty
    array produces an archive with no member.  Runs inside tasks; returns the
    written archive paths.
    """
    out_root = out_root.rstrip("/")

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for path, archive, members in zip(pdf["path"], pdf["archive"], pdf["members"]):
                target = f"{out_root}/{archive}"
                # zipfile streams into the (non-seekable) shared-storage output;
                # nothing is staged on the machine's local disk.
                with atomic_output(target) as stream:
                    with zipfile.ZipFile(stream, "w", compression=zipfile.ZIP_DEFLATED) as zf:
                        for m in members:
                            if m["kind"] == "hidden":
                                zf.writestr(m["name"], b"hidden")
                                continue
                            fs, p = fs_for(path)
                            with fs.open_input_stream(p) as src, zf.open(m["name"], "w") as dst:
                                for chunk in iter(lambda: src.read(CHUNK), b""):
                                    dst.write(chunk)
                    n = stream.tell()
                out.append((archive, target, n))
            yield pd.DataFrame(out, columns=["archive", "out_path", "bytes"])

    return spread_files(files).mapInPandas(build, "archive string, out_path string, bytes long")
