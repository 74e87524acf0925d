"""Numbered commit files: what a table or ledger holds changes by one rename, which fails if another writer was first."""

import json
import re
import uuid

_NAME = re.compile(r"(\d{12})\.json")


class LostRace(RuntimeError):
    """Another writer has put this version in place."""


def _files(spark, path):
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs, fs.makeQualified(path)


def _versions(fs, folder):
    if not fs.exists(folder):
        return []
    found = [_NAME.fullmatch(status.getPath().getName()) for status in fs.listStatus(folder)]
    return sorted(int(m.group(1)) for m in found if m)


def newest(spark, folder):
    """(version, content) of the last commit; (0, None) before the first."""
    fs, path = _files(spark, folder)
    versions = _versions(fs, path)
    if not versions:
        return 0, None
    stream = fs.open(_files(spark, f"{folder}/{versions[-1]:012d}.json")[1])
    try:
        return versions[-1], json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def commit(spark, folder, version, content):
    """Put ``content`` in place as ``version``; LostRace if that version is there already.

    The file is written whole under another name first, so a reader sees all of a commit or nothing.
    """
    fs, draft = _files(spark, f"{folder}/.{version:012d}-{uuid.uuid4().hex}")
    final = _files(spark, f"{folder}/{version:012d}.json")[1]
    out = fs.create(draft, False)
    try:
        out.write(bytearray(json.dumps(content).encode()))
    finally:
        out.close()
    hadoop = spark._jvm.org.apache.hadoop.fs
    plain = spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
    try:
        hadoop.FileContext.getFileContext(final.toUri(), spark._jsc.hadoopConfiguration()).rename(draft, final, plain)
    except Exception as problem:
        fs.delete(draft, False)
        if "FileAlreadyExistsException" in str(problem):
            raise LostRace(f"version {version} of {folder} is there already") from None
        raise


def forget_before(spark, folder, version):
    """Remove commits older than ``version``."""
    fs, path = _files(spark, folder)
    for old in _versions(fs, path):
        if old < version:
            fs.delete(_files(spark, f"{folder}/{old:012d}.json")[1], False)
