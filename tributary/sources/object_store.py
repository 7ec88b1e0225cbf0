"""Objects of a bucket as files of any Hadoop file system: s3a, gs, hdfs or a local folder."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

ADDRESS = re.compile(r"^(?P<scheme>[a-z0-9]+)://(?P<bucket>[^/]+)/?(?P<key>.*)$")


def parse(address: str) -> tuple[str, str]:
    """(bucket, key) of scheme://bucket/key; anything else is an error."""
    m = ADDRESS.match(address)
    if not m:
        raise ValueError(f"not the address of an object: {address!r}")
    return m["bucket"], m["key"]


class ObjectStore:
    """put, get, list, exists and delete below ``root``, which is a folder of any file system of the session.

    Keys are relative and may not leave the root. ``signer`` makes addresses for others to read an object
    (the credentials for that are the caller's); without it the address itself is given.
    """

    def __init__(self, spark: SparkSession, root: str, signer=None) -> None:
        self.spark, self.root, self.signer = spark, root.rstrip("/"), signer
        self._jvm, self._conf = spark._jvm, spark._jsc.hadoopConfiguration()

    def address(self, key: str) -> str:
        if key.startswith("/") or ".." in key.split("/") or not key:
            raise ValueError(f"not a key: {key!r}")
        return f"{self.root}/{key}"

    def _path(self, key: str):
        path = self._jvm.org.apache.hadoop.fs.Path(self.address(key))
        return path, path.getFileSystem(self._conf)

    def put(self, key: str, content: bytes) -> str:
        path, fs = self._path(key)
        out = fs.create(path, True)
        try:
            out.write(content)
        finally:
            out.close()
        return self.address(key)

    def get(self, key: str) -> bytes:
        path, fs = self._path(key)
        if not fs.exists(path):
            raise KeyError(key)
        source = fs.open(path)
        try:
            return bytes(self._jvm.org.apache.commons.io.IOUtils.toByteArray(source))
        finally:
            source.close()

    def exists(self, key: str) -> bool:
        path, fs = self._path(key)
        return bool(fs.exists(path))

    def delete(self, key: str) -> bool:
        """Whether there was such an object."""
        path, fs = self._path(key)
        return bool(fs.delete(path, False))

    def list(self, prefix: str = "") -> list[str]:
        """The keys that begin with ``prefix``, in order."""
        root = self._jvm.org.apache.hadoop.fs.Path(self.root)
        fs = root.getFileSystem(self._conf)
        if not fs.exists(root):
            return []
        base, found, keys = fs.makeQualified(root).toString().rstrip("/") + "/", fs.listFiles(root, True), []
        while found.hasNext():
            name = found.next().getPath().toString()
            if name.startswith(base + prefix):
                keys.append(name[len(base) :])
        return sorted(keys)

    def presign(self, key: str, seconds: int = 3600) -> str:
        return self.signer(self.address(key), seconds) if self.signer else self.address(key)

    def read(self, pattern: str = "*") -> DataFrame:
        """(path, modificationTime, length, content) of the objects, read by the executors and not by the driver."""
        return self.spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(self.root)
