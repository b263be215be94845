"""Driver-side file-system metadata through the Hadoop ``FileSystem`` API.

Only metadata operations live here: exists, list directories, rename, delete,
content length. They cost one name-node (or object-store) call each and move no
row data. The file system is resolved from each path, so ``hdfs://``, ``s3a://``
and ``file:`` paths work alike.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class DirEntry:
    path: str
    name: str
    is_dir: bool
    length: int


class HadoopFS:
    def __init__(self, spark: SparkSession):
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    def _path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def _fs(self, path: str):
        return self._path(path).getFileSystem(self._conf)

    def qualify(self, path: str) -> str:
        p = self._path(path)
        return str(p.getFileSystem(self._conf).makeQualified(p))

    def exists(self, path: str) -> bool:
        return bool(self._fs(path).exists(self._path(path)))

    def is_dir(self, path: str) -> bool:
        fs = self._fs(path)
        p = self._path(path)
        return bool(fs.exists(p) and fs.getFileStatus(p).isDirectory())

    def mkdirs(self, path: str) -> None:
        self._fs(path).mkdirs(self._path(path))

    def touch(self, path: str) -> None:
        """Create an empty file (and its directory)."""
        self._fs(path).create(self._path(path)).close()

    def list(self, path: str) -> list[DirEntry]:
        fs = self._fs(path)
        p = self._path(path)
        if not fs.exists(p):
            return []
        out = []
        for st in fs.listStatus(p):
            sp = st.getPath()
            out.append(DirEntry(str(sp), sp.getName(), bool(st.isDirectory()), int(st.getLen())))
        return out

    def default_block_size(self, path: str) -> int:
        """The file system's default block size for files under ``path``."""
        p = self._path(path)
        return int(p.getFileSystem(self._conf).getDefaultBlockSize(p))

    def delete(self, path: str, recursive: bool = True) -> bool:
        """Delete ``path``; ``False`` when it did not exist (one call)."""
        p = self._path(path)
        return bool(p.getFileSystem(self._conf).delete(p, recursive))

    def delete_many(self, paths: list[str], threads: int = 16) -> int:
        """Delete many paths; the calls overlap on a small driver thread pool
        (each is one independent metadata request). Returns how many existed."""
        if len(paths) <= 1:
            return sum(self.delete(p) for p in paths)
        from concurrent.futures import ThreadPoolExecutor

        with ThreadPoolExecutor(max_workers=min(threads, len(paths))) as pool:
            return sum(pool.map(self.delete, paths))

    def child_dir_names(self, path: str, prefix: str = "") -> list[str]:
        """Names of the entries directly below ``path`` that start with ``prefix``
        (one glob call, then one call per name)."""
        pattern = self._path(f"{path.rstrip('/')}/{_glob_escape(prefix)}*")
        statuses = pattern.getFileSystem(self._conf).globStatus(pattern)
        if statuses is None:
            return []
        paths = self._jvm.org.apache.hadoop.fs.FileUtil.stat2Paths(statuses)
        return [paths[i].getName() for i in range(len(paths))]

    def rename(self, src: str, dst: str) -> None:
        """Rename that refuses to nest: the target must not exist.

        ``FileSystem.rename`` onto an existing directory moves the source *inside*
        it and still reports success, so we check first and verify after.
        """
        fs = self._fs(src)
        s, d = self._path(src), self._path(dst)
        if fs.exists(d):
            raise FileExistsError(f"rename target exists: {dst}")
        parent = d.getParent()
        if parent is not None and not fs.exists(parent):
            fs.mkdirs(parent)
        if not fs.rename(s, d) or not fs.exists(d) or fs.exists(s):
            raise OSError(f"rename failed: {src} -> {dst}")


def _glob_escape(text: str) -> str:
    out = []
    for ch in text:
        if ch in "*?[]{}\\":
            out.append("\\" + ch)
        else:
            out.append(ch)
    return "".join(out)
