"""All-or-nothing batches of a landing zone: staged files, a commit mark, and what is left to do after it.

``<root>/_landing/batch=<n>`` holds a batch's work: ``staged`` (file copies under their relative names), ``files`` (what became of each source
file) and two marks. Before ``committed`` nothing of the batch counts: readers skip its folders, and a retry or the next start takes
them back. After it the batch stands: its files are moved to their names, its sources to the archive, and ``finished`` is
set. Both moves can be repeated, so a batch that was lost between the marks is finished by the next start.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.session import at_once
from strandline.sources.commits import create_once, filesystem
from strandline.sources.writers import arrow_uri


def move_files(rows: DataFrame, name: str, source: str, target: str) -> None:
    """Move the files whose names below the folder ``source`` stand in column ``name`` to the same names below ``target``.

    The tasks move them; files that were moved before are passed over.
    """

    def run(part) -> None:
        from pyarrow import fs

        from_store, old_base = fs.FileSystem.from_uri(arrow_uri(source))
        to_store, new_base = fs.FileSystem.from_uri(arrow_uri(target))
        made = set()
        for (relative,) in part:
            old, new = f"{old_base}/{relative}", f"{new_base}/{relative}"
            if from_store.get_file_info(old).type == fs.FileType.NotFound:
                if to_store.get_file_info(new).type == fs.FileType.NotFound:
                    raise FileNotFoundError(f"{relative} is neither in {source} nor in {target}")
                continue
            folder = new.rsplit("/", 1)[0]
            if folder not in made:
                to_store.create_dir(folder, recursive=True)
                made.add(folder)
            if from_store == to_store:
                from_store.move(old, new)
            else:
                fs.copy_files(old, new, source_filesystem=from_store, destination_filesystem=to_store)
                from_store.delete_file(old)

    rows.select(name).foreachPartition(run)


class BatchLog:
    """Batches below ``root`` whose rows go to ``batch_id=`` folders of ``tables`` (paths below ``root``)."""

    def __init__(self, spark: SparkSession, root: str, tables: Sequence[str]) -> None:
        self.spark, self.root, self.tables = spark, root.rstrip("/"), tuple(tables)

    def folder(self, batch_id: int) -> str:
        return f"{self.root}/_landing/batch={batch_id}"

    def staged(self, batch_id: int) -> str:
        return f"{self.folder(batch_id)}/staged"

    def _exists(self, path: str) -> bool:
        fs, target = filesystem(self.spark, path)
        return fs.exists(target)

    def _delete(self, path: str) -> None:
        fs, target = filesystem(self.spark, path)
        fs.delete(target, True)

    def batches(self, mark: str | None = None) -> list[int]:
        """Numbers of all batches, or of those with a mark."""
        fs, target = filesystem(self.spark, f"{self.root}/_landing")
        if not fs.exists(target):
            return []
        found = [int(s.getPath().getName().removeprefix("batch=")) for s in fs.listStatus(target)]
        return sorted(n for n in found if mark is None or self._exists(f"{self.folder(n)}/{mark}"))

    def committed(self, batch_id: int) -> bool:
        return self._exists(f"{self.folder(batch_id)}/committed")

    def begin(self, batch_id: int) -> None:
        """Leave a trace before the first output, and take back what an earlier attempt left."""
        self.roll_back(batch_id)
        fs, target = filesystem(self.spark, self.folder(batch_id))
        fs.mkdirs(target)

    def roll_back(self, batch_id: int) -> None:
        """Remove all outputs of a batch without commit; its trace goes last, so that a lost rollback is done again."""
        if self.committed(batch_id):
            raise ValueError(f"batch {batch_id} is committed")
        for table in self.tables:
            self._delete(f"{self.root}/{table}/batch_id={batch_id}")
        self._delete(self.folder(batch_id))

    def commit(self, batch_id: int) -> None:
        create_once(self.spark, f"{self.folder(batch_id)}/committed")

    def finish(self, batch_id: int, source: str, archive: str | None) -> None:
        """Move staged files to their names and landed sources to ``archive``; may be repeated."""
        if self._exists(f"{self.folder(batch_id)}/finished"):
            return
        moves = []
        if self._exists(self.staged(batch_id)):
            staged = self.spark.read.format("binaryFile").option("recursiveFileLookup", True).load(self.staged(batch_id)).select("path")
            name = F.substring_index("path", f"/_landing/batch={batch_id}/staged/", -1)
            # a task for each core, not for each 32 files
            copies = staged.select(name.alias("name")).coalesce(self.spark.sparkContext.defaultParallelism)
            moves.append(lambda: move_files(copies, "name", self.staged(batch_id), self.root))
        if archive:
            files = self.spark.read.schema("path string, error string").parquet(f"{self.folder(batch_id)}/files").filter("error is null")
            base = source.rstrip("/").split("://")[-1].split(":", 1)[-1].rstrip("/") + "/"
            sources = files.select(F.substring_index("path", base, -1).alias("name")).repartition(self.spark.sparkContext.defaultParallelism)
            moves.append(lambda: move_files(sources, "name", source.rstrip("/"), f"{archive.rstrip('/')}/batch_id={batch_id}"))
        at_once(self.spark, *moves)
        create_once(self.spark, f"{self.folder(batch_id)}/finished")

    def recover(self, source: str, archive: str | None) -> dict[str, list[int]]:
        """Bring every batch to an end: committed ones are finished, all others taken back."""
        finished, committed = set(self.batches("finished")), set(self.batches("committed"))
        done: dict[str, list[int]] = {"finished": [], "rolled_back": []}
        for n in self.batches():
            if n in committed and n not in finished:
                self.finish(n, source, archive)
                done["finished"].append(n)
            elif n not in committed:
                self.roll_back(n)
                done["rolled_back"].append(n)
        return done

    def read(self, table: str) -> DataFrame | None:
        """Rows of committed batches of one table, with all columns that any of them has; None without any."""
        base = f"{self.root}/{table}"
        paths = [p for n in self.batches("committed") if self._exists(p := f"{base}/batch_id={n}")]
        return self.spark.read.option("basePath", base).option("mergeSchema", True).parquet(*paths) if paths else None
