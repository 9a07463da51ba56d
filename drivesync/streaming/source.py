"""A replicated folder as a resumable source: listing job, snapshot, change stream.

``poll`` is the scheduled job that notices changes: it lists the folder, diffs
it against the last listing and appends the changes to the log. ``stream``
follows the log from its checkpoint. State lives in two tables below
``state_dir``: the last listings, and the log.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from drivesync.operators.records import payload_records
from drivesync.options import SourceOptions
from drivesync.schemas import ENTRY
from drivesync.session import remove_dir
from drivesync.sources import tree
from drivesync.streaming import changelog, manifests, sink


class FolderSource:
    def __init__(self, spark: SparkSession, root: str, state_dir: str, options=SourceOptions()):
        tree.verify_folder(root, options.path)
        self.spark, self.root, self.options = spark, root.rstrip("/"), options
        self.log_dir = f"{state_dir.rstrip('/')}/log"
        self.listing_dir = f"{state_dir.rstrip('/')}/listing"

    def list(self, known: DataFrame | None = None) -> DataFrame:
        """Files of the folder with content hashes; unchanged ones are not read again."""
        options = self.options
        found = tree.list_tree(self.spark, self.root, options.path, options.recursive)
        return tree.with_hashes(found.where(F.col("tag") == "file"), self.root, known)

    def snapshot(self) -> DataFrame:
        """Records of every file there is, without any state."""
        rows = tree.tree_payloads(self.list(), self.root, self.options.chunk_size)
        kind = F.when(F.col("chunk_index").isNull(), "full").otherwise("chunked")
        rows = rows.withColumns({"kind": kind, "seq": F.lit(0).cast("long")})
        return payload_records(rows, F.lit(""))

    def _listing(self, attempt: str) -> DataFrame:
        return self.spark.read.schema(ENTRY).parquet(f"{self.listing_dir}/{attempt}")

    def listing(self, version: int) -> DataFrame:
        """The listing that led to a committed version."""
        return self._listing(manifests.read(self.spark, self.log_dir, version).attempt)

    def poll(self, full: bool = False) -> int:
        """Append what changed since the last poll; returns the newest log version.

        Files of unchanged size and time are taken as unchanged; ``full`` reads
        and hashes them again.

        Listing and changes belong to one attempt, which the manifest of the log
        version names. A poll that dies has committed both or neither; run it again.
        """
        last = manifests.recover(self.spark, self.log_dir)
        old = self._listing(last.attempt) if last else None
        version = last.version + 1 if last else 1
        attempt = manifests.new_attempt(version)
        found = self.list(None if full else old).select(*ENTRY.names)
        found.write.parquet(f"{self.listing_dir}/{attempt}")
        done = changelog.append_changes(
            old, self._listing(attempt), self.log_dir, version, last.last_seq if last else 0,
            self.options.max_entries_per_batch, last.mark if last else 0, attempt, self.options.bytes_per_file,
        )
        if done is None:
            remove_dir(self.spark, f"{self.listing_dir}/{attempt}")
        if last:
            self._drop_listings(last)
        return version if done else version - 1

    def _drop_listings(self, last: manifests.Manifest) -> None:
        """Remove listings of trimmed versions, and of attempts that lost against ``last``."""
        oldest = manifests.versions(self.spark, self.log_dir)[-1]
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.listing_dir)
        store = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        for status in store.listStatus(path):
            name = status.getPath().getName()
            version = int(name.split("-")[0])
            if version < oldest or (version == last.version and name != last.attempt):
                store.delete(status.getPath(), True)

    def changes(self, after: int | None = None) -> DataFrame:
        """The log as a stream, ``files_per_batch`` of its files (pages) per micro-batch."""
        return changelog.follow(
            self.spark, self.log_dir, files_per_batch=self.options.files_per_batch, after=after
        )

    def records(self, changes: DataFrame) -> DataFrame:
        return tree.change_records(changes, self.root, self.options.chunk_size)

    def stream(self, after: int | None = None) -> DataFrame:
        """Records of the changes. A log trimmed in front of this stream goes
        unnoticed, see ``replicate``."""
        return self.records(self.changes(after))

    def replicate(self, write, checkpoint: str, once: bool = True, after: int | None = None) -> StreamingQuery:
        """Run the change stream into a sink, see ``sink.action_sink``.

        The log version delivered last is noted next to the checkpoint. A batch
        that skips a version fails with ``ExpiredPosition``: what it held was
        trimmed unread. Go on with ``changes_from`` and a new checkpoint with
        ``after``, the position of the relisting.
        """
        notes = delivered_notes(checkpoint)

        def deliver(changes: DataFrame, batch_id: int) -> None:
            spark = changes.sparkSession
            # As many as the batch has log files at most.
            seen = [row["version"] for row in changes.select("version").distinct().collect()]
            if seen:
                last = changelog.delivered_version(spark, notes)
                if last is None:
                    # A log starts with version 1; other starts were checked or are not known.
                    last = 0 if batch_id == 0 and after is None else min(seen) - 1
                changelog.check_no_gap(seen, last)
            write(self.records(changes), batch_id)
            if seen:
                changelog.note_delivered(spark, notes, max(seen))

        return sink.start(self.changes(after), deliver, checkpoint, once, self.options.trigger_interval)

    def changes_from(self, saved: int, held: DataFrame | None = None, mark: int = 0) -> DataFrame:
        """Records behind a saved position. When it has expired: of the last change
        of each path if the log was compacted from there on, else of everything, or with ``held(path, content_hash)`` of what differs, deletes included."""
        last = changelog.last_version(self.spark, self.log_dir)
        return self.records(
            changelog.open_changes(self.spark, self.log_dir, saved, self.listing(last), held, mark)
        )

    def trim(self, checkpoints: list[str], compact: bool = False) -> None:
        """Remove what none of the queries with these checkpoints needs any more:
        log versions below the one each has delivered last.
        A query that has delivered nothing yet keeps everything. With ``compact``
        the last change of each path stays, for consumers of ``changes_from``."""
        done = [changelog.delivered_version(self.spark, delivered_notes(c)) for c in checkpoints]
        if done and None not in done:
            changelog.trim(self.spark, self.log_dir, min(done), compact)


def delivered_notes(checkpoint: str) -> str:
    return f"{checkpoint.rstrip('/')}-delivered"
