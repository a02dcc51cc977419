"""Effects on storage: publish, delete and complete.

Each function runs its effect once, when called, and stores one outcome row
per file; the table it returns reads those outcomes and repeats nothing.  Work
is spread by file, and each task handles its rows one by one.  The store is any
file system Arrow can open (local, HDFS, object stores).  A task that is
retried may meet its own earlier work, so each effect leaves the same result
the second time.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.values import MISSING_FILE_CODE
from tidemark.operators.transfer import TARGET, plan_completion
from tidemark.plans.joins import join_checked
from tidemark.plans.storage import open_store, shared_dir, stage, task_count
from tidemark.sources.content import fetch_content

_OUTCOME = "seq bigint, done boolean, code bigint, message string"
_SENT = f"{_OUTCOME}, lost boolean"
# Lists of files that are taken away are kept by hash of their path.
MARK_BUCKETS = 1_024


def _outcome(row, act: Callable) -> tuple:
    try:
        act(row)
        return row.seq, True, None, None
    except FileNotFoundError as e:
        return row.seq, False, MISSING_FILE_CODE, str(e)
    except Exception as e:  # one bad file must not fail its neighbours
        return row.seq, False, None, str(e) or type(e).__name__


def _frame(outcomes: list[tuple], **more: list) -> pd.DataFrame:
    frame = pd.DataFrame(outcomes, columns=["seq", "done", "code", "message"]).assign(**more)
    return frame.astype({"seq": "int64", "done": "bool", "code": "Int64"})


def reachable(root: str) -> None:
    """Raise unless a target system's root can be asked for and is, or may become, a folder."""
    from pyarrow import fs

    store, folder = open_store(root)
    if store.get_file_info(folder).type == fs.FileType.File:
        raise NotADirectoryError(f"{root} is no folder")


def _each_of_batches(rows: Iterator[pd.DataFrame], act: Callable, connect: Callable[[str], None]) -> Iterator[pd.DataFrame]:
    """Rows of batches, one after the other; a batch whose system is lost is given up.

    After an error the system is asked for.  If it is gone, the rows of the
    batch that are still to come fail without being tried.  Rows of other
    batches go on, also those of the same system.
    """
    gone: dict[str, str] = {}
    for pdf in rows:
        done, lost = [], []
        for row in pdf.itertuples(index=False):
            if row.batch in gone:
                done.append((row.seq, False, None, gone[row.batch]))
            else:
                done.append(_outcome(row, act))
                if isinstance(row.batch, str) and not done[-1][1]:
                    try:
                        connect(row.place)
                    except Exception as e:
                        gone[row.batch] = str(e) or type(e).__name__
            lost.append(row.batch in gone)
        yield _frame(done, lost=lost)


def _is_file(store, path: str) -> bool:
    from pyarrow import fs

    return store.get_file_info(path).type == fs.FileType.File


def _below(folder: str, path: str) -> str:
    return f"{folder}/{path.lstrip('/')}"


def _markers(rows: DataFrame, run_dir: str | None) -> str:
    """The folder of a call's markers: the caller's, for calls that may be repeated, or a new one."""
    return run_dir.rstrip("/") if run_dir else f"{shared_dir(rows.sparkSession)}/markers/{uuid.uuid4().hex}"


class _Marks:
    """Which files a call has begun to take away, kept in a folder: a list of paths per bucket and batch.

    A marker per file would cost more than the deletes, as tasks wait for each
    other to make files in one folder.  A list counts from when it is closed,
    before the first of its files is touched, so one that is cut off says nothing.
    """

    def __init__(self, folder: str):
        self.store, self.folder = open_store(folder)
        self.written: set[str] = set()
        self.bucket, self.taken = None, set()

    def enter(self, bucket: int) -> None:
        """Go on with a bucket's paths; those of the bucket before come no more."""
        if bucket != self.bucket:
            self.bucket, self.taken = bucket, set()

    def begin(self, bucket: int, names: list[str]) -> None:
        place = f"{self.folder}/{bucket}"
        self.store.create_dir(place, recursive=True)
        path = f"{place}/{uuid.uuid4().hex}"
        with self.store.open_output_stream(path) as f:
            f.write(json.dumps(names).encode())
        self.written.add(path.rsplit("/", 1)[-1])

    def begun(self, bucket: int) -> set[str]:
        """Paths that other tasks, or earlier calls, have begun to take away."""
        from pyarrow import fs

        names = set()
        for info in self.store.get_file_info(fs.FileSelector(f"{self.folder}/{bucket}", allow_not_found=True)):
            if info.base_name not in self.written:
                with self.store.open_input_stream(info.path) as f:
                    try:
                        names.update(json.loads(f.read()))
                    except ValueError:  # its task died while it wrote the list
                        pass
        return names


def _dealt(rows: DataFrame, path: str, n: int) -> DataFrame:
    """Rows by bucket of their path.  The bucket is no key of the steps before, whose few tasks Spark would keep otherwise."""
    buckets = rows.withColumn("bucket", F.pmod(F.xxhash64(path), F.lit(MARK_BUCKETS)).cast("int"))
    return buckets.repartition(n, "bucket").sortWithinPartitions("bucket")


def _are_files(store, folder: str, paths: list[str]) -> list[bool | Exception]:
    """Whether each path is a file now, or why that cannot be said."""
    from pyarrow import fs

    def one(path: str) -> bool | Exception:
        try:
            return _is_file(store, _below(folder, path))
        except Exception as e:
            return e

    try:
        return [i.type == fs.FileType.File for i in store.get_file_info([_below(folder, p) for p in paths])]
    except Exception:  # one of them cannot even be asked for
        return [one(p) for p in paths]


def _each_taken(rows: Iterator[pd.DataFrame], column: str, root: str, markers: str, act: Callable) -> Iterator[pd.DataFrame]:
    """``act(store, folder, row, source)`` takes away the file of each row; marks tell a task's own work from a missing file."""
    (store, folder), marks = open_store(root), _Marks(markers)

    def of_bucket(bucket: int, pdf: pd.DataFrame) -> list[tuple]:
        marks.enter(bucket)
        there, failed = _are_files(store, folder, list(pdf[column])), None
        try:
            if any(t is True for t in there):
                marks.begin(bucket, [p for p, t in zip(pdf[column], there) if t is True])
        except Exception as e:  # nothing is taken away without a mark
            failed = e
        begun = marks.begun(bucket) if False in there else set()

        def one(row, found: bool | Exception) -> None:
            if isinstance(found, Exception):
                raise found
            path = getattr(row, column)
            source = _below(folder, path)
            if path in marks.taken:
                return
            if not found:
                if path not in begun:
                    raise FileNotFoundError(f"no such file: {path}")
                return
            if failed is not None:
                raise failed
            try:
                act(store, folder, row, source)
            except FileNotFoundError:
                if _is_file(store, source):
                    raise
                if path not in marks.begun(bucket):  # else the task runs twice, and the other one was faster
                    raise FileNotFoundError(f"no such file: {path}") from None
            marks.taken.add(path)

        return [_outcome(row, lambda r, t=found: one(r, t)) for row, found in zip(pdf.itertuples(index=False), there)]

    for pdf in rows:
        yield _frame([o for bucket, part in pdf.groupby("bucket", sort=False) for o in of_bucket(int(bucket), part)])


def target_root(root: str, by: list[str]) -> Column:
    """The folder of a request's target system: one below ``root`` for each key, with unsafe letters escaped."""
    return F.concat_ws("/", F.lit(root.rstrip("/")), *[F.url_encode(F.coalesce(F.col(c), F.lit(""))) for c in by])


def publish(plan: DataFrame, content: DataFrame, root: str | Column, tmp_suffix: str | None = None,
            create_dirs: bool = True, by: list[str] | None = None, partitions: int | None = None,
            connect: Callable[[str], None] = reachable) -> DataFrame:
    """Carry out a write plan; returns the plan with ``done``, ``code``, ``message`` and ``batch_lost``.

    ``plan`` comes from ``plan_writes`` with the same ``by``.  ``root`` is a
    folder that holds one folder per target system, or a column with the root
    folder of each request.  Of the writes to one target only the last is
    carried out, and earlier ones count as done with it; if it fails, the next
    older one is carried out instead.  Only the content of writes carried out
    is moved.  A write without a row in ``content`` (``seq``, ``content``) is a
    failure.  Requests that are no writes have no outcome (null).  With
    ``tmp_suffix`` the bytes go to ``dest + suffix`` plus the attempt id and are
    renamed over ``dest``, so readers see the old file or the new one and two
    attempts never share a temporary file.

    If the plan has ``batch_no``, the requests of a batch are handled in order by
    one task.  After a failed write ``connect`` is called with the root of the
    target system; if it raises, the system is lost: what is left of the batch
    fails untried, and every request of the batch is marked ``batch_lost``, for
    ``route_write``.  Other batches are not concerned.
    """
    by = by or TARGET
    batched = "batch_no" in plan.columns
    batch = F.to_json(F.struct(*by, "batch_no"), {"ignoreNullFields": "false"}) if batched else F.lit(None).cast("string")
    n = partitions or task_count(plan.sparkSession)
    place = root if isinstance(root, Column) else target_root(root, by)
    plan = stage(plan, "publish-plan")
    writes = F.col("write_action").isin("create", "overwrite")
    # One text names a target, null keys included.
    target = F.to_json(F.struct(*by, "dest"), {"ignoreNullFields": "false"})
    requested = plan.where(writes).select("seq", "dest", place.alias("place"), target.alias("_target"), batch.alias("batch"))
    ready = stage(requested.join(content.select("seq").distinct(), "seq", "left_semi"), "publish-ready")

    def write(rows: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        attempt, stores = TaskContext.get().taskAttemptId(), {}

        def one(row) -> None:
            if row.place not in stores:
                stores[row.place] = open_store(row.place)
            store, folder = stores[row.place]
            dest = f"{folder}/{row.dest.lstrip('/')}"
            if create_dirs:
                store.create_dir(dest.rsplit("/", 1)[0], recursive=True)
            path = f"{dest}{tmp_suffix}.{attempt}" if tmp_suffix and tmp_suffix.strip() else dest
            with store.open_output_stream(path) as f:
                f.write(row.content or b"")
            if path != dest:
                store.move(path, dest)

        yield from _each_of_batches(rows, one, connect)

    outcomes, winners, waiting = None, None, ready
    while True:  # once, and again for the older writes of targets where the newest failed
        due = stage(waiting.groupBy("_target").agg(F.max_by(F.struct("seq", "dest", "place", "batch"), "seq").alias("_due"))
                    .select("_target", "_due.*"), "publish-due")
        if due.isEmpty():
            break
        work = join_checked(content.select("seq", "content"), due.drop("_target"), ["seq"]).repartition(n, "batch" if batched else F.xxhash64("seq"))
        work = work.sortWithinPartitions("batch", "seq") if batched else work
        tried = stage(work.mapInPandas(write, _SENT), "published")
        outcomes = tried if outcomes is None else outcomes.unionByName(tried)
        named = due.select("_target", "seq").join(tried.select("seq", "done"), "seq")
        won = named.where("done").select("_target", F.col("seq").alias("_won"))
        winners = won if winners is None else winners.unionByName(won)
        failed = stage(named.where("NOT done").select("_target", F.col("seq").alias("_failed")), "publish-failed")
        if failed.isEmpty():
            break
        waiting = join_checked(waiting, failed, ["_target"]).where("seq < _failed").drop("_failed")
    if outcomes is None:
        outcomes = plan.sparkSession.createDataFrame([], _SENT)
        winners = plan.sparkSession.createDataFrame([], "_target string, _won bigint")
    known = ready.select("seq", "_target").join(winners, "_target", "left").join(outcomes, "seq", "left").select(
        "seq", F.coalesce("done", F.col("_won") > F.col("seq"), F.lit(False)).alias("done"), "code", "message",
        F.lit(True).alias("_has_content"))
    judged = join_checked(plan, stage(known, "publish-outcomes"), ["seq"], "left")
    lost = ready.join(outcomes.where("lost"), "seq", "left_semi").select("batch").distinct()
    judged = join_checked(judged.withColumn("batch", batch), lost.withColumn("batch_lost", F.lit(True)), ["batch"], "left")
    judged = judged.withColumn("batch_lost", F.coalesce("batch_lost", F.lit(False))).drop("batch")
    missing = writes & F.col("_has_content").isNull()
    return (judged.withColumn("done", F.when(missing, False).otherwise(F.col("done")))
            .withColumn("code", F.when(missing, F.lit(MISSING_FILE_CODE)).otherwise(F.col("code")))
            .withColumn("message", F.when(missing, F.lit("no content for this request")).otherwise(F.col("message")))
            .drop("_has_content"))


def lost_batches(published: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Batches whose target system was lost while ``publish`` wrote them, as ``route_write`` takes them."""
    return published.where("batch_lost").select(*(by or TARGET), "batch_no").distinct()


def delete_files(requests: DataFrame, root: str, run_dir: str | None = None,
                 partitions: int | None = None) -> DataFrame:
    """Delete each ``path`` below ``root``; returns ``seq``, ``path``, ``done``, ``code``, ``message``.

    Of several requests for one path the first (by ``seq``) deletes the file and
    the others find it gone; a request without a path fails.  ``run_dir`` holds
    the paths of deleted files, so that a task that runs again, or twice at a time,
    can tell its own delete from a missing file; without it each call has a
    folder of its own in the shared one.
    """
    firsts = requests.where(F.col("path").isNotNull()).groupBy("path").agg(F.min("seq").alias("seq"))
    work = _dealt(firsts, "path", partitions or task_count(requests.sparkSession))
    base, markers = root.rstrip("/"), _markers(requests, run_dir)

    def remove(rows: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield from _each_taken(rows, "path", base, markers, lambda store, folder, row, source: store.delete_file(source))

    outcomes = stage(work.mapInPandas(remove, _OUTCOME), "deleted")
    done = outcomes.join(firsts, "seq").withColumnRenamed("seq", "_first")
    joined = join_checked(requests.select("seq", "path"), done, ["path"], "left")
    later = (F.col("seq") != F.col("_first")) & F.col("done")
    joined = joined.withColumn("done", F.coalesce("done", F.lit(False))).withColumn(
        "message", F.when(F.col("path").isNull(), F.lit("no path")).otherwise(F.col("message")))
    return joined.select(
        "seq", "path",
        (F.col("done") & ~F.coalesce(later, F.lit(False))).alias("done"),
        F.when(later, F.lit(MISSING_FILE_CODE)).otherwise(F.col("code")).alias("code"),
        F.when(later, F.concat(F.lit("no such file: "), F.col("path"))).otherwise(F.col("message")).alias("message"))


def complete(plan: DataFrame, root: str, run_dir: str | None = None) -> DataFrame:
    """Carry out ``plan_completion``; returns ``seq``, ``done``, ``code``, ``message``.

    Call it after the fetched content has been committed.  A failure here is a
    warning in the outcome; the fetched row stays a success.  Markers in
    ``run_dir``, as in ``delete_files``, tell a source that a task itself moved
    or deleted before from one that was never there.
    """
    asked = plan.where(F.col("completion") != "none").select("seq", "full_path", "completion", "move_to", "ensure_directory")
    work = _dealt(asked, "full_path", task_count(plan.sparkSession))
    base, markers = root.rstrip("/"), _markers(plan, run_dir)

    def one(store, folder: str, row, source: str) -> None:
        if row.completion == "delete":
            store.delete_file(source)
            return
        if row.ensure_directory:
            store.create_dir(f"{folder}/{row.ensure_directory.strip('/')}", recursive=True)
        store.move(source, f"{folder}/{row.move_to.lstrip('/')}")

    def finish(rows: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield from _each_taken(rows, "full_path", base, markers, one)

    return stage(work.mapInPandas(finish, _OUTCOME), "completed")


def fetch_commit_complete(listing: DataFrame, root: str, commit: Callable[[DataFrame], DataFrame], strategy: str,
                          destination: Column | None = None, create_directory: bool = False,
                          run_dir: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Fetch listed files, commit their content, and only then move or delete the sources.

    ``listing`` has ``seq``, ``full_path`` and ``filename``.  ``commit`` stores
    the fetched rows and returns the stored table; if it raises, no source has
    been touched.  Returns the stored rows and the outcomes of the completion.
    """
    stored = commit(fetch_content(listing, root))
    plan = plan_completion(stored.drop("content"), strategy, destination, create_directory)
    return stored, complete(plan, root, run_dir)
