"""The model call: bounded concurrency in each task, one attempt per row."""

from __future__ import annotations

import datetime
import http.client
import select
import threading
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Callable, Iterator
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harkline.functions.payload import parse_response
from harkline.operators.journal import Journal, take_over
from harkline.operators.resume import MAX_RETRIES, pending, resume_state
from harkline.session import delete_folder, written
from harkline.sources.results import read_results, write_results

#: request JSON in, response JSON out; built once per task
Client = Callable[[str], str]
ClientFactory = Callable[[], Client]

_RESUME = ["utt", "idx", "status", "retry_attempt"]

#: Items one annotation task calls the model for: what a lost task repeats.
TASK_ITEMS = 2000
#: Items one write of a pass holds: the calls a lost driver repeats at most.
SLICE_ITEMS = 200_000
#: Neighbouring numeric keys that stay in one slice, so that it reads stretches of a shard.
_STRETCH = 1024


def http_client(base_url: str, timeout: float = 180.0) -> ClientFactory:
    """Factory of a client for a chat-completions server; it never sends a request twice.

    Each thread of a task keeps its connection from call to call. One that the server has
    closed meanwhile is opened anew before anything is sent on it.
    """
    parts = urllib.parse.urlsplit(base_url)
    path = f"{parts.path.rstrip('/')}/chat/completions"
    headers = {"Content-Type": "application/json"}

    def by_proxy(request: str) -> str:
        message = urllib.request.Request(f"{base_url.rstrip('/')}/chat/completions", data=request.encode("utf-8"), headers=headers)
        with urllib.request.urlopen(message, timeout=timeout) as answer:
            return answer.read().decode("utf-8")

    def factory() -> Client:
        if urllib.request.getproxies().get(parts.scheme) and not urllib.request.proxy_bypass(parts.hostname):
            return by_proxy
        kept = threading.local()

        def connection() -> http.client.HTTPConnection:
            held = getattr(kept, "connection", None)
            # something to read before a request was sent: the other side has closed it
            if held is not None and held.sock is not None and not select.select([held.sock], [], [], 0)[0]:
                return held
            drop()
            kind = http.client.HTTPSConnection if parts.scheme == "https" else http.client.HTTPConnection
            kept.connection = kind(parts.hostname, parts.port, timeout=timeout)
            return kept.connection

        def drop() -> None:
            if getattr(kept, "connection", None) is not None:
                kept.connection.close()
            kept.connection = None

        def call(request: str) -> str:
            try:
                link = connection()
                link.request("POST", path, request.encode("utf-8"), headers)
                answer = link.getresponse()
                body = answer.read()
            except BaseException:
                drop()
                raise
            if answer.status >= 300:
                raise urllib.error.HTTPError(base_url, answer.status, answer.reason, answer.headers, None)
            return body.decode("utf-8")

        return call

    return factory


def _attempt(client: Client, request: str | None, problem: str | None) -> tuple:
    """Response, error, seconds and the time when the call ended."""
    began = time.monotonic()

    def ended() -> tuple[float, datetime.datetime]:
        return time.monotonic() - began, datetime.datetime.now(datetime.timezone.utc)

    if problem is not None or request is None:
        return None, problem or "no request", 0.0, ended()[1]
    try:
        return client(request), None, *ended()
    except Exception as failure:
        return None, str(failure) or type(failure).__name__, *ended()


def annotate(
    requests: DataFrame,
    client_factory: ClientFactory,
    request: str = "request",
    error: str = "request_error",
    threads: int = 16,
    journal: Journal | None = None,
) -> DataFrame:
    """Call the model once for each row: - request, + response, call_error, processing_time, ts (end of the call).

    A row whose `error` column is set is not sent. At most `threads` calls of a task
    are under way and as many wait, across batches; a failed call fails its row only.
    Write the result once and read it back: evaluating it again calls again. With `journal`
    (a folder of this evaluation's own) a task keeps its answers as they come, and takes them
    from there when it runs again.
    """
    kept = [f for f in requests.schema.fields if f.name not in (request, error, "ts")]
    schema = T.StructType(
        kept
        + [
            T.StructField("response", T.StringType()),
            T.StructField("call_error", T.StringType()),
            T.StructField("processing_time", T.DoubleType()),
            T.StructField("ts", T.TimestampType()),
        ]
    )
    names = [f.name for f in kept]
    has_error = error in requests.columns
    most, wait_at_most = (journal.rows, journal.seconds) if journal else (256, float("inf"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        client = client_factory()
        under_way: dict = {}
        done: list[tuple] = []
        again: list[tuple] = []
        kinds: list[pa.DataType] = []
        book = journal.task(TaskContext.get().partitionId()) if journal else None
        earlier = book.answers(names) if book else {}
        saved = time.monotonic()

        def collect() -> None:
            finished, _ = wait(under_way, return_when=FIRST_COMPLETED)
            done.extend((*under_way.pop(f), *f.result()) for f in finished)

        def frame(rows: list[tuple]) -> pa.RecordBatch:
            types = [*kinds, pa.string(), pa.string(), pa.float64(), pa.timestamp("us", tz="UTC")]
            arrays = [pa.array([row[i] for row in rows], kind) for i, kind in enumerate(types)]
            rows.clear()
            return pa.RecordBatch.from_arrays(arrays, schema.names)

        def answered() -> pa.RecordBatch:
            nonlocal saved
            batch, saved = frame(done), time.monotonic()
            if book:
                book.append(batch)
            return batch

        with ThreadPoolExecutor(max_workers=threads) as pool:
            for batch in batches:
                # Python values of the Arrow columns: a nullable whole number stays one
                kinds = [batch[n].type for n in names]
                problems = batch[error].to_pylist() if has_error else [None] * batch.num_rows
                rows = zip(*(batch[n].to_pylist() for n in names)) if names else [()] * batch.num_rows
                for row, text, problem in zip(rows, batch[request].to_pylist(), problems):
                    if earlier and earlier.get(repr(row)):
                        again.append(earlier[repr(row)].pop())
                        if len(again) >= 256:
                            yield frame(again)
                        continue
                    while len(under_way) >= 2 * threads:
                        collect()
                    under_way[pool.submit(_attempt, client, text, problem)] = row
                    if len(done) >= most or (done and time.monotonic() - saved >= wait_at_most):
                        yield answered()
            while under_way:
                collect()
                if done and time.monotonic() - saved >= wait_at_most:
                    yield answered()
        if again:
            yield frame(again)
        if done:
            yield answered()

    return requests.mapInArrow(run, schema)


def result_record(annotated: DataFrame, key: str = "utt") -> DataFrame:
    """Ok and fail records from called rows; a response without content is a failure."""
    answer = F.col("_answer")
    error = F.coalesce(
        F.col("call_error"), F.when(answer["content"].isNull(), F.lit("no content in response"))
    )
    ok = F.col("error").isNull()
    only_ok = ["audio_duration", "audio_duration_error", "sample_rate", "mime_type", "compressed_size", "sample_weight"]
    others = [c for c in annotated.columns if c not in (key, "response", "call_error", "processing_time", "retry_attempt", *only_ok)]

    def when_ok(value: Column, name: str) -> Column:
        return F.when(ok, value).alias(name)

    return (
        annotated.withColumn("_answer", parse_response(F.col("response")))
        .withColumn("error", error)
        .select(
            key,
            F.when(ok, "ok").otherwise("fail").alias("status"),
            when_ok(answer["content"], "caption"),
            when_ok(answer["usage"], "usage"),
            "error",
            "processing_time",
            F.col("retry_attempt").cast("bigint").alias("retry_attempt"),
            *[when_ok(F.col(c), c) for c in only_ok if c in annotated.columns],
            *others,
        )
    )


def annotate_retry(
    items: DataFrame,
    log_path: str,
    run_id: str,
    attempt: Callable[[DataFrame], DataFrame],
    key: str = "utt",
    max_retries: int = MAX_RETRIES,
    chunk: str | None = None,
    task_items: int = TASK_ITEMS,
    place: bool = True,
    slice_items: int = SLICE_ITEMS,
    state: DataFrame | None = None,
    journal: Journal | None = None,
) -> DataFrame:
    """Run passes until nothing is pending (at most `max_retries`); return the log.

    `attempt` turns pending items into records (load, request, `annotate`,
    `result_record`). A pass has a run id of its own and is written in slices of about
    `slice_items` items, one after the other: a lost executor repeats its tasks' calls
    only, a lost driver those of the slice it was in, and goes on from the log. Run ids
    start with the time, so that paths sort as the passes ran. `place=False` leaves the
    placing of the items to `attempt`. `state`, if it is known already, is the resume
    state of the log (see `resume_state`); the log is then not read for the first pass.

    With `journal`, `attempt` gets a journal as its second argument, for `annotate`: what a
    lost task or driver repeats is then no task or slice, but the answers since the last
    file of each task. Answers that earlier runs left there become records of the first pass.
    """
    spark = items.sparkSession
    began = int(time.time() * 1000)
    seen = log_path
    for number in range(max_retries):
        if state is None or number:
            state = resume_state(read_results(spark, seen, _RESUME), key)
        # written once: the log is read and joined a single time per pass, and the
        # pass keeps its items while its own records arrive
        todo = written(pending(items, state, key, max_retries), "pending")
        left = todo.count()
        if not left:
            break
        name, wanted = f"{began:013d}-{number:02d}-{run_id}", todo
        if journal is not None and not number:
            def keep(answers: DataFrame) -> None:
                write_results(result_record(answers, key), log_path, name, chunk if chunk in answers.columns else None)

            todo = take_over(todo, state, journal, key, keep)
            left = todo.count()
        slices = -(-left // slice_items)
        for at in range(slices):
            part, size = todo, left
            if slices > 1:
                part, size = todo.where(_slice_of(todo, key, slices) == at), -(-left // slices)
            part = spread(part, size, task_items, chunk) if place else part
            if journal is None:
                write_results(attempt(part), log_path, name, chunk)
            else:
                own = journal.below(name, at)
                write_results(attempt(part, own), log_path, name, chunk)
                delete_folder(spark, own.folder)
        if journal is not None:
            delete_folder(spark, journal.below(name).folder)
        # every record carries its attempt number, so what a pass wrote tells the new
        # state of its items without the log before it
        items, seen = wanted.drop("retry_attempt"), f"{log_path}/run_id={name}"
    return read_results(spark, log_path)


def _slice_of(items: DataFrame, key: str, slices: int) -> Column:
    """Slice of an item: by key, so that a key that repeats is in one slice."""
    number = F.col(key)
    if isinstance(items.schema[key].dataType, T.LongType):
        number = F.call_function("div", number, F.lit(_STRETCH).cast("bigint"))
    return F.pmod(F.xxhash64(number), F.lit(slices))


def spread(
    items: DataFrame, count: int, task_items: int = TASK_ITEMS, chunk: str | None = None
) -> DataFrame:
    """Even tasks by number of items; rows are small, so their bytes would give too few.

    With `chunk`, a task holds a stretch of few chunks and writes as few files.
    """
    tasks = max(items.sparkSession.sparkContext.defaultParallelism, -(-count // task_items))
    if chunk is None:
        return items.repartition(tasks)
    return items.repartitionByRange(tasks, chunk, *[c for c in items.columns if c != chunk])
