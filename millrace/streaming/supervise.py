"""Keep an application alive while its queries run."""

from __future__ import annotations

import logging
import time
from collections.abc import Callable, Mapping, Sequence
from contextlib import suppress

from pyspark.errors import StreamingQueryException
from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

log = logging.getLogger(__name__)

#: Seconds after which the other queries are looked at again.
LOOK = 0.5


def supervise(spark: SparkSession, queries: Sequence[StreamingQuery], timeout: float | None = None) -> None:
    """Wait until any of ``queries`` fails or all have ended, or until ``timeout`` seconds have passed.

    A failure stops the others and is raised, with a timeout as without; at the timeout all run on. Queries that are
    not given are none of its business. Waiting for one query after the other would miss a failure in a later one.
    """
    deadline = None if timeout is None else time.monotonic() + timeout
    try:
        while True:
            active = [query for query in queries if query.isActive]
            for query in queries:
                if failure := query.exception():
                    raise failure
            if not active:
                return
            left = LOOK if deadline is None else min(LOOK, deadline - time.monotonic())
            if left <= 0:
                return
            active[0].awaitTermination(left)
    except BaseException:
        _stop(queries)
        raise


def _stop(queries: Sequence[StreamingQuery]) -> None:
    for query in queries:
        if query.isActive:
            query.stop()


def keep_running(
    starts: Mapping[str, Callable[[], StreamingQuery]],
    restarts: int = 3,
    wait: float = 1.0,
    healthy: float = 600.0,
    timeout: float | None = None,
) -> dict[str, int]:
    """Start queries and start each again that fails, from its checkpoint, while the others run on.

    ``starts`` makes and starts the query of each name, with the same checkpoint every time. A query may fail
    ``restarts`` times; it waits ``wait`` seconds before the first restart and twice as long before each further one.
    One that has run for ``healthy`` seconds since has all its restarts again. One failure more stops all queries and
    is raised. Ends when all queries have ended, or after ``timeout`` seconds, with the restarts of each query.
    """
    deadline = None if timeout is None else time.monotonic() + timeout
    running: dict[str, StreamingQuery] = {}
    since: dict[str, float] = {}
    due = {name: time.monotonic() for name in starts}
    failed, total, ended = dict.fromkeys(starts, 0), dict.fromkeys(starts, 0), set()
    try:
        while len(ended) < len(starts):
            now = time.monotonic()
            for name, at in list(due.items()):
                if at <= now:
                    del due[name]
                    running[name], since[name] = starts[name](), now
            for name, query in list(running.items()):
                if query.isActive:
                    continue
                failure = query.exception()
                del running[name]
                if failure is None:
                    ended.add(name)
                    continue
                failed[name] = 1 if now - since[name] >= healthy else failed[name] + 1
                if failed[name] > restarts:
                    raise failure
                total[name] += 1
                due[name] = now + wait * 2 ** (failed[name] - 1)
                log.warning("query %s failed, restart %s of %s", name, failed[name], restarts)
            if deadline is not None and now >= deadline:
                break
            if running:
                with suppress(StreamingQueryException):  # looked at above
                    next(iter(running.values())).awaitTermination(LOOK)
            elif due:
                time.sleep(min(LOOK, max(0.0, min(due.values()) - time.monotonic())))
    except BaseException:
        _stop(list(running.values()))
        raise
    return total
