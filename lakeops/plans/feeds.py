"""Several feeds at once, each tried twice within a time limit, one status row per feed."""

from __future__ import annotations

import threading
import time
import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

STATUS = "feed string, status string, attempts int, seconds double, error string"
LOADED, FAILED, TIMED_OUT = "loaded", "failed", "timed out"


class FeedsFailed(Exception):
    """Some feeds failed or ran out of time; ``status`` has one row per feed."""

    def __init__(self, names: list[str], status: DataFrame):
        super().__init__(f"feeds failed: {', '.join(names)}")
        self.status = status


@dataclass
class _Attempt:
    status: str
    error: str | None = None
    ended: bool = True


def run_feeds(
    spark: SparkSession, feeds: Iterable[str], load: Callable[[str], object], at_once: int = 10, retries: int = 1,
    limit: float = 600, grace: float = 60,
) -> DataFrame:
    """Call ``load(feed)`` for every feed; Spark runs their jobs side by side.

    The jobs of an attempt carry a tag of their own. An attempt that takes more than ``limit``
    seconds has its jobs cancelled by that tag, those it starts later too, and is tried again once
    it has ended. One that has not ended ``grace`` seconds after its limit, because it hangs outside of
    Spark, is not tried again, so two attempts of a feed never write side by side; whatever jobs it
    still starts are cancelled. A feed that fails, or is ended, does not stop the others, but is
    reported at the end. ``seconds`` are those of all attempts of a feed.
    """
    feeds = list(feeds)

    def tried(feed: str, target: Callable[[str, _Attempt], None]) -> tuple[str, str, int, float, str | None]:
        begun = time.monotonic()
        for tries in range(1, retries + 2):
            done = _within(spark, target, f"{feed} took more than {limit:g} s", limit, grace)
            if done.status == LOADED or not done.ended:
                break
        return feed, done.status, tries, round(time.monotonic() - begun, 3), done.error

    def attempt_of(feed: str) -> Callable[[str, _Attempt], None]:
        # wrapped here, so that a feed's thread has the caller's local properties (pool, description)
        @inheritable_thread_target(spark)
        def attempt(tag: str, found: _Attempt) -> None:
            spark.sparkContext.addJobTag(tag)
            try:
                load(feed)
                found.status = LOADED
            except Exception as failure:
                found.error = f"{type(failure).__name__}: {failure}"
            finally:
                spark.sparkContext.removeJobTag(tag)
        return attempt

    targets = [attempt_of(feed) for feed in feeds]
    with ThreadPoolExecutor(max_workers=at_once) as pool:
        rows = list(pool.map(tried, feeds, targets))
    status = spark.createDataFrame(rows, STATUS)
    failed = [r[0] for r in rows if r[1] != LOADED]
    if failed:
        raise FeedsFailed(failed, status)
    return status


def _within(spark: SparkSession, run: Callable[[str, _Attempt], None], message: str, limit: float, grace: float) -> _Attempt:
    """Run one attempt in a thread of its own and end its jobs when it takes too long."""
    tag, found = f"attempt-{uuid.uuid4().hex}", _Attempt(FAILED)
    thread = threading.Thread(target=run, args=(tag, found), daemon=True)
    thread.start()
    thread.join(limit)
    if not thread.is_alive():
        return found
    _cancel_until_ended(spark, tag, thread, grace)
    if thread.is_alive():
        threading.Thread(target=_cancel_until_ended, args=(spark, tag, thread, None), daemon=True).start()
    # what the attempt still reports is about its cancelled jobs
    return _Attempt(TIMED_OUT, message, not thread.is_alive())


def _cancel_until_ended(spark: SparkSession, tag: str, thread: threading.Thread, most: float | None) -> None:
    begun = time.monotonic()
    while thread.is_alive() and (most is None or time.monotonic() - begun < most):
        spark.sparkContext.cancelJobsWithTag(tag)
        thread.join(0.2)
