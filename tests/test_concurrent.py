"""What independent jobs ask of the driver: few at a time, and nothing kept of the steps that are done."""

from __future__ import annotations

import re
import threading
import time
from concurrent.futures import ThreadPoolExecutor

from strataline.plans import concurrent, silver, snapshots
from strataline.plans.concurrent import WIDTH, run_all
from strataline.plans.snapshots import run_incremental
from strataline.session import _give_back, free_unused
from strataline.sources.store import LayerStore


class Counted(ThreadPoolExecutor):
    """Counts the jobs that all pools run at a time."""

    now, most, lock = 0, 0, threading.Lock()

    def submit(self, fn, /, *args, **kwargs):
        def job():
            with Counted.lock:
                Counted.now += 1
                Counted.most = max(Counted.most, Counted.now)
            try:
                return fn(*args, **kwargs)
            finally:
                with Counted.lock:
                    Counted.now -= 1

        return super().submit(job)


def test_few_jobs_go_on_at_a_time(monkeypatch):
    monkeypatch.setattr(concurrent, "ThreadPoolExecutor", Counted)
    monkeypatch.setattr(Counted, "most", 0)
    assert run_all([lambda i=i: time.sleep(0.05) or i for i in range(9)]) == list(range(9))
    assert Counted.most == WIDTH == 2


def test_a_whole_run_keeps_to_few_jobs_and_frees_its_steps(spark, feed, tmp_path, monkeypatch):
    freed = []
    monkeypatch.setattr(concurrent, "ThreadPoolExecutor", Counted)
    monkeypatch.setattr(Counted, "most", 0)
    for module in (snapshots, silver):
        monkeypatch.setattr(module, "free_unused", freed.append)
    summary = run_incremental(LayerStore(spark, str(tmp_path / "store")), feed)
    assert summary.processed == list(feed) and len(freed) >= 4 * len(feed)
    # The merge of cumulative bronze and the star schema had jobs of their own beside each other.
    assert 0 < Counted.most <= WIDTH


def test_finished_shuffles_are_let_go(spark):
    def shuffles() -> set[str]:
        held = spark.sparkContext._jsc.sc().env().mapOutputTracker().shuffleStatuses().keySet().toString()
        return set(re.findall(r"\d+", held))

    before = shuffles()
    queries = [spark.range(100).repartition(3 + n, "id").groupBy("id").count() for n in range(5)]
    assert [len(q.collect()) for q in queries] == [100] * 5
    made = shuffles() - before
    assert made
    queries.clear()
    # What a collection finds is cleaned beside it, and what that held goes with the next one.
    for _ in range(10):
        free_unused(spark)
        time.sleep(0.5)
    assert not made & shuffles()


def test_native_memory_is_given_back(spark):
    # Any JVM from 17.0.9 on with glibc can.
    assert _give_back(spark)
