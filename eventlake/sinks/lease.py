"""Leases: small files that say a job is alive.

A lease is renewed from a thread while its job runs, so that one which has not been renewed for
TTL seconds belongs to a job that was killed. On file systems that cannot create a file
exclusively, two jobs that start in the same moment may both get one.
"""

import threading
import time
import uuid
from contextlib import suppress

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

from eventlake.sources.folders import create, read_text, remove, seconds_old, touch

#: Seconds after which a lease that nobody renews is over; how long to wait for one.
TTL, PATIENCE = 300.0, 6 * 3600.0


class LeaseTaken(RuntimeError):
    """Another job kept its lease for longer than this one was willing to wait."""


def alive(spark: SparkSession, path: str) -> bool:
    age = seconds_old(spark, path)
    return age is not None and age < TTL


class Lease:
    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path
        self.owner = uuid.uuid4().hex
        self.over = threading.Event()

    def __enter__(self) -> "Lease":
        until = time.monotonic() + PATIENCE
        while not create(self.spark, self.path, self.owner):
            if not alive(self.spark, self.path):
                remove(self.spark, self.path)
            elif time.monotonic() > until:
                raise LeaseTaken(self.path)
            else:
                time.sleep(min(1.0, TTL / 10))
        self.thread = threading.Thread(target=self._renew, daemon=True)
        self.thread.start()
        return self

    def _renew(self) -> None:
        while not self.over.wait(TTL / 5):
            # A run that ends removes its folder, and the lease with it.
            with suppress(Py4JJavaError):
                touch(self.spark, self.path)

    def __exit__(self, *_) -> None:
        self.over.set()
        self.thread.join()
        if seconds_old(self.spark, self.path) is not None and self._mine():
            remove(self.spark, self.path)

    def _mine(self) -> bool:
        return read_text(self.spark, self.path) == self.owner
