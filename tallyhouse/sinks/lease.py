"""One writer of a table at a time.

A writer takes the table's lease, a hidden file beside it that only one can make. It
names its owner, a number that grows with each lease, and until when it holds; while
the owner works it is renewed. The next writer raises `TableBusy`, unless the time is
over: then one may take the lease on, with a higher number. Writers look at the number
again right before what they did comes to count, so one that was cut off for longer
than its lease raises `LeaseLost` instead of undoing what came after it.
"""

from __future__ import annotations

import os
import socket
import threading
import time
from collections.abc import Iterator
from contextlib import contextmanager
from typing import NamedTuple

from pyspark import InheritableThread
from pyspark.sql import SparkSession

from tallyhouse.folders import Folder

# A lease that nobody renews for so long may be taken on.
LEASE_SECONDS = 600.0


class TableBusy(RuntimeError):
    """Somebody else is writing the table."""


class LeaseLost(RuntimeError):
    """The lease ran out and somebody else has taken it on."""


class Held(NamedTuple):
    number: int
    until: float
    owner: str

    def text(self) -> str:
        return f"{self.number} {self.until} {self.owner}"


def _read(file: Folder) -> Held | None:
    """What the file says; None if it is not there, or being written anew this moment."""
    try:
        number, until, owner = file.text().split(" ", 2)
        return Held(int(number), float(until), owner)
    except Exception:
        return None


class Lease:
    """The right to write one table."""

    def __init__(self, spark: SparkSession, path: str, seconds: float):
        self.spark, self.path, self.seconds = spark, path.rstrip("/"), seconds
        self.file = Folder(spark, path).beside("lease")
        self.owner = f"{socket.gethostname()}:{os.getpid()}:{threading.get_ident()}"
        self.number = 0
        self._done = threading.Event()

    def _now(self) -> Held:
        return Held(self.number, time.time() + self.seconds, self.owner)

    def take(self) -> None:
        self.number = time.time_ns()
        if not self.file.create(self._now().text()):
            held = _read(self.file)
            if held is None or held.until > time.time():
                by = held.owner if held else "somebody"
                raise TableBusy(f"{self.path} is being written by {by}; its lease is {self.file.path}")
            # Of several who find that it ran out, the one who makes this file takes it on.
            claim = Folder(self.spark, f"{self.file.path}.after-{held.number}")
            if not claim.create(self.owner):
                raise TableBusy(f"the lease {self.file.path} is being taken on; see {claim.path}")
            try:
                # It may have been taken on, and the file made for that removed, since we looked.
                if (now := _read(self.file)) is None or now.number != held.number:
                    raise TableBusy(f"the lease {self.file.path} has been taken on")
                self.number = max(self.number, held.number + 1)
                self.file.overwrite(self._now().text())
            finally:
                claim.delete()
        InheritableThread(target=self._renew, daemon=True).start()

    def _renew(self) -> None:
        while not self._done.wait(self.seconds / 3):
            try:
                self.check()
                self.file.overwrite(self._now().text())
            except LeaseLost:
                return

    def check(self) -> None:
        """Raise `LeaseLost` unless the lease is still this one."""
        held = _read(self.file)
        if held is None:
            # Renewed this moment, perhaps.
            time.sleep(0.2)
            held = _read(self.file)
        if held is None or held.number != self.number:
            raise LeaseLost(f"somebody else has taken on the lease of {self.path}")

    def release(self) -> None:
        self._done.set()
        held = _read(self.file)
        if held is not None and held.number == self.number:
            self.file.delete()


_leases = threading.local()


@contextmanager
def writing(
    spark: SparkSession, path: str, seconds: float | None = None
) -> Iterator[Lease]:
    """Hold the lease of the table at `path`; within it, the same thread may ask again."""
    mine: dict[str, Lease] = _leases.__dict__.setdefault("held", {})
    key = path.rstrip("/")
    if key in mine:
        yield mine[key]
        return
    lease = Lease(spark, path, LEASE_SECONDS if seconds is None else seconds)
    lease.take()
    mine[key] = lease
    try:
        yield lease
    finally:
        del mine[key]
        lease.release()
