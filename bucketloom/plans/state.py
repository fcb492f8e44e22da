"""The checkpoint: which buckets are done, by which writer, and how far they are done without a gap.

A small SQLite file on the driver. Rows are kept by writer, so two writers never overwrite each other's status. A writer's
frontier is seeded before its first bucket, so a failed first bucket holds it back like any other.
"""

from __future__ import annotations

import sqlite3
from contextlib import contextmanager
from datetime import UTC, datetime, timedelta

from bucketloom.model import Granularity, TimeRange

CLAIMED, COMMITTED, FAILED = "claimed", "committed", "failed"

_TABLES = """
CREATE TABLE IF NOT EXISTS bucket (signal TEXT, granularity TEXT, writer TEXT, start INTEGER, status TEXT NOT NULL, lease_until INTEGER,
  claimed_at INTEGER, committed_at INTEGER, records INTEGER, attempts INTEGER NOT NULL DEFAULT 0, error TEXT, PRIMARY KEY (signal, granularity, writer, start));
CREATE TABLE IF NOT EXISTS frontier (signal TEXT, granularity TEXT, writer TEXT, next_start INTEGER NOT NULL, PRIMARY KEY (signal, granularity, writer));
CREATE INDEX IF NOT EXISTS by_status ON bucket (signal, granularity, status);
"""


def _epoch(t: datetime) -> int:
    return int(t.timestamp())


def _at(s: int) -> datetime:
    return datetime.fromtimestamp(s, UTC)


class Checkpoint:
    def __init__(self, path: str, lease: timedelta = timedelta(hours=1)):
        self.db = sqlite3.connect(path, isolation_level=None)
        self.db.row_factory = sqlite3.Row
        if path != ":memory:":
            self.db.execute("PRAGMA journal_mode=WAL")
        self.db.execute("PRAGMA synchronous=FULL")
        self.db.executescript(_TABLES)
        self.lease = lease

    @contextmanager
    def _transaction(self):
        self.db.execute("BEGIN IMMEDIATE")
        try:
            yield
        except BaseException:
            self.db.execute("ROLLBACK")
            raise
        self.db.execute("COMMIT")

    def _row(self, s: str, g: Granularity, writer: str, start: datetime):
        return self.db.execute("SELECT * FROM bucket WHERE signal=? AND granularity=? AND writer=? AND start=?", (s, g.name, writer, _epoch(start))).fetchone()

    def frontier(self, s: str, g: Granularity, writer: str) -> datetime | None:
        r = self.db.execute("SELECT next_start FROM frontier WHERE signal=? AND granularity=? AND writer=?", (s, g.name, writer)).fetchone()
        return _at(r[0]) if r else None

    def frontiers(self) -> list[dict]:
        return [dict(r) for r in self.db.execute("SELECT * FROM frontier ORDER BY signal, granularity, writer")]

    def seed(self, s: str, g: Granularity, writer: str, start: datetime) -> datetime:
        """The frontier, which is put at ``start`` where there is none."""
        self.db.execute("INSERT OR IGNORE INTO frontier VALUES (?, ?, ?, ?)", (s, g.name, writer, _epoch(start)))
        return self.frontier(s, g, writer)

    def status(self, s: str, g: Granularity, writer: str, start: datetime) -> str | None:
        r = self._row(s, g, writer, start)
        return r["status"] if r else None

    def attempts(self, s: str, g: Granularity, writer: str, start: datetime) -> int:
        r = self._row(s, g, writer, start)
        return r["attempts"] if r else 0

    def buckets(self, s: str, g: Granularity, status: str | None = None) -> list[dict]:
        q, args = "SELECT * FROM bucket WHERE signal=? AND granularity=?", [s, g.name]
        if status:
            q, args = q + " AND status=?", [*args, status]
        return [dict(r) for r in self.db.execute(q + " ORDER BY start, writer", args)]

    def claim(self, s: str, g: Granularity, writer: str, bucket: TimeRange, now: datetime) -> bool:
        """False if this writer has committed it or another run's lease on it still holds."""
        with self._transaction():
            r = self._row(s, g, writer, bucket.start)
            if r and (r["status"] == COMMITTED or r["status"] == CLAIMED and r["lease_until"] > _epoch(now)):
                return False
            self.db.execute(
                "INSERT INTO bucket (signal, granularity, writer, start, status, lease_until, claimed_at, attempts) VALUES (?,?,?,?,?,?,?,1) "
                "ON CONFLICT DO UPDATE SET status=excluded.status, lease_until=excluded.lease_until, claimed_at=excluded.claimed_at, attempts=attempts+1, error=NULL",
                (s, g.name, writer, _epoch(bucket.start), CLAIMED, _epoch(now + self.lease), _epoch(now)),
            )
            return True

    def commit(self, s: str, g: Granularity, writer: str, bucket: TimeRange, now: datetime, records: int) -> None:
        with self._transaction():
            self.db.execute(
                "UPDATE bucket SET status=?, committed_at=?, records=?, lease_until=NULL, error=NULL WHERE signal=? AND granularity=? AND writer=? AND start=?",
                (COMMITTED, _epoch(now), records, s, g.name, writer, _epoch(bucket.start)),
            )
            self._advance(s, g, writer, _epoch(bucket.start))

    def fail(self, s: str, g: Granularity, writer: str, bucket: TimeRange, error: str) -> None:
        self.db.execute("UPDATE bucket SET status=?, lease_until=NULL, error=? WHERE signal=? AND granularity=? AND writer=? AND start=?", (FAILED, error[:500], s, g.name, writer, _epoch(bucket.start)))

    def _advance(self, s: str, g: Granularity, writer: str, start: int) -> None:
        """Over the unbroken run of committed buckets from the frontier on: up to the first start that isn't followed by its neighbour."""
        self.db.execute("INSERT OR IGNORE INTO frontier VALUES (?, ?, ?, ?)", (s, g.name, writer, start))
        at = self.db.execute("SELECT next_start FROM frontier WHERE signal=? AND granularity=? AND writer=?", (s, g.name, writer)).fetchone()[0]
        for (done,) in self.db.execute("SELECT start FROM bucket WHERE signal=? AND granularity=? AND writer=? AND status=? AND start>=? ORDER BY start", (s, g.name, writer, COMMITTED, at)).fetchall():
            if done != at:
                break
            at += g.seconds
        self.db.execute("UPDATE frontier SET next_start=? WHERE signal=? AND granularity=? AND writer=?", (at, s, g.name, writer))

    def reset(self, signal: str | None = None, bucket: TimeRange | None = None) -> None:
        """Forgets checkpoints; only for runs that also rewrite the data."""
        where, args = ("WHERE signal=?", [signal]) if signal else ("", [])
        with self._transaction():
            if bucket is not None:
                w = f"{where} {'AND' if where else 'WHERE'} start>=? AND start<?"
                self.db.execute(f"DELETE FROM bucket {w}", [*args, _epoch(bucket.start), _epoch(bucket.end)])
            else:
                self.db.execute(f"DELETE FROM bucket {where}", args)
                self.db.execute(f"DELETE FROM frontier {where}", args)

    def close(self) -> None:
        self.db.close()
