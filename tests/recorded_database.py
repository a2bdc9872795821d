"""A stand-in for a database connection: what is called is written to a file, one line each."""

from __future__ import annotations

import json
import os


class Recorded:
    def __init__(self, calls: str, refuse: str = ""):
        self.calls, self.refuse = calls, refuse

    def _note(self, *call):
        line = json.dumps([os.getpid(), id(self), *call], default=str) + "\n"
        handle = os.open(self.calls, os.O_WRONLY | os.O_APPEND | os.O_CREAT)
        os.write(handle, line.encode())
        os.close(handle)

    def cursor(self):
        return self

    def execute(self, statement, values=()):
        self._note("execute", statement, list(values))
        if self.refuse and self.refuse in statement:
            raise RuntimeError("refused")

    def executemany(self, statement, rows):
        self._note("executemany", statement, [list(row) for row in rows])
        if self.refuse and any(self.refuse in row for row in rows):
            raise RuntimeError("refused")

    def commit(self):
        self._note("commit")

    def rollback(self):
        self._note("rollback")

    def close(self):
        self._note("close")


def connect(**settings):
    return Recorded(**settings)
