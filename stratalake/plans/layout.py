"""Where the tables of one warehouse live, under a root folder on shared storage."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime


@dataclass(frozen=True)
class Layout:
    root: str
    buckets: int = 64
    key_digits: int = 2

    def keys(self, name: str) -> str:
        """Which keys a table holds (see ``sinks.key_state``)."""
        return f"{self.root}/keys/{name}"

    def raw(self, name: str) -> str:
        return f"{self.root}/raw/{name}"

    def cleaned(self, name: str) -> str:
        return f"{self.root}/cleaned/{name}"

    def rejects(self, name: str) -> str:
        return f"{self.root}/rejects/{name}"

    def rejects_of(self, name: str, as_of: datetime) -> str:
        """The rejects of one day's runs: written whole by each, so a rerun leaves none of an earlier one."""
        return f"{self.rejects(name)}/run_date={as_of:%Y-%m-%d}"

    def star(self, name: str) -> str:
        return f"{self.root}/star/{name}"

    def staging(self, name: str) -> str:
        return f"{self.root}/staging/{name}"

    @property
    def metrics(self) -> str:
        return f"{self.root}/metrics"
