"""State: offsets, watermarks and named values, in memory or in a JSON file that is replaced atomically."""

from __future__ import annotations

import json
import os
import tempfile
from dataclasses import asdict, dataclass, field
from typing import Any


@dataclass
class Offset:
    lsn: int = 0
    timestamp: str | None = None
    snapshot: bool = False
    snapshot_done: bool = False
    snapshot_name: str | None = None
    snapshot_offset: int = 0
    snapshot_keyset: list[Any] | None = None


@dataclass
class Watermark:
    complete: bool = False
    high: list[Any] | None = None
    low: list[Any] | None = None


@dataclass
class Snapshot:
    name: str
    tables: dict[str, Watermark] = field(default_factory=dict)

    def watermark(self, table: str) -> Watermark:
        return self.tables.setdefault(table, Watermark())


class MemoryState:
    def __init__(self):
        self.offsets: dict[str, Offset] = {}
        self.values: dict[str, Any] = {}
        self.snapshots: dict[str, Snapshot] = {}

    def set_offset(self, slot: str, offset: Offset) -> None:
        """Positions never go back."""
        if slot not in self.offsets or offset.lsn >= self.offsets[slot].lsn:
            self.offsets[slot] = offset

    def with_snapshot(self, name: str, change, create: bool = True) -> Snapshot:
        if name not in self.snapshots and not create:
            raise KeyError(name)
        found = self.snapshots.setdefault(name, Snapshot(name))
        change(found)
        return found

    def load(self) -> None: ...

    def save(self) -> None: ...


class FileState(MemoryState):
    def __init__(self, path: str):
        super().__init__()
        self.path = path

    def load(self) -> None:
        if os.path.exists(self.path):
            with open(self.path) as f:
                d = json.load(f)
            self.offsets = {k: Offset(**v) for k, v in d["offsets"].items()}
            self.values = d["values"]
            self.snapshots = {k: Snapshot(k, {t: Watermark(**w) for t, w in v.items()}) for k, v in d["snapshots"].items()}

    def save(self) -> None:
        d = {"offsets": {k: asdict(v) for k, v in self.offsets.items()}, "values": self.values, "snapshots": {k: {t: asdict(w) for t, w in v.tables.items()} for k, v in self.snapshots.items()}}
        fd, tmp = tempfile.mkstemp(dir=os.path.dirname(os.path.abspath(self.path)))
        with os.fdopen(fd, "w") as f:
            json.dump(d, f)
        os.replace(tmp, self.path)


STORES = {"none": lambda **_: MemoryState(), "file": lambda path, **_: FileState(path)}
