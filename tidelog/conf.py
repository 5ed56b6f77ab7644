"""Configuration: environment first, then a TOML or YAML file, then the default."""

from __future__ import annotations

import os
import tomllib
from typing import Any

# Defaults of properties.
DEFAULTS: dict[str, Any] = {
    "postgresql.publication.name": "pg_ts_streamer", "postgresql.publication.create": True, "postgresql.publication.autodrop": True, "postgresql.snapshot.initial": "never", "postgresql.snapshot.batchsize": 1000,
    "postgresql.transaction.window.enabled": True, "postgresql.transaction.window.timeout": 60, "postgresql.transaction.window.maxsize": 10000, "sink.type": "stdout", "sink.tombstone": False,
    "statestorage.type": "none", "topic.namingstrategy.type": "debezium", "internal.snapshotter.parallelism": 5, "postgresql.events.read": True, "postgresql.events.insert": True, "postgresql.events.update": True,
    "postgresql.events.delete": True, "postgresql.events.truncate": True, "postgresql.events.message": True,
}


def env_name(prop: str) -> str:
    """a.b_c -> A_B__C."""
    return prop.upper().replace("_", "__").replace(".", "_")


def load(path: str) -> dict[str, Any]:
    with open(path, "rb") as f:
        data = f.read()
    if path.endswith((".yml", ".yaml")):
        import yaml

        return yaml.safe_load(data) or {}
    return tomllib.loads(data.decode())


class Config:
    def __init__(self, tree: dict[str, Any] | None = None, env: dict[str, str] | None = None):
        self.tree, self.env = tree or {}, os.environ if env is None else env

    def get(self, prop: str, default: Any = None) -> Any:
        """The property's value; zero values count as unset. Text from the environment takes the default's type."""
        default = DEFAULTS.get(prop) if default is None else default
        text = self.env.get(env_name(prop))
        if text:
            return text.lower() in ("1", "true", "yes") if isinstance(default, bool) else type(default)(text) if isinstance(default, (int, float)) else text
        at: Any = self.tree
        for part in prop.split("."):
            at = at.get(part) if isinstance(at, dict) else None
        return default if at in (None, "", 0) and not isinstance(at, bool) else at

    def switches(self, family: str = "postgresql") -> dict[str, bool]:
        return {op: bool(self.get(f"{family}.events.{name}", True)) for op, name in (("r", "read"), ("c", "insert"), ("u", "update"), ("d", "delete"), ("t", "truncate"), ("m", "message"))}
