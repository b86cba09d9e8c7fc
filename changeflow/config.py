"""Configuration: files, environment and flags; flags go before the environment, that before the file."""

from __future__ import annotations

import os
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from changeflow.operators.routing import Router
from changeflow.operators.rules import RuleEngine

PREFIX = "CHANGEFLOW_"


def _yaml(path: str) -> dict:
    import yaml

    with open(path, encoding="utf-8") as f:
        return yaml.safe_load(f) or {}


def load_rules(path: str) -> RuleEngine:
    """Rules by table under the key ``tables``, which must be there."""
    config = _yaml(path)
    if "tables" not in config:
        raise ValueError(f"{path} has no tables")
    return RuleEngine(config["tables"])


def load_routes(path: str) -> Router:
    return Router(_yaml(path))


@dataclass
class Settings:
    """Settings of both commands, under their names with ``-`` for ``_`` in files and flags."""

    group: str = ""
    mode: str = "stream"
    schema: str = "public"
    tables: list[str] = field(default_factory=list)
    host: str = ""
    port: int = 5432
    dbname: str = ""
    user: str = ""
    password: str = ""
    copy: bool = False
    copy_and_stream: bool = False
    max_copy_workers_per_table: int = 4
    track_ddl: bool = False
    log_dir: str = ""
    source_dir: str = ""
    starting_lsn: str = ""
    sslmode: str = "disable"
    spool_dir: str = ""
    log_retention: str = ""
    log_archive_dir: str = ""
    checkpoint_dir: str = ""
    keys_config: str = ""
    batch_size: int = 1000
    rules_config: str = ""
    routing_config: str = ""
    file_output_dir: str = "/tmp/changeflow-output"
    table_output_dir: str = ""
    target_host: str = ""
    target_port: int = 5432
    target_dbname: str = ""
    target_user: str = ""
    target_password: str = ""
    target_sync_schema: bool = False
    target_disable_foreign_keys: bool = False
    webhook_url: str = ""
    once: bool = False

    def require(self, names: Sequence[str]) -> None:
        if missing := [n for n in names if not getattr(self, n)]:
            raise ValueError("required: " + ", ".join(n.replace("_", "-") for n in missing))


#: What each command cannot do without.
REQUIRED = {"replicator": ("group", "log_dir"), "stdout": ("group", "log_dir"), "file": ("group", "log_dir"), "table": ("group", "log_dir", "table_output_dir"), "postgres": ("group", "log_dir", "target_host", "target_dbname", "target_user"), "webhook": ("group", "log_dir", "webhook_url")}


def _as(kind: type, value: object) -> object:
    if kind is bool:
        return value if isinstance(value, bool) else str(value).lower() in ("1", "t", "true")
    if kind is list:
        return [v.strip() for v in value.split(",") if v.strip()] if isinstance(value, str) else list(value or ())
    return kind(value)


def settings(flags: Mapping[str, object] | None = None, path: str | None = None, env: Mapping[str, str] | None = None) -> Settings:
    """Settings from flags that are given, variables with PREFIX, and a file."""
    env = os.environ if env is None else env
    file = {k.replace("-", "_"): v for k, v in (_yaml(path) if path else {}).items()}
    out = Settings()
    for name, default in vars(Settings()).items():
        kind = type(default)
        for found in ((flags or {}).get(name), env.get(PREFIX + name.upper()), file.get(name)):
            if found is not None and found != "":
                setattr(out, name, _as(kind, found))
                break
    return out
