"""Settings from YAML: a base section, overlaid by a step's section and a named pipeline step's."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, fields
from typing import Any

from docloom.errors import ConfigError
from docloom.functions.ports import Throttle


@dataclass(frozen=True)
class Settings:
    """What every step knows, and its own ``options``."""

    name: str
    load_type: str = "FULL"
    source: Mapping[str, Any] = field(default_factory=dict)
    output: Mapping[str, Any] = field(default_factory=dict)
    force: bool = False
    modified: str | None = None
    options: Mapping[str, Any] = field(default_factory=dict)


def overlay(*sections: Mapping[str, Any] | None) -> dict[str, Any]:
    """Later sections win; mappings merge."""
    out: dict[str, Any] = {}
    for section in sections:
        for k, v in (section or {}).items():
            out[k] = overlay(out[k], v) if isinstance(v, Mapping) and isinstance(out.get(k), Mapping) else v
    return out


def step_settings(config: Mapping[str, Any], step: str, name: str | None = None) -> Settings:
    values = overlay(config.get("base"), config.get(step), next((s for s in config.get("pipeline", ()) if s.get("name") == name), None) if name else None)
    known = {f.name for f in fields(Settings)} - {"options"}
    if values.get("load_type", "FULL").upper() not in ("FULL", "DELTA", "INCREMENTAL"):
        raise ConfigError(f"unknown load type: {values['load_type']}")
    return Settings(**{k: v for k, v in values.items() if k in known} | {"name": values.get("name", name or step)}, options={k: v for k, v in values.items() if k not in known})


def by_name(items: Sequence[Mapping[str, Any]]) -> dict[str, Mapping[str, Any]]:
    """A list of named configurations as a dict."""
    if any("name" not in x for x in items):
        raise ConfigError("every entry needs a name")
    return {x["name"]: x for x in items}


def deployment(items: Sequence[Mapping[str, Any]], name: str, model: str | None = None) -> Mapping[str, Any]:
    """By deployment name, else by model; a deployment of another model is an error."""
    named = by_name(items)
    found = named.get(name) or next((x for x in items if x.get("model") == (model or name)), None)
    if found is None:
        raise ConfigError(f"unknown deployment: {name}")
    if model and found.get("model") != model:
        raise ConfigError(f"{name} deploys {found.get('model')}, not {model}")
    return found


def quota(found: Mapping[str, Any]) -> Throttle:
    """The pace of a deployment: its tokens a minute, and six requests a minute for every thousand of them unless it names its own."""
    tokens = float(found.get("tpm") or math.inf)
    return Throttle(requests_per_minute=float(found.get("rpm") or tokens / 1000 * 6), tokens_per_minute=tokens, attempts=int(found.get("attempts", 5)), cool_down=float(found.get("cool_down", 60)))


def read_config(path: str) -> dict[str, Any]:
    import yaml

    with open(path, encoding="utf-8") as text:
        return yaml.safe_load(text) or {}
