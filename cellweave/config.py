"""Run configuration: a nested YAML file, checked against a table of variables, passed as a value."""

from __future__ import annotations

import csv
from collections.abc import Mapping
from dataclasses import dataclass, field
from types import MappingProxyType

import yaml


@dataclass(frozen=True)
class Config:
    """Settings by their leaf name; `sections` keeps where each came from."""

    values: Mapping[str, object]
    sections: Mapping[str, str] = field(default_factory=dict)

    def __getitem__(self, name: str) -> object:
        return self.values[name]

    def get(self, name: str, default: object = None) -> object:
        return self.values.get(name, default)


def flattened(tree: Mapping, above: str = "") -> dict[str, tuple[str, object]]:
    """Leaf name to (path, value). A leaf name that occurs twice is an error, since one would hide the other."""
    found: dict[str, tuple[str, object]] = {}
    for name, value in tree.items():
        path = f"{above}.{name}" if above else str(name)
        leaves = flattened(value, path) if isinstance(value, Mapping) else {str(name): (path, value)}
        for leaf, item in leaves.items():
            if leaf in found:
                raise ValueError(f"{leaf} is set at {found[leaf][0]} and at {item[0]}")
            found[leaf] = item
    return found


def read_variables(path: str) -> list[dict[str, str]]:
    """Rows of the table of variables: variable, required, default_value, split_string."""
    with open(path, newline="", encoding="utf-8-sig") as f:
        return list(csv.DictReader(f))


def validated(leaves: Mapping[str, object], variables: list[Mapping[str, str]]) -> dict[str, object]:
    """leaves with defaults filled in and lists split; a missing required variable is an error, all of them named."""
    true = {"true", "t", "yes", "1"}
    values = dict(leaves)
    missing = []
    for v in variables:
        name, given = v["variable"], values.get(v["variable"])
        if given is None or given == "":
            if str(v.get("required", "")).lower() in true:
                missing.append(name)
                continue
            given = v.get("default_value") or None
        if isinstance(given, str) and str(v.get("split_string", "")).lower() in true:
            given = [part.strip() for part in given.split(",")]
        values[name] = given
    if missing:
        raise ValueError(f"required settings are missing: {', '.join(missing)}")
    return values


def load(path: str, variables: list[Mapping[str, str]] | None = None) -> Config:
    """The configuration of a YAML file."""
    with open(path, encoding="utf-8") as f:
        leaves = flattened(yaml.safe_load(f) or {})
    values = {k: v for k, (_, v) in leaves.items()}
    return Config(MappingProxyType(validated(values, variables or [])), MappingProxyType({k: p for k, (p, _) in leaves.items()}))


def merged(master: Mapping, project: Mapping) -> dict:
    """The master tree with the project's values wherever it sets them; settings the master no longer has are dropped."""
    return {
        k: merged(v, project.get(k) or {}) if isinstance(v, Mapping) else (project[k] if k in project else v) for k, v in master.items()
    }


def dumped(settings: Mapping[str, object], path: str) -> None:
    """Settings as a YAML file, in the order given."""
    with open(path, "w", encoding="utf-8") as f:
        yaml.safe_dump(dict(settings), f, sort_keys=False)
