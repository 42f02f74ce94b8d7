"""Settings of jobs: known names, redaction, names of files."""

from __future__ import annotations

import os

# Parts of names of settings that must not be shown.
SENSITIVE = "password secret token key credential"


def redact(data, depth: int = 10):
    """A copy with the values of sensitive keys replaced by ``***``, at any depth up to ``depth``."""
    if depth < 0:
        return data
    if isinstance(data, dict):
        return {k: "***" if any(s in str(k).lower() for s in SENSITIVE.split()) else redact(v, depth - 1) for k, v in data.items()}
    if isinstance(data, list):
        return [redact(v, depth - 1) for v in data]
    return data


def graph_name(prefix: str, parts: list[str]) -> str:
    """prefix_A_B."""
    return "_".join([prefix, *parts])


def feature_windows(env: dict[str, str] | None = None) -> dict[str, int]:
    """Window sizes of the feature jobs: ROLLING_WINDOW, HEAD_WINDOW and TAIL_WINDOW of the environment, else 5, 10 and 10."""
    known = os.environ if env is None else env
    return {name: int(known.get(f"{name.upper()}_WINDOW", default)) for name, default in (("rolling", 5), ("head", 10), ("tail", 10))}
