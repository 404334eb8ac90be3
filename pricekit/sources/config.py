"""Job configuration: a small JSON document read on the driver.

Shape (every job reads only its own keys)::

    {"input":  {"<name>": {"catalog_name": ..., "schema": ..., "table_name": ...} | {"path": ..., "format": ...}},
     "output": {"<name>": {...same...}},
     "basic_config": {"countries": [...], "emea_countries": [...], "ams_countries": [...]},
     "rules": [[table, column, metric, op, threshold, severity], ...]}
"""

from __future__ import annotations

import json
from pathlib import Path
from typing import Any


def load_config(path: str | Path) -> dict[str, Any]:
    with open(path, encoding="utf-8") as fh:
        config = json.load(fh)
    for section in ("input", "output"):
        if section not in config:
            raise ValueError(f"config {path} has no {section!r} section")
    return config
