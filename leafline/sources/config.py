"""Pipeline configuration: a YAML or JSON file as a dictionary, relative paths anchored, overlays merged one level deep."""

from __future__ import annotations

import json
from pathlib import Path

PATH_KEYS = ("pdf_dir", "output_dir", "model_path", "entities")


def load(path: str) -> dict:
    text = Path(path).read_text()
    if path.endswith(".json"):
        return anchored(json.loads(text), Path(path).parent)
    try:
        import yaml
    except ImportError as e:
        raise RuntimeError("YAML configuration needs the yaml package; JSON works without") from e
    return anchored(yaml.safe_load(text) or {}, Path(path).parent)


def anchored(config: dict, base: Path) -> dict:
    """Relative paths under PATH_KEYS made absolute against base; addresses with a scheme stay."""

    def one(key: str, value: object) -> object:
        if isinstance(value, dict):
            return {k: one(k, v) for k, v in value.items()}
        if key in PATH_KEYS and isinstance(value, str) and "://" not in value and not Path(value).is_absolute():
            return str((base / value).resolve())
        return value

    return {k: one(k, v) for k, v in config.items()}


def merged(config: dict, overlay: dict) -> dict:
    """A new dictionary: overlay's non-null values over config's, nested dictionaries one level deep."""
    out = dict(config)
    for k, v in overlay.items():
        if v is None:
            continue
        out[k] = {**out[k], **{a: b for a, b in v.items() if b is not None}} if isinstance(v, dict) and isinstance(out.get(k), dict) else v
    return out


def seeds(path: str) -> list[str]:
    """The entities of a file; none where it is missing."""
    return load(path).get("entities", []) if Path(path).exists() else []
