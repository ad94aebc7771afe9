"""Settings from TOML: every key has a default, and a key without one is an error."""

from __future__ import annotations

import copy
import hashlib
import json
import tomllib
from pathlib import Path

_HTTP = {"model_tag": "", "model_digest": "", "temperature": 0.0, "seed": 42, "connect_timeout_s": 5.0, "request_timeout_s": 90.0}
DEFAULTS = {
    "backend": {
        "kind": "ollama",
        "ollama": {"base_url": "http://localhost:11434", "num_ctx": 8192, "num_predict": 512} | _HTTP,
        "openai_compat": {"base_url": "http://localhost:8080/v1", "max_tokens": 512} | _HTTP,
        "fake": {"model_tag": "fake-v1", "model_digest": "fake", "sleep_s": 0.0},
    },
    "pricing": {"input_per_million": 0.0, "output_per_million": 0.0},
    "limits": {"large_file_threshold_mb": 50.0, "max_zip_uncompressed_mb": 2048.0, "extract_timeout_s": 30.0, "max_prompt_input_tokens": 6000, "bytes_per_token_estimate": 3.0},
    "retry": {"max_retries": 2, "backoff_base_s": 1.0, "backoff_max_s": 20.0, "circuit_breaker_failures": 5, "circuit_breaker_reset_s": 30.0},
    "self_entities": {"names": [], "tax_ids": []},
}
KINDS = ("ollama", "openai_compat", "fake")


def merged(given: dict, defaults: dict = DEFAULTS, at: str = "") -> dict:
    out = copy.deepcopy(defaults)
    for key, value in given.items():
        if key not in defaults:
            raise ValueError(f"unknown setting: {at}{key}")
        want = defaults[key]
        if isinstance(want, dict):
            out[key] = merged(value, want, f"{at}{key}.")
        elif isinstance(want, float) and isinstance(value, int) and not isinstance(value, bool):
            out[key] = float(value)
        elif type(value) is not type(want):
            raise ValueError(f"{at}{key} must be a {type(want).__name__}")
        else:
            out[key] = value
    if out.get("kind", KINDS[0]) not in KINDS:
        raise ValueError(f"unknown backend: {out['kind']}")
    return out


def load(path: str | None) -> dict:
    return merged(tomllib.loads(Path(path).read_text()) if path else {})


def config_hash(settings: dict) -> str:
    return hashlib.sha256(json.dumps(settings, sort_keys=True).encode()).hexdigest()
