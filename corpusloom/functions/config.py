"""Driver-side configuration: canonical JSON, fingerprints, prompts, settings."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Mapping
from dataclasses import dataclass, fields

#: Engine arguments that change speed only, left out of the fingerprint of results.
SPEED_ONLY = ("mem_fraction_static", "max_running_requests", "cuda_graph_max_bs", "chunked_prefill_size", "disable_radix_cache", "dp_size", "log_level")


def canonical_json(value: object) -> str:
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def serving_fingerprint(config: Mapping[str, object]) -> str:
    return hashlib.sha256(canonical_json(config).encode()).hexdigest()[:16]


def config_fingerprint(config: Mapping[str, object], engine: str = "engine", speed_only: tuple[str, ...] = SPEED_ONLY) -> str:
    """Identity of what decides results: the configuration without arguments that only change speed."""
    kept = {k: v for k, v in dict(config.get(engine, {})).items() if k not in speed_only}
    return serving_fingerprint({**config, engine: kept})


def check_prompt(template: str, digest: str) -> str:
    if hashlib.sha256(template.encode()).hexdigest() != digest:
        raise ValueError("the prompt is not the pinned one")
    return template


def split_template(rendered: str, sentinel: str) -> tuple[str, str]:
    """What a chat template puts before and after a text that stands once in it."""
    if rendered.count(sentinel) != 1:
        raise ValueError("the sentinel must occur exactly once")
    before, _, after = rendered.partition(sentinel)
    return before, after


def engine_arguments(base: Mapping[str, object], profile: Mapping[str, object]) -> dict[str, object]:
    """Later ones win; absent ones don't count."""
    return {**base, **{k: v for k, v in profile.items() if v is not None}}


@dataclass(frozen=True)
class Settings:
    """Defaults, below a file, below the environment (PREFIX_NAME)."""

    max_jobs: int = 60
    max_jobs_per_site: int = 20
    overflow: float = 1.2
    chunk_size: int = 2000
    sites: tuple[str, ...] = ()

    @staticmethod
    def load(file: Mapping[str, object] | None = None, environment: Mapping[str, str] | None = None, prefix: str = "CORPUSLOOM") -> Settings:
        given = dict(file or {})
        names = {f.name: f for f in fields(Settings)}
        errors = [f"unknown setting {k}" for k in sorted(given) if k not in names]
        for name, f in names.items():
            raw = (environment or {}).get(f"{prefix}_{name.upper()}")
            try:
                if raw is not None:
                    given[name] = tuple(x.strip() for x in raw.split(",") if x.strip()) if name == "sites" else (float if name == "overflow" else int)(raw)
                elif name in given and name == "sites":
                    given[name] = tuple(given[name])
            except ValueError:
                errors.append(f"{name} is not a number: {raw}")
            if name in given and name != "sites" and (not isinstance(given[name], int | float) or given[name] <= 0):
                errors.append(f"{name} must be positive")
        if errors:
            raise ValueError("; ".join(errors))
        return Settings(**given)
