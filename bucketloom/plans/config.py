"""Settings: a JSON file's signals and granularities over the defaults, and the environment's endpoints."""

from __future__ import annotations

import json
import os
from dataclasses import dataclass, field, replace
from datetime import timedelta

from bucketloom.model import COMMON, DAY_1, HOUR_1, SPECS, Granularity, SignalSpec, spec_of
from bucketloom.plans.tiering import parse_duration

#: The backend that takes a projection, and where it does (fixed values).
INGEST = {"prometheus": ("metrics", "/api/v1/import/prometheus"), "loglines": ("logs", "/loki/api/v1/push")}


@dataclass(frozen=True)
class Settings:
    granularities: tuple[Granularity, ...] = (HOUR_1, DAY_1)
    signals: dict[str, SignalSpec] = field(default_factory=lambda: dict(SPECS))
    selectors: dict[str, str] = field(default_factory=lambda: {"metrics": '{__name__!~"rollup_.*", tier!="cold"}', "logs": '{service_name=~".+", tier!="cold"}', "traces": "{}"})
    urls: dict[str, str] = field(default_factory=dict)
    #: Where projections go, by sink: a url to post to, or a path. By default the backends that are read.
    destinations: dict[str, str] = field(default_factory=dict)
    #: Whether a dimension that a bucket lacks altogether fails the run.
    strict_drift: bool = False
    archive: str = "data/archive"
    state: str = "data/state.sqlite"
    horizon: timedelta = timedelta(hours=24)
    timeout: float = 30.0


def _deduped(names) -> tuple[str, ...]:
    return tuple(dict.fromkeys(names))


def load(path: str | None = None, env=os.environ) -> Settings:
    s = Settings()
    if path:
        with open(path, encoding="utf-8") as f:
            given = json.load(f)
        common = given.get("common_dimensions", COMMON)
        signals, selectors = {}, dict(s.selectors)
        for name, x in given.get("signals", {}).items():
            base = spec_of(name)
            if not x.get("enabled", True):
                continue
            dims = _deduped([*common, *x["dimensions"]]) if "dimensions" in x else base.dimensions
            grace = parse_duration(x["grace"]) if "grace" in x else base.grace
            if grace is None:
                raise ValueError(f"{name}: grace {x['grace']!r} can't be read")
            signals[name] = replace(base, dimensions=dims, grace=grace, sinks=tuple(x.get("sinks", base.sinks)), percentiles=tuple(x.get("percentiles", base.percentiles)))
            selectors[name] = x.get("selector", selectors[name])
        grans = tuple(Granularity(g["name"], g["seconds"], g.get("retain")) for g in given.get("granularities", [])) or s.granularities
        s = replace(s, granularities=grans, signals=signals or s.signals, selectors=selectors, archive=given.get("archive", s.archive), state=given.get("state", s.state), destinations=dict(given.get("destinations", {})), strict_drift=bool(given.get("strict_drift", False)))
    urls = {name: env[f"LOOM_{name.upper()}_URL"] for name in SPECS if env.get(f"LOOM_{name.upper()}_URL")}
    to = {sink: urls[name].rstrip("/") + path for sink, (name, path) in INGEST.items() if urls.get(name, "").startswith("http")}
    to |= s.destinations | {sink: env[f"LOOM_SINK_{sink.upper()}"] for sink in INGEST if env.get(f"LOOM_SINK_{sink.upper()}")}
    return replace(s, urls=s.urls | urls, destinations=to, archive=env.get("LOOM_ARCHIVE", s.archive), state=env.get("LOOM_STATE", s.state))
