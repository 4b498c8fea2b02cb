"""All registered queries of the fleet engine."""

from __future__ import annotations

from tidefleet.plans import core, dashboard, domain, pipelines, serving

MODULES = (core, domain, dashboard, pipelines, serving)
QUERIES = {k: v for m in MODULES for k, v in m.Q.items()}
ORACLES = {k: v for m in MODULES for k, v in m.SQL.items()}
