"""All registered queries."""

from __future__ import annotations

from obsloom.registered import general, models, moving
from obsloom.registered.common import Registry

REGISTRY = Registry()
general.register(REGISTRY)
models.register(REGISTRY)
moving.register(REGISTRY)
