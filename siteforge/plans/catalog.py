"""All query modules of the engine; importing them fills the registry."""
from siteforge.plans import aggregates, decisions, flows, learning, places, ranking, relations, scalars, stores  # noqa: F401
