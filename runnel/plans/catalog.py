"""All registered queries of the model and their SQL. Importing a module of queries registers them."""

from __future__ import annotations

from runnel.plans import gridded, networks, relational, terrain, validations

QUERIES, ORACLES = relational.QUERIES, relational.ORACLES
assert gridded.CHANNEL_CELLS and networks.STREETS_SQL and terrain.TILE and validations.NETWORK_SQL
