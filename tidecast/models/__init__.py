"""Models: boosted trees with grid tuning, per-series forecasters, scoring
and model choice."""
