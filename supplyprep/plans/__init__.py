"""Pipelines: the feeds, the bill of material, the supply table and the netting steps."""
