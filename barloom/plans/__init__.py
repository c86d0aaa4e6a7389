"""Whole runs, composed of operators."""

from barloom.plans.runs import generated_run, holding_run, market_run

__all__ = ["generated_run", "holding_run", "market_run"]
