"""Supply-planning data preparation on Spark: pure DataFrame operators and pipelines."""

from supplyprep.context import RunContext

__all__ = ["RunContext"]
