"""Stream forms of the incremental steps."""
