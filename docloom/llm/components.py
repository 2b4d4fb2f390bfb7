"""Connected components for joins on pairs: the engine's own."""

from docloom.operators.graph import connected_components

__all__ = ["connected_components"]
