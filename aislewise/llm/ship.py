"""Makes this package importable on executors."""

from aislewise.shipping import map_batches, ship_package

__all__ = ["map_batches", "ship_package"]
