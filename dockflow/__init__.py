"""dockflow: station inventory analytics as Spark jobs."""

from dockflow.spec import TripSpec

__all__ = ["TripSpec"]
