"""costcurves: project cost curves (actual, planned, forecast) as Spark jobs.

Every public function takes and returns DataFrames; nothing is collected to
the driver. See README.md for the operator map.
"""

from .plans.jobs import Curves, build_curves, run_curves
from .schema import KEY
from .sources.tables import CostInputs

__all__ = ["KEY", "CostInputs", "Curves", "build_curves", "run_curves"]
