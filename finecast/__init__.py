"""finecast: local weather forecasts from coarse ones, as Spark DataFrame jobs.

Every public function takes and returns DataFrames (or Columns) and works on
all areas at once.  Missing values stay NULL; nothing is imputed unless a
function says so; guards raise instead of repairing.
"""

__version__ = "0.1.0"
