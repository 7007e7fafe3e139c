"""strideframe: sensor-series features, splits and model evaluation as Spark DataFrame operators.

Every operator is a plain function ``DataFrame -> DataFrame`` (column names are
arguments).  The heavy lifting is left to Catalyst: the functions only declare
projections, joins, aggregates and window frames.
"""

__version__ = "0.1.0"
