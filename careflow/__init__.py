"""careflow: service-time and patient-flow analytics as Spark DataFrame operators.

Raw visit records -> typed staging -> star schema (fact, calendar, hour, segment and
department dimensions; hourly, daily and segment aggregates) -> metric, measure,
quality and profile operators. Every operator takes and returns DataFrames and
stays lazy; nothing is collected to the driver inside the library.
"""

from careflow.params import MeasureParams

__all__ = ["MeasureParams"]
__version__ = "0.1.0"
