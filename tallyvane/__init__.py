"""tallyvane: price-intelligence and data-processing operators as Spark DataFrame functions."""

__version__ = "0.1.0"
