"""Groundwater monitoring, detection, forecasting and licence risk on Spark."""

__version__ = "0.1.0"
