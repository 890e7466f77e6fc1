"""paymart: a Spark-native payments risk warehouse.

Layers (raw -> staging -> enriched -> star schema -> marts -> reporting) are
plain functions from DataFrames to a DataFrame built from Spark SQL
expressions; ``paymart.plans.warehouse.Warehouse`` wires them together.
"""

__version__ = "0.1.0"
