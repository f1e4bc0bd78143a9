"""Platform-governance analytics on Spark: landed admin-API JSON to typed tables,
a star schema, governed measures and report queries."""

__version__ = "0.1.0"
