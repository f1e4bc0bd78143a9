"""The library's operators run on the driver's test tables, with their SQL."""
