"""netsieve: network-log and flow analytics written for PySpark."""

__version__ = "0.1.0"
