"""Signal-quality analytics as lazy DataFrame plans on PySpark."""

__version__ = "0.1.0"
