"""stratalake: layered (raw -> cleaned -> dimensional) tables as plain Spark DataFrame functions."""

__version__ = "0.1.0"
