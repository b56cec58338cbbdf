"""Column expressions: cleaning, derived values, calendar parts, digests and JSON records.

Every function takes and returns ``Column`` objects built from Spark's own functions, so
they run inside the JVM and fuse with the scan they are applied to.
"""
