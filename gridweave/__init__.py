"""A Spark-first library for allocating, calibrating and checking large tables of located objects."""
