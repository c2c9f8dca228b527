"""A PySpark engine that turns vulnerability feeds into typed tables, a star schema and reports."""
