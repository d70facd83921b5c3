"""The catalog as DataFrames, and the documented log, trace and catalog queries."""
