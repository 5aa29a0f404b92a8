"""Readers. All are lazy DataFrames over whole directories; persist one that several plans reuse."""
