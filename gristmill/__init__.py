"""Text curation and text classification as Spark DataFrame jobs.

Every job takes DataFrames keyed by a stable ``id`` and returns DataFrames.
"""
