"""starmart: a PySpark star-schema pipeline for daily public-health feeds.

Raw CSV / GeoJSON feeds are cleaned and conformed, turned into calendar, region and
hospital dimensions with reproducible surrogate keys and a daily state fact table,
checked for key and null violations, and published as reporting marts and CSV extracts.
Every step is a DataFrame function that takes its column names as parameters.
"""

__version__ = "0.1.0"
