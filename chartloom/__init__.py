"""Chartloom: enriched record datasets as Spark jobs.

Base records, catalogue rows, comments, pages and sample arrays go in as
DataFrames; keyed joins, candidate scoring, de-duplication, upserts, reports
and clip features come out as DataFrames.  No operator collects its input.
"""
