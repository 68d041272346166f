"""User-behaviour analytics on Spark: cleaning, audits, features, cohorts, churn models and segments.

Every job is a function from DataFrames to DataFrames.  ``usertide.plans`` holds the jobs,
``usertide.operators`` the reusable relational building blocks, ``usertide.functions`` the
column expressions and ``usertide.sources`` the readers and writers.
"""
