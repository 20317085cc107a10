"""Customer analytics over retail invoice lines, written as Spark DataFrame jobs.

``sources``    reading and writing raw lines, tables, result files
``functions``  column expressions and small numeric helpers
``operators``  one module per step of the analysis
``plans``      the five jobs (load, segment, churn, forecast, dashboard) and the full run
"""
