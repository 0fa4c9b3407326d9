"""Commerce lakehouse analytics as Spark DataFrame jobs.

``sources``    reading, ingest, sinks and the views over the given tables
``functions``  column expressions (missing values, dates, labels, vectors)
``operators``  DataFrame in, DataFrame out building blocks
``plans``      the bronze, silver, gold and study jobs made from them
"""
