"""riskweave: customer-risk and data-drift analytics as Spark jobs.

Layers
------
``functions``  column expressions (bands, labels, encoders, hashes)
``operators``  DataFrame -> DataFrame building blocks
``sources``    readers and writers
``plans``      compositions of operators (cleaning jobs, training job, drift job)
``streaming``  Structured Streaming jobs
``workload``   the registered queries and their oracle SQL
"""
