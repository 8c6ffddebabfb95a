"""Collections-catalogue analytics as Spark jobs.

``functions``  column expressions (cleaning, folding, identifiers, similarity)
``sources``    readers, writers and the dataset registry
``operators``  DataFrame -> DataFrame building blocks
``plans``      layer jobs: silver, gold, reports, daily metrics
``streaming``  Structured Streaming jobs
"""

__version__ = "0.1.0"
