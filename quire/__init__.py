"""quire: bibliographic JSON Lines dumps to flat Parquet, and analysis of the result, as Spark plans.

``sources``    readers, landing-folder selection, sinks
``functions``  column helpers shared by every operator
``operators``  profiling, field selection, shredding, layout: DataFrame -> DataFrame
``plans``      the whole ingest and the library of analysis queries
"""

__version__ = "0.1.0"
