"""Training-data operators: exact and near deduplication, decontamination, mixing,
language identification, binary token output, WARC archives and sharding.

Nothing else in the library imports this subpackage. Every operator takes and
returns DataFrames; intermediate tables go to the shared folder named by
``spark.checkpoint.dir``.
"""
