"""cytoplan: single-cell count analytics expressed as Spark DataFrame plans.

Subpackages: ``sources`` (readers and writers), ``functions`` (Column expressions),
``operators`` (DataFrame to DataFrame), ``plans`` (registered queries and their
SQL oracles), ``streaming`` (incremental extension).
"""
