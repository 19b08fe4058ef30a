"""quarterdeck: financial-statement analytics as Spark DataFrame plans.

Sub-packages:

* ``functions``  - Column helpers (safe division, strict LEAST/GREATEST, growth, coercion, dates)
* ``sources``    - delimited / JSON readers, file inventories, statement tables from the test data
* ``operators``  - reshaping, derived tables, reports, ranking, data-quality checks
* ``plans``      - managed tables, loaders and sinks, the staged build, shared storage
* ``streaming``  - incremental loading of newly landed statement files
"""

__version__ = "0.1.0"
