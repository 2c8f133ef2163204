"""gridlake: lakehouse analytics on Spark DataFrames.

Sub-packages:

- ``sources``   file scans by extension, conversion, listing, export/import
- ``functions`` column expressions (string concat, predicates, paths, name rules)
- ``operators`` star joins with size-checked broadcast, skew-safe de-duplication
- ``plans``     the racing warehouse: raw tables, facts, reports, catalog
- ``keyed``     operations on keyed rows and the resolution of a change log
- ``streaming`` incremental consumption of that change log
"""

__version__ = "0.1.0"
