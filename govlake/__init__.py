"""govlake: estate-governance analytics as Spark DataFrame operators.

Every public operator takes DataFrames (plus column names, dates and
parameters) and returns a DataFrame; nothing is collected to the driver.
Sub-packages:

* ``sources``   - JSON envelopes, snapshot folders, report logs, sinks, dimensions
* ``functions`` - column expressions (scalar transforms, blank-aware arithmetic)
* ``operators`` - flattening, merges, joins, measures, windows, set ops,
                  lineage graph, trace queries, model rules, table builders
* ``plans``     - the registered queries over the driver tables
* ``streaming`` - incremental loads as Structured Streaming micro-batches
"""

__version__ = "0.1.0"
