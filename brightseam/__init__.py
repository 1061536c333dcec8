"""brightseam: dataset curation on Spark DataFrames.

Operators are plain ``DataFrame -> DataFrame`` functions; actions happen only in
sinks, checks and iterative loops.  See README.md for the layout.
"""

__version__ = "0.1.0"
