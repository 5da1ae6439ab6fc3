"""docstrata: a two-zone document lake expressed as PySpark jobs.

Everything takes and returns DataFrames or Columns.  ``functions`` holds Column
builders, ``operators`` DataFrame transformations, ``sources`` readers and the
table store, ``plans`` whole jobs and ``streaming`` their Structured Streaming form.
"""

from docstrata.session import build_session

__all__ = ["build_session"]
__version__ = "0.1.0"
