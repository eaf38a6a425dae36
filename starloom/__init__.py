"""starloom: a Spark-native workforce star-schema warehouse.

Operational tables (departments, employees, projects, assignments, role and
salary history, an attribute snapshot) are cleaned, conformed into date,
department, project and SCD2 employee dimensions plus a per-snapshot
performance fact, checked against the rules a database would enforce, and
reported on.  Every operator is a ``DataFrame -> DataFrame`` function built
from Spark SQL expressions; nothing runs row by row in Python.
"""

from starloom.session import build_session, checkpoint_dir

__all__ = ["build_session", "checkpoint_dir"]
