"""Column functions (catalogue F1–F24 and the time helpers W3–W5).

All are built from ``pyspark.sql.functions`` so they stay inside whole-stage codegen.
"""

from .time import *  # noqa: F401,F403
from .keys import *  # noqa: F401,F403
from .text import *  # noqa: F401,F403
