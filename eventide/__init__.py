"""eventide: event-stream analytics as Spark DataFrame operators.

Every operator is a function ``DataFrame -> DataFrame`` that works on batch
frames (``spark.read``) and, where the semantics allow, on streaming frames
(``spark.readStream``).  Stateful operators that need arrival order and
timers have a separate streaming form in :mod:`eventide.streaming`.
"""

__version__ = "0.1.0"
