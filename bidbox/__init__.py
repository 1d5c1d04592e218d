"""bidbox: competition-results analytics as Spark DataFrame operators.

Every operator is a ``DataFrame -> DataFrame`` function whose column names are
parameters (domain names are defaults), so the same code runs on results tables
and on the star-schema test tables bound in :mod:`bidbox.plans`.
"""

__version__ = "0.1.0"
