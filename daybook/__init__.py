"""Spark-native engine for append-only, change-tracked archives of published logs.

Column expressions live in :mod:`daybook.functions`, relational operators in
:mod:`daybook.operators`, readers and writers in :mod:`daybook.sources` and
:mod:`daybook.sinks`, ready-made queries in :mod:`daybook.plans`, micro-batch
drivers in :mod:`daybook.streaming`.  ``daybook.llm`` is optional: nothing
outside it imports it.
"""

__version__ = "0.1.0"
