"""colloquy: chat-log Q&A, knowledge-graph and text-analytics operators on Spark.

Every operator takes and returns DataFrames (or Columns). Scalar functions live
in ``colloquy.functions``, table readers/writers in ``colloquy.sources``,
relational operators in ``colloquy.operators``, compositions in
``colloquy.plans`` and incremental jobs in ``colloquy.streaming``.
"""

__version__ = "0.1.0"
