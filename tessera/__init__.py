"""tessera — a Spark-native engine for preparing and analysing text corpora.

Every operator takes and returns a DataFrame (use with ``df.transform``).
"""

__version__ = "0.1.0"
