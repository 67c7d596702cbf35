"""tessera: Spark-native embedding-operations and text-evaluation analytics.

Every public function takes and returns DataFrames; the heavy lifting is
declared with the DataFrame/SQL API so Catalyst and AQE pick the physical plan.
"""

__version__ = "0.1.0"
