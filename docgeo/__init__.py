"""docgeo: find, geocode, score and condense the places a document corpus mentions, on Spark.

Every public function takes and returns DataFrames and triggers no action unless its docstring says so.
"""

__version__ = "0.1.0"
