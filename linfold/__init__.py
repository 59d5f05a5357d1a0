"""linfold: a Spark-native label-prediction pipeline.

Points are DataFrames ``(point_id, label DOUBLE, features ARRAY<DOUBLE>)``.
All data work is expressed with the DataFrame API; model training reads a
single distributed pass of sufficient statistics (moments), whose size
depends only on the feature width, never on the row count.
"""

__version__ = "0.1.0"
