"""leadflow — partner lead, guarantee and engagement analytics on Spark.

Every operator is a plain function over DataFrames (or returns a Column);
nothing runs on the driver except plan construction.
"""

__version__ = "0.1.0"
