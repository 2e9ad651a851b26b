"""Spark-native analytics for card-transaction risk data.

Every operator is a function from DataFrame to DataFrame.  The session is taken
from the input frame, nothing below this package pulls rows to the driver, and
no Python UDF sits on the data path.
"""

__version__ = "0.1.0"
