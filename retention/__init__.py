"""Customer-retention analytics as Spark DataFrame plans.

Every public function takes DataFrames (and plain parameters) and returns a
DataFrame; nothing is collected to the driver except bounded summaries.
"""

from retention.params import Params

__all__ = ["Params"]
