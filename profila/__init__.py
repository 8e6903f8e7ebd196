"""profila: device profiling on Spark.

From a log of app events it builds one feature row per device, adds
out-of-fold predictions of distributed learners over the device's app and
tag lists, and predicts a binary target (gender) that then feeds a numeric
target (age).  Everything is DataFrame code planned by Catalyst; learned
operators are Spark ML estimators plus one iterative-parameter-mixing
linear learner (``operators.linear_mix``).
"""

__all__ = ["session", "sources", "functions", "operators", "plans", "streaming"]
