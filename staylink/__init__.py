"""staylink: vacation-rental listing resolution as Spark DataFrame operators.

Every operator is DataFrame-in / DataFrame-out (or Column-in / Column-out for
scalar functions) and is meant to run unchanged on a cluster.
"""

__version__ = "0.1.0"
