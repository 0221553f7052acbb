"""strata: layered (bronze / silver / gold) batch loads as Spark DataFrame operators.

Every operator is a function from DataFrame(s) to DataFrame, planned by Catalyst;
I/O happens only at the edges (``strata.sources``) and in the job runners
(``strata.plans``).
"""

__version__ = "0.1.0"
