"""cabwh: a ride-hailing fleet warehouse on the Spark DataFrame API.

Sources (rides, car status events, drivers, cars, XML waybills, TSV payments) are loaded
incrementally into fact tables and type-2 dimensions, and four daily / historical
reports are built from them. Every operator is a ``DataFrame -> DataFrame`` function.
"""

__version__ = "0.1.0"
