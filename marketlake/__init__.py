"""marketlake: a Spark-native market-data lakehouse.

Every public operator is a plain function ``DataFrame -> DataFrame`` (or
``Column -> Column``) built from Spark SQL built-ins, so Catalyst can push
filters and projections into the scans, fuse stages into whole-stage codegen
and let adaptive execution pick join strategies at run time.
"""

__version__ = "0.1.0"
