"""PySpark-native analytics over document corpora.

Every operator is a ``DataFrame -> DataFrame`` transform or a ``Column`` builder, so Catalyst sees
the whole plan. See README.md for the operator map.
"""
