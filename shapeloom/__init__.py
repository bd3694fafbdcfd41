"""Spark-native preparation of image-and-caption datasets.

Everything is ``DataFrame -> DataFrame`` or ``Column -> Column``; see README.md
for the layout and for how each operator behaves on skewed data.
"""

__version__ = "0.1.0"
