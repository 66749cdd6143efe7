"""Jobs for ``spark-submit``: each module has a ``main`` and prints ``name=value`` lines."""
