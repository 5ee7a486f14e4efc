"""Shop behaviour and ad-click analytics as PySpark DataFrame and streaming operators."""
