"""quarry: a PySpark-native analytics engine for machine-learning model catalogues."""
