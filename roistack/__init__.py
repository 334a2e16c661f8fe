"""A PySpark-native engine for regions of interest traced across image z-stacks."""
