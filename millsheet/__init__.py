"""millsheet: a PySpark-native engine for industrial documents."""
