"""vellumry: a PySpark-native engine for collections of nested records and HTML documents."""
